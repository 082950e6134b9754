"""Column-expression helpers shared by all operators (JVM-side, codegen'd)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def count_nonnull_if(value: Column | str, cond: Column) -> Column:
    """``countIf(x, cond)``: rows where ``cond`` holds and ``x`` is not NULL."""
    v = F.col(value) if isinstance(value, str) else value
    return F.count(F.when(cond, v))


def safe_div(num: Column, den: Column) -> Column:
    """Ratio that is NULL (not an error, not inf/nan) when ``den`` is 0."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def round_half_even(x: Column, digits: int) -> Column:
    """Round a double to ``digits`` places, ties to even, on the scaled value.

    ``bround(x, d)`` rounds the shortest decimal text of ``x``; scaling first
    rounds the scaled binary value, as float rounding in SQL engines does
    (0.125 -> 0.12, 1.005 -> 1.0 since 1.005 * 100 = 100.49999999999999).
    """
    scale = float(10 ** digits)
    # + 0.0 normalises a negative zero, so equal results compare equal bytewise
    return F.bround(x.cast("double") * F.lit(scale), 0) / F.lit(scale) + F.lit(0.0)


def ts_literal(value: dt.datetime | dt.date, like: T.DataType) -> Column:
    """A timestamp literal of the same kind (NTZ / LTZ) as the column it is
    compared with, so the comparison stays a plain pushed-down filter."""
    if isinstance(value, dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S")
    else:
        text = value.strftime("%Y-%m-%d 00:00:00")
    kind = "timestamp_ntz" if isinstance(like, T.TimestampNTZType) else "timestamp"
    return F.lit(text).cast(kind)


# column metadata key marking a date partition column derived from the
# event time (set by the production readers in ``pulsekit.sources``)
DATE_PARTITION_FLAG = "pulsekit.date_partition"


def date_partition_column(df: DataFrame) -> str | None:
    for f in df.schema.fields:
        if f.metadata.get(DATE_PARTITION_FLAG) and isinstance(f.dataType, T.DateType):
            return f.name
    return None


def time_range(df: DataFrame, col: str, start, end) -> Column:
    """Half-open ``start <= col < end`` on a timestamp column.

    If ``df`` carries a marked date partition column, the matching date
    bounds are added too, so whole partitions outside the range are never
    listed or read (partition pruning), not just filtered row groups."""
    dtype = df.schema[col].dataType
    cond = (F.col(col) >= ts_literal(start, dtype)) & (F.col(col) < ts_literal(end, dtype))
    part = date_partition_column(df)
    if part is not None:
        first = start if not isinstance(start, dt.datetime) else start.date()
        last_ts = end if isinstance(end, dt.datetime) else dt.datetime.combine(end, dt.time())
        last = (last_ts - dt.timedelta(microseconds=1)).date()
        cond = cond & (F.col(part) >= F.lit(first)) & (F.col(part) <= F.lit(last))
    return cond


def day_range(df: DataFrame, col: str, first_day: dt.date, last_day: dt.date) -> Column:
    """Whole days ``first_day .. last_day`` inclusive, as a half-open range."""
    return time_range(df, col, first_day, last_day + dt.timedelta(days=1))


def quarter_hour(col: Column | str) -> Column:
    """Start of the 15-minute bucket (keeps NTZ for NTZ input)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.window(c, "15 minutes").start


def hour_minute(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "HH:mm")


def fmt_fixed(x: Column, digits: int = 2) -> Column:
    """``{x:.2f}``: half-even rounding, then fixed text; NULL -> 'nan'."""
    r = round_half_even(x, digits)
    return F.when(r.isNull(), F.lit("nan")).otherwise(F.format_string(f"%.{digits}f", r))


def fmt_percent(x: Column, digits: int = 2) -> Column:
    """``{x:.2%}``: 100*x with ``digits`` decimals and a percent sign."""
    r = round_half_even(x.cast("double") * F.lit(100.0), digits)
    return F.when(r.isNull(), F.lit("nan")).otherwise(F.format_string(f"%.{digits}f%%", r))
