"""Distributed running sums in a global order, without a one-task window.

``Window.orderBy(x)`` with no partition key moves every row into a single
task.  Instead the order column is cut into ``n_ranges`` value ranges
(boundaries from ``approxQuantile``: ``n_ranges - 1`` numbers, which with the
row count is all that comes to the driver), block totals per range are summed (a
tiny frame: keys x ranges rows), their running offsets are joined back, and
the running sum inside each range is a window partitioned by range.
Equal order values always fall in the same range.

Precondition: order values are unique within each ``by`` group (aggregate
ties first, as the rank statistics do).
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsekit.functions.hashing import hash_bucket
from pulsekit.functions.stats import count_bounds_below_sql
from pulsekit.operators.spread import materialize

#: Rows of a range or an index bucket to aim at; ranges follow the row count.
RANGE_ROWS = 200_000
LEAST_RANGES, MOST_RANGES = 8, 2048
_RID = "_range_id"


def ranges_for(df: DataFrame) -> int:
    """Ranges for a materialized frame: one for every RANGE_ROWS rows, within
    bounds that keep the boundaries few enough for the driver."""
    return ranges_of(df.count())


def ranges_of(rows: int) -> int:
    return int(min(MOST_RANGES, max(LEAST_RANGES, -(-rows // RANGE_ROWS))))


def range_id(order_col: str, bounds: list[float]) -> Column:
    """Number of boundaries strictly below the value (0 .. len(bounds))."""
    name = "`" + order_col.replace("`", "``") + "`"
    return F.expr(count_bounds_below_sql(f"CAST({name} AS DOUBLE)", bounds))


def range_bounds(df: DataFrame, order_col: str, n_ranges: int, rel_err: float = 1e-3) -> list[float]:
    probs = [i / n_ranges for i in range(1, n_ranges)]
    if not probs:
        return []
    vals = df.approxQuantile(order_col, probs, rel_err)
    return sorted({float(v) for v in vals if v is not None and not math.isnan(v)})


def exclusive_prefix(df: DataFrame, order_col: str, sum_cols: list[str], by: list[str] | tuple = (),
                     n_ranges: int | None = None, prefix: str = "before_",
                     checkpoint: bool = True) -> DataFrame:
    """Adds ``before_<c>``: sum of ``c`` over rows of the same ``by`` group
    with a smaller ``order_col``.

    The input is read twice (range sampling, then the sums), so by default
    it is materialized once first."""
    by = list(by)
    if checkpoint:
        df = materialize(df)
    bounds = range_bounds(df, order_col, n_ranges or ranges_for(df))
    tagged = df.withColumn(_RID, range_id(order_col, bounds))
    blocks = tagged.groupBy(*by, _RID).agg(*[F.sum(c).alias(c) for c in sum_cols])
    wb = Window.partitionBy(*by).orderBy(_RID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*by, _RID, *[
        F.coalesce(F.sum(c).over(wb), F.lit(0)).alias(f"_off_{c}") for c in sum_cols])
    # offsets hold (#by groups) x n_ranges rows; the join is chosen by their size
    joined = tagged.join(offsets, [*by, _RID], "inner")
    wr = Window.partitionBy(*by, _RID).orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    return joined.select(*df.columns, *[
        (F.col(f"_off_{c}") + F.coalesce(F.sum(c).over(wr), F.lit(0))).alias(f"{prefix}{c}")
        for c in sum_cols])


#: Users are numbered by this many md5 buckets, then by id.
INDEX_ORDER = 1 << 20


def dense_index(df: DataFrame, by: list[str], order_col: str, name: str = "idx") -> DataFrame:
    """0-based position of each row within its ``by`` group, in the order
    (md5 bucket of ``order_col``, ``order_col``) -- a fixed bijection onto
    0..n-1 that needs no global sort: the buckets are cut into as many runs as the
    rows ask for, rows per (group, run) are counted, their running offsets (groups x
    runs rows) are joined back, and positions inside a run come from a window
    partitioned by (group, run).  Values of ``order_col`` must be unique per group.

    Input and result are materialized: callers read them several times (sizes,
    joins).  ``by`` is meant for a handful of groups (experiment groups).
    """
    df = materialize(df)
    runs = 1 << (ranges_for(df) - 1).bit_length()
    tagged = (df.withColumn("_ib", hash_bucket(F.col(order_col), INDEX_ORDER, "md5"))
              .withColumn("_ir", F.floor(F.col("_ib") * runs / INDEX_ORDER).cast("int")))
    blocks = tagged.groupBy(*by, "_ir").agg(F.count(F.lit(1)).alias("_c"))
    wb = Window.partitionBy(*by).orderBy("_ir").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*by, "_ir", F.coalesce(F.sum("_c").over(wb), F.lit(0)).alias("_off"))
    joined = tagged.join(offsets, [*by, "_ir"], "inner")
    wr = Window.partitionBy(*by, "_ir").orderBy("_ib", order_col)
    out = joined.withColumn(name, (F.col("_off") + F.row_number().over(wr) - 1).cast("long"))
    return materialize(out.drop("_ib", "_ir", "_off"))


def _as_number(df: DataFrame, order_col: str) -> Column:
    """Timestamps as microseconds, anything else as it casts to a double."""
    kind = df.schema[order_col].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                                F.col(order_col)).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(order_col).cast("double")
    return F.col(order_col).cast("double")


def series_index(df: DataFrame, by: list[str] | tuple, order_col: str, name: str = "idx",
                 n_ranges: int | None = None) -> DataFrame:
    """0-based position of each row within its series (the rows of equal ``by``,
    nulls equal to each other) in the order of ``order_col``, a timestamp or number.

    Rows per (series, range) are counted, their running offsets (series x ranges
    rows) joined back, and rows numbered within a range: no series is one task.
    The input is materialized, as it is read three times."""
    by = list(by)
    df = materialize(df)
    tagged = df.withColumn("_at", _as_number(df, order_col))
    bounds = range_bounds(tagged, "_at", n_ranges or ranges_for(df))
    tagged = tagged.withColumn(_RID, F.expr(count_bounds_below_sql("_at", bounds))).drop("_at")
    blocks = tagged.groupBy(*by, _RID).agg(F.count(F.lit(1)).alias("_c"))
    wb = Window.partitionBy(*by).orderBy(_RID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(*[F.col(c).alias(f"_o{k}") for k, c in enumerate([*by, _RID])],
                            F.coalesce(F.sum("_c").over(wb), F.lit(0)).alias("_off"))
    same = functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_o{k}")) for k, c in enumerate([*by, _RID])])
    wr = Window.partitionBy(*by, _RID).orderBy(order_col)
    return tagged.join(offsets, same).select(
        *df.columns, (F.col("_off") + F.row_number().over(wr) - 1).cast("long").alias(name))
