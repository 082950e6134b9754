"""Interquartile-range anomaly bands over metric time series.

For each metric ordered by time: the quartiles of the previous ``n`` values
(NULL until ``n`` non-NULL values exist), the band ``q75 + a*iqr`` /
``q25 - a*iqr``, then a centred moving average of the band over ``n``
points (shrinking at the ends, NULLs skipped).  ``anomaly_bands`` processes all
metrics in one window pass partitioned by metric (extra slice keys partition
further); ``history_bands`` gives the same rows for series too long for one task.

At the newest row the centred average only sees the current and earlier
rows, so the alert flag there uses no future data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from pulsekit.functions.columns import fmt_fixed, fmt_percent, safe_div
from pulsekit.operators.prefix import series_index


BAND = ["q25", "q75", "iqr", "up", "low", "prev_value"]


def _banded(long: DataFrame, w: WindowSpec, a: float, n: int) -> DataFrame:
    """``long`` with the columns BAND, in the order and partitions of ``w``."""
    prev = w.rowsBetween(-n, -1)
    full = F.count("value").over(prev) == F.lit(n)
    q25 = F.when(full, F.percentile(F.col("value"), F.lit(0.25)).over(prev))
    q75 = F.when(full, F.percentile(F.col("value"), F.lit(0.75)).over(prev))
    bands = (long.withColumn("q25", q25).withColumn("q75", q75)
                 .withColumn("iqr", F.col("q75") - F.col("q25"))
                 .withColumn("up_raw", F.col("q75") + F.lit(a) * F.col("iqr"))
                 .withColumn("low_raw", F.col("q25") - F.lit(a) * F.col("iqr")))
    centred = w.rowsBetween(-(n // 2), (n - 1) // 2)
    return bands.select(
        *long.columns, "q25", "q75", "iqr",
        F.avg("up_raw").over(centred).alias("up"),
        F.avg("low_raw").over(centred).alias("low"),
        F.lag("value").over(w).alias("prev_value"),
    )


def anomaly_bands(long: DataFrame, a: float = 3.0, n: int = 5,
                  keys: tuple[str, ...] = ("metric",), order: str = "ts") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return _banded(long, w, a, n).select(*keys, order, "value", *BAND)


#: Rows of a series that one window partition of ``history_bands`` works on.
BLOCK_ROWS = 50_000


def history_bands(long: DataFrame, a: float = 3.0, n: int = 5, keys: tuple[str, ...] = ("metric",),
                  order: str = "ts", block_rows: int = BLOCK_ROWS, n_ranges: int | None = None) -> DataFrame:
    """The rows of ``anomaly_bands`` for series of any length: a series is cut into
    blocks of ``block_rows`` rows, so it is not one task.

    Rows are numbered within their series (``series_index``).  A band looks back at
    the n rows before those that its average covers, and the average looks
    (n - 1) / 2 rows ahead: a block also gets copies of so many rows of its
    neighbours, by number, whatever the gaps in time, and leaves them out again."""
    before, after = n // 2 + n, (n - 1) // 2
    idx, block = F.col("_idx"), F.lit(block_rows)
    rows = series_index(long, keys, order, "_idx", n_ranges)
    first = F.floor(F.greatest(idx - after, F.lit(0)) / block)
    shared = rows.withColumn("_block", F.explode(F.sequence(first, F.floor((idx + before) / block))))
    w = Window.partitionBy(*keys, "_block").orderBy("_idx")
    return (_banded(shared, w, a, n).where(F.col("_block") == F.floor(idx / block))
            .select(*keys, order, "value", *BAND))


def anomaly_flags(bands: DataFrame, keys: tuple[str, ...] = ("metric",), order: str = "ts") -> DataFrame:
    """The newest row of each series with ``is_alert``."""
    latest = bands.groupBy(*keys).agg(
        F.max_by(F.struct(order, "value", "prev_value", "up", "low"), F.col(order)).alias("r"))
    flag = F.coalesce((F.col("r.value") < F.col("r.low")) | (F.col("r.value") > F.col("r.up")), F.lit(False))
    return latest.select(*keys, F.col(f"r.{order}").alias(order), "r.value", "r.prev_value",
                         "r.up", "r.low", flag.alias("is_alert"))


def alert_messages(flags: DataFrame, only_alerts: bool = False, keys: tuple[str, ...] = ("metric",),
                   order: str = "ts") -> DataFrame:
    """Alert text per series: current value (.2f) and change versus the
    previous point, ``1 - current/previous`` (.2%).  Slice keys besides the
    metric stand in the output and, in brackets, in the text.

    ``only_alerts=False`` keeps every series (the reference sends them all).
    """
    change = F.lit(1.0) - safe_div(F.col("value"), F.col("prev_value"))
    text = F.concat(
        F.lit("Metric "), F.col("metric"), *[
            x for k in keys if k != "metric"
            for x in (F.lit(f" [{k} = "), F.coalesce(F.col(k).cast("string"), F.lit("none")), F.lit("]"))],
        F.lit(": current value "), fmt_fixed(F.col("value"), 2),
        F.lit(", change from previous value "), fmt_percent(change, 2),
    )
    out = flags.select(*keys, order, "is_alert", change.alias("change"), text.alias("message"))
    return out.filter(F.col("is_alert")) if only_alerts else out
