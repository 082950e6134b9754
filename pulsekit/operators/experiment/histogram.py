"""Equal-width histograms per group (the data behind every distribution
plot): counts per (group, bin), edges from the global min/max or given.
Output rows: groups x bins at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, value_col: str, bins: int = 20, group_cols: tuple = (),
              lo: float | None = None, hi: float | None = None) -> DataFrame:
    value = F.col(value_col).cast("double")
    v = df.filter(value.isNotNull() & ~F.isnan(value)).select(*group_cols, value.alias("v"))
    # edges that aren't given are scalar subqueries: building the frame runs no job
    low = F.lit(float(lo)) if lo is not None else v.agg(F.min("v")).scalar()
    high = F.lit(float(hi)) if hi is not None else v.agg(F.max("v")).scalar()
    v = v.withColumn("lo", low).withColumn("hi", high)
    raw = F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo")) * F.lit(float(bins)))
    b = F.when(F.col("hi") > F.col("lo"), F.least(F.greatest(raw, F.lit(0)), F.lit(bins - 1))).otherwise(F.lit(0))
    agg = v.groupBy(*group_cols, b.cast("int").alias("bin"), "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return agg.select(*group_cols, "bin",
                      (F.col("lo") + F.col("bin") * w).alias("lower"),
                      (F.col("lo") + (F.col("bin") + 1) * w).alias("upper"),
                      "count")
