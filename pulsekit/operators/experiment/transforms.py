"""Metric transforms: smoothed CTR, linearized likes, hash buckets.

Group-level numbers (global CTR per group, the control mapping) are one
row per experiment group; they are broadcast to the user rows if they are few.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsekit.functions.columns import safe_div
from pulsekit.functions.hashing import hash_bucket
from pulsekit.operators.experiment.user_metrics import global_ctr
from pulsekit.operators.spread import broadcast_if_few


def smoothed_ctr(users: DataFrame, alpha: float = 5.0, group_col: str = "exp_group") -> DataFrame:
    """(likes + alpha * G) / (views + alpha), G = global CTR of the user's group."""
    g = global_ctr(users, group_col).select(group_col, "global_ctr")
    j = users.join(broadcast_if_few(g), group_col, "left")
    sm = (F.col("likes") + F.lit(alpha) * F.col("global_ctr")) / (F.col("views") + F.lit(alpha))
    return j.withColumn("smoothed_ctr", sm).drop("global_ctr")


def lin_likes(users: DataFrame, control: dict[int, int], group_col: str = "exp_group") -> DataFrame:
    """likes - G_c * views, G_c = global CTR of the control group mapped to
    the user's group.  Groups without a mapping are dropped."""
    spark = users.sparkSession
    cmap = spark.createDataFrame(sorted(control.items()), f"{group_col} int, control_group int")
    g = global_ctr(users, group_col).select(F.col(group_col).alias("control_group"),
                                            F.col("global_ctr").alias("control_ctr"))
    m = cmap.join(g, "control_group")        # one row per mapped group
    j = users.join(broadcast_if_few(m), group_col, "inner")
    return j.withColumn("lin_likes", F.col("likes") - F.col("control_ctr") * F.col("views")) \
            .drop("control_group", "control_ctr")


def bucket_ctr(users: DataFrame, n_buckets: int = 50, q: float | None = 0.9, method: str = "md5",
               group_col: str = "exp_group", q_name: str = "ctr9") -> DataFrame:
    """Per (group, bucket): sum(likes)/sum(views) and the exact ``q`` quantile
    of user CTR (``method``: see ``hash_bucket``): the element at 0-based position floor(q * n) of the sorted
    values (NULL CTRs left out).  ``q`` None leaves the quantile out, for tests
    that read only the ratio.

    The quantile is found from value counts: distinct (bucket, ctr) cells are
    aggregated first, then a running count per bucket picks the element --
    no bucket's values are gathered into one array.
    """
    b = users.withColumn("bucket", hash_bucket("user_id", n_buckets, method))
    keys = [group_col, "bucket"]
    ratio = b.groupBy(*keys).agg(
        safe_div(F.sum("likes"), F.sum("views")).alias("bucket_ctr"),
        F.count("ctr").alias("_n"))
    if q is None:
        return ratio.drop("_n")
    cells = b.filter(F.col("ctr").isNotNull()).groupBy(*keys, "ctr").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*keys).orderBy("ctr").rowsBetween(Window.unboundedPreceding, 0)
    cum = cells.withColumn("_cum", F.sum("_c").over(w)).join(ratio.select(*keys, "_n"), keys)
    target = F.least(F.floor(F.lit(q) * F.col("_n")), F.col("_n") - 1)
    qv = (cum.filter((F.col("_cum") > target) & (F.col("_cum") - F.col("_c") <= target))
             .select(*keys, F.col("ctr").alias(q_name)))
    return ratio.drop("_n").join(qv, keys, "left")
