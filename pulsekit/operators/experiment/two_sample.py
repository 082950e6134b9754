"""Two-sample tests: Welch's t-test and the Mann-Whitney U test.

Welch: one pass computes n, mean and sample variance of every group named
in the pairs (conditional aggregates, map-side partial), producing one row;
the pairs are then unfolded from that row.  No join, one tiny shuffle.

Mann-Whitney: ranks come from value counts.  Values are aggregated to
(value, n_a, n_b) first -- ties collapse, hot values become one row -- and
the running counts in value order come from the range-bucketed prefix sum,
so no single task sees all distinct values.  p is two-sided: exact when one
sample has at most ``FEW`` values, the other at most ``EXACT_MOST`` and no value
occurs twice, else the normal approximation with tie and continuity correction.

The exact distribution of U for samples of k and n values is that of the sum of k
parts of at most n each: its counts are the coefficients of the product over
i = 1 .. k of (1 - q^(n+i)) / (1 - q^i).  A table with a row a value of U goes
through these factors: a difference to the row n + i before, a running sum over
every i-th row.  The rows of one remainder by n + i, or by i, are a window partition.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsekit.functions.stats import normal_two_sided_p, welch_columns
from pulsekit.operators.prefix import exclusive_prefix, ranges_of
from pulsekit.operators.spread import materialize

#: Sizes of the smaller and of the larger sample up to which p is exact: the table of
#: U has at most FEW * EXACT_MOST / 2 + 1 rows.
FEW, EXACT_MOST = 8, 10_000


def welch_test(df: DataFrame, value_col: str, pairs, group_col: str = "exp_group") -> DataFrame:
    """One row per (group_a, group_b): n, mean, var of each side, t, df, p."""
    groups = sorted({g for p in pairs for g in p})
    v = F.col(value_col)
    aggs = []
    for g in groups:
        sel = F.when(F.col(group_col) == F.lit(g), v)
        aggs += [F.count(sel).alias(f"n_{g}"), F.avg(sel).alias(f"m_{g}"), F.var_samp(sel).alias(f"v_{g}")]
    one = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(a).alias("group_a"), F.lit(b).alias("group_b"),
                 F.col(f"n_{a}").alias("n_a"), F.col(f"n_{b}").alias("n_b"),
                 F.col(f"m_{a}").alias("mean_a"), F.col(f"m_{b}").alias("mean_b"),
                 F.col(f"v_{a}").alias("var_a"), F.col(f"v_{b}").alias("var_b"))
        for a, b in pairs])
    t = one.select(F.inline(rows))
    w = welch_columns(F.col("n_a").cast("double"), F.col("mean_a"), F.col("var_a"),
                      F.col("n_b").cast("double"), F.col("mean_b"), F.col("var_b"))
    return t.select("*", *[c.alias(k) for k, c in w.items()])


def value_counts(df: DataFrame, value_col: str, a, b, group_col: str = "exp_group") -> DataFrame:
    """(value, n_a, n_b, n_all): counts at each distinct value."""
    return (df.filter(F.col(group_col).isin(a, b) & F.col(value_col).isNotNull())
              .groupBy(F.col(value_col).alias("value"))
              .agg(F.count_if(F.col(group_col) == F.lit(a)).alias("n_a"),
                   F.count_if(F.col(group_col) == F.lit(b)).alias("n_b"))
              .withColumn("n_all", F.col("n_a") + F.col("n_b")))


def u_distribution(spark: SparkSession, k: int, n: int) -> DataFrame:
    """(u, p): the two-sided exact p of every U up to half of k * n, the smaller of
    the two samples' U, when no values are tied."""
    top = k * n // 2
    u = F.col("u")
    table = spark.range(top + 1).select(
        F.col("id").alias("u"), F.when(F.col("id") == 0, F.lit(1.0 / math.comb(n + k, k))).otherwise(F.lit(0.0)).alias("p"))

    def every(step: int):
        return Window.partitionBy(F.pmod(u, F.lit(step))).orderBy("u")

    for i in range(1, k + 1):
        if n + i <= top:
            table = table.withColumn("p", F.col("p") - F.coalesce(F.lag("p").over(every(n + i)), F.lit(0.0)))
        table = table.withColumn("p", F.sum("p").over(every(i).rowsBetween(Window.unboundedPreceding, 0)))
    # both tails
    both = F.lit(2.0) * F.sum("p").over(every(1).rowsBetween(Window.unboundedPreceding, 0))
    return table.select("u", F.least(both, F.lit(1.0)).alias("p"))


def mann_whitney(df: DataFrame, value_col: str, a, b, group_col: str = "exp_group",
                 n_ranges: int | None = None, method: str = "auto") -> DataFrame:
    """One row: n_a, n_b, u_a (U of sample a), u_b, z, p_value, and the exact
    P(A > B) / P(A = B) over all cross-group pairs.  ``method``: auto (see the module)
    or asymptotic; the column of that name says which it was."""
    counts = materialize(value_counts(df, value_col, a, b, group_col))
    # four numbers choose the ranges and the method
    size = counts.agg(F.count("*").alias("values"), F.coalesce(F.sum("n_a"), F.lit(0)).alias("a"),
                      F.coalesce(F.sum("n_b"), F.lit(0)).alias("b"), F.max("n_all").alias("most")).first()
    small, large = sorted((size["a"], size["b"]))
    exact = method == "auto" and 0 < small <= FEW and large <= EXACT_MOST and size["most"] == 1
    r = exclusive_prefix(counts, "value", ["n_all", "n_b"], n_ranges=n_ranges or ranges_of(size["values"]), checkpoint=False)
    avg_rank = F.col("before_n_all") + (F.col("n_all") + F.lit(1)) / F.lit(2.0)
    t = F.col("n_all").cast("double")
    s = r.agg(
        F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"),
        F.sum(F.col("n_a").cast("double") * avg_rank).alias("r_a"),
        F.sum(t * t * t - t).alias("ties"),
        # products of counts pass the range of a long
        F.sum(F.col("n_a").cast("double") * F.col("before_n_b")).alias("gt"),
        F.sum(F.col("n_a").cast("double") * F.col("n_b")).alias("eq"),
    )
    na, nb = F.col("n_a").cast("double"), F.col("n_b").cast("double")
    n = na + nb
    u_a = F.col("r_a") - na * (na + F.lit(1.0)) / F.lit(2.0)
    u_b = na * nb - u_a
    mu = na * nb / F.lit(2.0)
    sd = F.sqrt(na * nb / F.lit(12.0) * ((n + F.lit(1.0)) - F.try_divide(F.col("ties"), n * (n - F.lit(1.0)))))
    z = F.when(sd > 0, (F.greatest(u_a, u_b) - mu - F.lit(0.5)) / sd)
    pairs = na * nb
    p = normal_two_sided_p(z)
    if exact:
        least_u = F.least(u_a, u_b).cast("long")
        s = s.join(u_distribution(df.sparkSession, small, large), least_u == F.col("u"), "left")
        p = F.col("p")
    return s.select(
        F.lit(a).alias("group_a"), F.lit(b).alias("group_b"),
        F.col("n_a").cast("long").alias("n_a"), F.col("n_b").cast("long").alias("n_b"),
        u_a.alias("u_a"), u_b.alias("u_b"), z.alias("z"),
        p.alias("p_value"),
        F.lit("exact" if exact else "asymptotic").alias("method"),
        F.try_divide(F.col("gt").cast("double"), pairs).alias("prob_a_gt_b"),
        F.try_divide(F.col("eq").cast("double"), pairs).alias("prob_a_eq_b"),
    )
