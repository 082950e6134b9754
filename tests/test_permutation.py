"""Keyed permutations and the A/A samples they give."""

import math

import pytest
from pyspark.sql import functions as F

from pulsekit.functions.permutation import ROUNDS, round_keys, with_permuted
from pulsekit.operators.experiment import resample

KEYS = [f"k{r}" for r in range(ROUNDS)]


def permuted(spark, sims, n, k=None):
    rows = (spark.range(sims).select(F.col("id").alias("sim"), F.lit(n).cast("long").alias("n"))
            .select("*", *[c.alias(x) for x, c in zip(KEYS, round_keys(F.lit(4), F.col("sim")))])
            .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((k or n) - 1).cast("long"))).alias("j")))
    return with_permuted(rows, "j", "n", KEYS, "y").select("sim", "j", "y")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 90, 1000])
def test_every_image_once(spark, n):
    r = permuted(spark, 20, n).groupBy("sim").agg(F.count_distinct("y").alias("c"), F.min("y").alias("a"), F.max("y").alias("b"))
    assert {(x["c"], x["a"], x["b"]) for x in r.collect()} == {(n, 0, n - 1)}


def test_samples_are_uniform(spark):
    """How often each number, and each pair of numbers, is among the first k."""
    n, k, sims = 23, 5, 20_000
    d = permuted(spark, sims, n, k)
    one = {r["y"]: r["c"] for r in d.groupBy("y").agg(F.count("*").alias("c")).collect()}
    e = sims * k / n
    assert sum((one.get(y, 0) - e) ** 2 / (e * (1 - k / n)) for y in range(n)) < n + 5 * math.sqrt(2 * n)
    two = d.alias("a").join(d.alias("b"), (F.col("a.sim") == F.col("b.sim")) & (F.col("a.y") < F.col("b.y")))
    pairs = [r["c"] for r in two.groupBy("a.y", "b.y").agg(F.count("*").alias("c")).collect()]
    e = sims * k * (k - 1) / (n * (n - 1))
    assert len(pairs) == n * (n - 1) // 2
    assert sum((c - e) ** 2 / e for c in pairs) < len(pairs) + 6 * math.sqrt(2 * len(pairs))


def test_aa_of_five_hundred(spark):
    """500 of 2,000 users a group: sizes, distinct users, and a true null hypothesis."""
    users = spark.range(4000).select((F.col("id") % 2 + 2).cast("int").alias("exp_group"), F.col("id").alias("user_id"),
                                     F.randn(3).alias("ctr"))
    users = users.checkpoint() if users.sparkSession.sparkContext.getCheckpointDir() else users
    sims = resample.aa_simulation(users, "ctr", (2, 3), 400).toPandas()
    assert len(sims) == 400 and set(sims.n_a) == set(sims.n_b) == {500}
    assert sims.p_value.nunique() > 390
    half = resample.aa_simulation(users, "ctr", (2, 3), 3, k=500, most_share=0.1).toPandas()
    assert set(half.n_a) == set(half.n_b) == {200}
    whole = resample.aa_simulation(users, "ctr", (2, 3), 3, k=2000).toPandas()
    assert whole.mean_a.round(9).nunique() == 1
