"""Poisson draws of any mean against their exact probabilities."""

import math

import pytest
from pyspark.sql import functions as F

from pulsekit.functions import poisson
from pulsekit.operators.experiment import resample


def log_p(k, m):
    return k * math.log(m) - m - math.lgamma(k + 1)


def test_log_probability(spark):
    rows = [(float(k), float(m)) for m in (16, 47, 1000, 10 ** 6)
            for k in (0, 1, 3, 9, 10, 11, 25, m, m + 1, round(m + 5 * math.sqrt(m)))]
    got = spark.createDataFrame(rows, "k double, m double").select("k", "m", F.expr(poisson.log_probability_sql("k", "m")).alias("p"))
    for r in got.collect():
        assert r["p"] == pytest.approx(log_p(r["k"], r["m"]), rel=1e-9, abs=1e-6 if r["m"] > 1e5 else 1e-10)


@pytest.mark.parametrize("m", [1, 5, 15, 16, 23, 64, 300])
def test_draws_follow_the_distribution(spark, m):
    n = 20_000
    cells = spark.createDataFrame([(f"c{m}", m)], "cell string, m long")
    w = resample.poisson_weights(cells, ["cell"], n, 5).groupBy("rep").agg(F.sum("weight").alias("w"))
    seen = {r["w"]: r["n"] for r in w.groupBy("w").agg(F.count("*").alias("n")).collect()}
    # replicates without any part of weight count as 0
    assert sum(seen.values()) == n
    chi, cells_used, rest_p, rest_n = 0.0, 0, 1.0, n
    for k in range(m + 12 * int(math.sqrt(m)) + 25):
        e = n * math.exp(log_p(k, m))
        if e >= 8:
            chi += (seen.get(k, 0) - e) ** 2 / e
            cells_used, rest_p, rest_n = cells_used + 1, rest_p - e / n, rest_n - seen.get(k, 0)
    e = max(rest_p * n, 1e-9)
    chi += (rest_n - e) ** 2 / e if e >= 1 else 0
    assert chi < cells_used + 5 * math.sqrt(2 * cells_used) + 5


def test_a_cell_of_many_users(spark):
    """A hot cell is one part, whatever its size, and keeps mean and variance."""
    m = 100_000_000
    cells = spark.createDataFrame([(1, 0, 1, m), (1, 1, 1, 2 * 10 ** 9), (2, 3, 4, 7)], "exp_group int, likes long, views long, m long")
    drawn = resample.poisson_weights(cells, ["exp_group", "likes", "views"], 4000, 9)
    assert drawn.groupBy("exp_group", "likes").agg(F.count("*").alias("n")).where("exp_group = 1 and n <> 4000").count() == 0
    assert drawn.where("exp_group = 2").select("part").distinct().count() == 3
    for r in drawn.where("exp_group = 1").groupBy("m").agg(F.avg("weight").alias("mean"), F.var_samp("weight").alias("var")).collect():
        assert abs(r["mean"] - r["m"]) < 5 * math.sqrt(r["m"] / 4000)
        assert abs(r["var"] / r["m"] - 1) < 5 * math.sqrt(2 / 4000)


def test_draws_are_repeatable_and_differ_by_key(spark):
    cells = spark.createDataFrame([("a", 500), ("b", 500)], "cell string, m long")
    first, again = ({(r["cell"], r["rep"]): r["weight"] for r in resample.poisson_weights(cells, ["cell"], 50, 1).collect()}
                    for _ in range(2))
    assert first == again and [first["a", i] for i in range(50)] != [first["b", i] for i in range(50)]
    assert resample.poisson_weights(cells.limit(0), ["cell"], 5, 1).collect() == []
