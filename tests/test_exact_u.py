"""The exact Mann-Whitney p against all choices of ranks."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from pulsekit.operators.experiment import two_sample


@pytest.mark.parametrize("k,n", [(1, 1), (1, 6), (3, 3), (2, 9), (5, 7), (6, 6)])
def test_table_equals_all_choices(spark, k, n):
    us = [sum(c) - k * (k + 1) // 2 for c in itertools.combinations(range(1, k + n + 1), k)]
    got = {r["u"]: r["p"] for r in two_sample.u_distribution(spark, k, n).collect()}
    assert sorted(got) == list(range(k * n // 2 + 1))
    for u, p in got.items():
        assert p == pytest.approx(min(1.0, 2 * sum(x <= u for x in us) / len(us)), abs=1e-12)


def test_table_of_a_large_sample(spark):
    """Moments of U for 8 and 300 values: the tail's last value is the half."""
    got = {r["u"]: r["p"] for r in two_sample.u_distribution(spark, 8, 300).collect()}
    assert got[0] == pytest.approx(2 / math.comb(308, 8), rel=1e-9) and got[1200] == 1.0
    assert all(got[u] <= got[u + 1] + 1e-12 for u in range(1199))
    sd = math.sqrt(8 * 300 * 309 / 12)
    assert got[round(1200 - 1.96 * sd)] == pytest.approx(0.05, abs=0.005)


def both(spark, a, b, **options):
    df = spark.createDataFrame([(1, float(x)) for x in a] + [(2, float(x)) for x in b], "exp_group int, v double")
    return two_sample.mann_whitney(df, "v", 1, 2, **options).first()


def test_method_follows_sizes_and_ties(spark):
    # closed form: 5 of 126 choices of ranks are as far out on one side
    row = both(spark, [1, 2, 3, 4, 6], [5, 7, 8, 9])
    us = [sum(c) - 15 for c in itertools.combinations(range(1, 10), 5)]
    assert row["method"] == "exact" and row["p_value"] == pytest.approx(2 * sum(u <= 1 for u in us) / 126)
    assert both(spark, [1, 2, 3, 4, 6], [5, 7, 8, 9], method="asymptotic")["method"] == "asymptotic"
    assert both(spark, [1, 2, 3, 4, 5], [5, 7, 8, 9])["method"] == "asymptotic"
    assert both(spark, range(9), [x + 0.5 for x in range(9)])["method"] == "asymptotic"
    assert both(spark, range(8), [x + 0.5 for x in range(40)])["method"] == "exact"
    empty = both(spark, [], [1, 2])
    assert empty["n_a"] is None or empty["n_a"] == 0
    assert empty["p_value"] is None
