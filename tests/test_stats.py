"""Closed-form and brute-force checks of the statistical building blocks."""

import hashlib
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsekit.functions.hashing import ab_split, uniform01
from pulsekit.functions.stats import normal_two_sided_p, poisson_cdf_table, poisson_draw, t_two_sided_p
from pulsekit.operators.experiment import two_sample as T
from pulsekit.operators.prefix import exclusive_prefix


def t_tail(spark, t, dof):
    rows = [(i, float(x), float(d)) for i, (x, d) in enumerate(zip(t, dof))]
    df = spark.createDataFrame(rows, "i int, t double, d double")
    return np.array([r.p for r in df.select("i", t_two_sided_p(F.col("t"), F.col("d")).alias("p")).orderBy("i").collect()])


def normal_tail(spark, z):
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(z)], "i int, z double")
    return np.array([r.p for r in df.select("i", normal_two_sided_p(F.col("z")).alias("p")).orderBy("i").collect()])


def test_t_tail_closed_forms(spark):
    t = np.array([0.0, 1e-9, 1e-4, 0.01, 0.5, 1.0, 2.5, 7.0, -3.0, 40.0, 1e4])
    a = np.abs(t)
    # df = 1: Cauchy; the tail by the arc tangent of the inverse keeps small p exact
    p1 = t_tail(spark, t, np.full_like(t, 1.0))
    with np.errstate(divide="ignore"):
        assert np.allclose(p1, 2 / math.pi * np.arctan(1 / a), rtol=1e-10, atol=0)
    # df = 2: p = 1 - |t| / sqrt(t^2 + 2) = 2 / (r * (r + |t|)), r = sqrt(t^2 + 2)
    p2 = t_tail(spark, t, np.full_like(t, 2.0))
    r = np.sqrt(t * t + 2)
    assert np.allclose(p2, 2 / (r * (r + a)), rtol=1e-10, atol=0)
    # df = 3: p = 1 - 2/pi (atan(x) + x / (1 + x^2)), x = t / sqrt 3
    x = a / math.sqrt(3)
    p3 = t_tail(spark, t, np.full_like(t, 3.0))
    assert np.allclose(p3, 1 - 2 / math.pi * (np.arctan(x) + x / (1 + x * x)), rtol=1e-10, atol=1e-15)


def even_dof_tail(t, n):
    """p for an even number n of degrees of freedom: a finite sum (with mpmath's part
    played by exact rational numbers)."""
    from fractions import Fraction
    c2 = Fraction(n) / (n + Fraction(t) ** 2)          # cos^2 of the angle
    term, total = Fraction(1), Fraction(1)
    for k in range(1, n // 2):
        term *= c2 * (2 * k - 1) / (2 * k)
        total += term
    # 1 - sin * total, from 1 - sin^2 total^2 so that nothing cancels
    return float((1 - (1 - c2) * total ** 2) / (1 + Fraction(math.sqrt(1 - c2)) * total))


def test_t_tail_of_small_p(spark):
    cases = [(t, n) for n in (4, 10, 40, 200) for t in (0.25, 2.0, 8.0, 30.0, 500.0)]
    got = t_tail(spark, *zip(*cases))
    assert got == pytest.approx([even_dof_tail(t, n) for t, n in cases], rel=1e-10)


def test_t_tail_large_df_approaches_normal(spark):
    t = np.array([0.3, 1.96, 3.0, 12.0])
    want = np.array([math.erfc(v / math.sqrt(2)) for v in t])
    assert np.allclose(t_tail(spark, t[:3], np.full(3, 1e6)), want[:3], rtol=1e-4, atol=0)
    assert np.allclose(t_tail(spark, t, np.full(4, 1e14)), want, rtol=1e-9, atol=0)


def test_tails_without_a_value(spark):
    nan, inf = float("nan"), float("inf")
    assert t_tail(spark, [nan, 1.0, 1.0, 1.0], [3.0, nan, 0.0, -1.0]).tolist() == [None] * 4
    assert t_tail(spark, [inf, -inf, 1e200], [3.0, 5.0, 50.0]).tolist() == [0.0] * 3
    assert normal_tail(spark, [nan, inf, -inf]).tolist() == [None, 0.0, 1.0]


def test_normal_tail_against_erfc(spark):
    z = np.array([-0.4, 0.0, 1e-9, 1e-3, 0.5, 1.96, 4.0, 8.0, 20.0, 36.0])
    want = np.minimum(np.array([math.erfc(v / math.sqrt(2)) for v in z]), 1.0)
    assert np.allclose(normal_tail(spark, z), want, rtol=1e-10, atol=0)


def test_split_matches_python_md5(spark):
    ids = list(range(0, 400, 3)) + [10 ** 12 + 7]
    df = spark.createDataFrame([(i,) for i in ids], "user_id long")
    for n in (2, 5, 7, 50):
        got = dict(df.select("user_id", ab_split("user_id", "exp_mess_1", n).alias("g")).collect())
        for i in ids:
            want = int(hashlib.md5(f"{i}-exp_mess_1".encode()).hexdigest(), 16) % n
            assert got[i] == want
        got2 = dict(df.select("user_id", ab_split(F.col("user_id"), None, n).alias("g")).collect())
        for i in ids:
            assert got2[i] == int(hashlib.md5(str(i).encode()).hexdigest(), 16) % n


def test_poisson_weights(spark):
    assert poisson_cdf_table(1.0)[0] == pytest.approx(math.exp(-1))
    df = spark.range(200000).select(poisson_draw(uniform01(F.lit(7), F.col("id")), 1.0).alias("w"))
    row = df.agg(F.avg("w").alias("m"), F.var_samp("w").alias("v"), F.min("w").alias("lo")).first()
    assert row.lo == 0
    assert abs(row.m - 1.0) < 0.01 and abs(row.v - 1.0) < 0.02


def test_prefix_sums_match_cumsum(spark):
    rnd = random.Random(3)
    rows = [(g, float(v), rnd.randint(1, 5)) for g in (1, 2) for v in rnd.sample(range(10000), 500)]
    df = spark.createDataFrame(rows, "g int, x double, c long")
    got = exclusive_prefix(df, "x", ["c"], by=["g"], n_ranges=16).toPandas()
    pdf = pd.DataFrame(rows, columns=["g", "x", "c"]).sort_values(["g", "x"])
    pdf["want"] = pdf.groupby("g")["c"].cumsum() - pdf["c"]
    m = got.merge(pdf, on=["g", "x", "c"])
    assert len(m) == len(rows)
    assert (m["before_c"] == m["want"]).all()


def _brute_u(a, b):
    gt = sum(1 for x in a for y in b if x > y)
    eq = sum(1 for x in a for y in b if x == y)
    return gt + 0.5 * eq, gt, eq


def test_mann_whitney_against_brute_force(spark):
    rnd = random.Random(11)
    a = [rnd.choice([0.1, 0.2, 0.25, 0.5, 0.7]) for _ in range(300)]
    b = [rnd.choice([0.1, 0.2, 0.3, 0.5, 0.9]) for _ in range(250)]
    df = spark.createDataFrame([(1, v) for v in a] + [(2, v) for v in b], "exp_group int, v double")
    r = T.mann_whitney(df, "v", 1, 2, n_ranges=4).first()
    u, gt, eq = _brute_u(a, b)
    assert r.u_a == pytest.approx(u)
    assert r.u_a + r.u_b == pytest.approx(len(a) * len(b))
    assert r.prob_a_gt_b == pytest.approx(gt / (len(a) * len(b)))
    assert r.prob_a_eq_b == pytest.approx(eq / (len(a) * len(b)))
    assert 0.0 <= r.p_value <= 1.0


def test_mann_whitney_all_ties_gives_null_p(spark):
    df = spark.createDataFrame([(1, 0.5)] * 4 + [(2, 0.5)] * 3, "exp_group int, v double")
    r = T.mann_whitney(df, "v", 1, 2).first()
    assert r.p_value is None and r.z is None


def test_welch_tiny_group_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.1), (2, 0.3)], "exp_group int, v double")
    r = T.welch_test(df, "v", [(1, 2)]).first()
    assert r.n_a == 1 and r.t_stat is None and r.dof is None and r.p_value is None


def test_welch_matches_formula(spark):
    rnd = random.Random(5)
    a = [rnd.gauss(0.3, 0.1) for _ in range(40)]
    b = [rnd.gauss(0.35, 0.2) for _ in range(55)]
    df = spark.createDataFrame([(1, v) for v in a] + [(2, v) for v in b], "exp_group int, v double")
    r = T.welch_test(df, "v", [(1, 2)]).first()
    va, vb = np.var(a, ddof=1) / len(a), np.var(b, ddof=1) / len(b)
    t = (np.mean(a) - np.mean(b)) / math.sqrt(va + vb)
    dof = (va + vb) ** 2 / (va ** 2 / (len(a) - 1) + vb ** 2 / (len(b) - 1))
    assert r.t_stat == pytest.approx(t)
    assert r.dof == pytest.approx(dof)
    assert r.p_value == pytest.approx(t_tail(spark, [t], [dof])[0], rel=1e-9)


def test_prefix_sums_whatever_the_ranges(spark):
    import pulsekit.operators.prefix as prefix
    assert prefix.ranges_for(spark.range(10)) == prefix.LEAST_RANGES
    rows = [(g, float(v), 1) for g in (1, 2, 3) for v in range(200)]
    df = spark.createDataFrame(rows, "g int, x double, c long")
    got = prefix.exclusive_prefix(df, "x", ["c"], by=["g"], n_ranges=8).toPandas()
    assert len(got) == 600
    assert (got["before_c"] == got["x"].astype(int)).all()


def test_dense_index_is_a_bijection(spark):
    from pulsekit.operators.prefix import dense_index
    rows = [(g, u) for g in (1, 2) for u in range(g * 1000, g * 1000 + 300 + g)]
    out = dense_index(spark.createDataFrame(rows, "g int, user_id long"), ["g"], "user_id").toPandas()
    for g, part in out.groupby("g"):
        assert sorted(part["idx"]) == list(range(len(part)))


@pytest.mark.parametrize("t,df,p", [
    (12.706204736432095, 1.0, 0.05), (2.2281388519649385, 10.0, 0.05), (1.0, 8.0, 0.34659350708733416),
    (1.9719565442493954, 199.0, 0.05), (1.9718962236316089, 200.0, 0.05), (1.9718365041462513, 201.0, 0.05),
    (1.9599663568160847, 1e6, 0.05)])
def test_t_tail_at_known_points(spark, t, df, p):
    assert t_tail(spark, [t], [df])[0] == pytest.approx(p, abs=2e-8)


def test_t_tail_has_no_step(spark):
    df = np.linspace(150, 250, 401)
    p = t_tail(spark, np.full(len(df), 2.0), df)
    assert (np.diff(p) < 0).all() and np.abs(np.diff(p, 2)).max() < 2e-8
