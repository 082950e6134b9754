"""Options beyond the reference defaults."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsekit.operators import feed as feedm, intraday
from pulsekit.operators.experiment import resample, user_metrics as um
from pulsekit.params import DEFAULT_PARAMS as P
from pulsekit.sources import load_fixture_tables
from tests.conftest import SF_SMALL


def test_metrics_15m_options(spark):
    fd, ms = load_fixture_tables(spark, SF_SMALL)
    base = intraday.metrics_15m(fd, ms, P.as_of_ts)
    dense = intraday.metrics_15m(fd, ms, P.as_of_ts, ctr_default=0.0, include_received=True, densify=True)
    start, end = intraday.alert_window(P.as_of_ts)
    n_grid = int((end - start) / dt.timedelta(minutes=15))
    assert dense.count() == n_grid
    assert base.count() <= n_grid
    # message-only and empty buckets get CTR 0 with ctr_default; feed buckets
    # with likes but no views keep a NULL ratio
    assert dense.filter(F.col("ctr").isNull() & (F.col("users_feed") == 0)).count() == 0
    assert dense.filter(F.col("ctr").isNull() & (F.col("views") > 0)).count() == 0
    assert "users_received" in dense.columns
    # the filled grid keeps every real bucket's counts
    j = base.alias("b").join(dense.alias("d"), "ts")
    assert j.filter(F.col("b.views") != F.col("d.views")).count() == 0
    assert j.count() == base.count()


def test_approx_dau_close_to_exact(spark):
    fd, _ = load_fixture_tables(spark, "/root/testdata/sf0.01")
    exact = {r.event_date: r.dau for r in feedm.feed_week(fd, P.as_of).collect()}
    approx = {r.event_date: r.dau for r in feedm.feed_week(fd, P.as_of, approx=True).collect()}
    assert exact.keys() == approx.keys()
    for d in exact:
        assert abs(exact[d] - approx[d]) <= max(2, 0.05 * exact[d])


def test_aa_with_replacement(spark):
    fd, _ = load_fixture_tables(spark, "/root/testdata/sf0.01")
    users = um.user_ctr(fd, P.exp_start, P.exp_end, P.aa_groups)
    sims = resample.aa_simulation(users, "ctr", P.aa_groups, n_sims=200, k=30, seed=3, replace=True)
    rows = sims.collect()
    assert len(rows) == 200
    assert all(r.n_a == 30 and r.n_b == 30 for r in rows)
    assert all(r.p_value is None or 0.0 <= r.p_value <= 1.0 for r in rows)


def test_aa_draws_exactly_k_up_to_the_whole_group(spark):
    fd, _ = load_fixture_tables(spark, "/root/testdata/sf0.01")
    users = um.user_ctr(fd, P.exp_start, P.exp_end, P.aa_groups)
    n = min(r.n for r in users.filter(F.col("ctr").isNotNull())
            .groupBy("exp_group").agg(F.count("*").alias("n")).collect())
    for k in (2, n // 2, n - 3, n):
        rows = resample.aa_simulation(users, "ctr", P.aa_groups, n_sims=50, k=k, seed=9).collect()
        assert len(rows) == 50 and all(r.n_a == k and r.n_b == k for r in rows)
    with pytest.raises(Exception, match="an A/A sample of"):
        resample.aa_simulation(users, "ctr", P.aa_groups, n_sims=5, k=n + 1, seed=9).collect()
    assert P.aa_sample_size == 500


def test_aa_variance_of_large_values(spark):
    rows = [(g, 100 * g + i, 1e9 + i % 7) for g in (2, 3) for i in range(20)]
    users = spark.createDataFrame(rows, "exp_group int, user_id long, ctr double")
    got = resample.aa_simulation(users, "ctr", (2, 3), n_sims=20, k=20, seed=1).collect()
    want = pd.Series([1e9 + i % 7 for i in range(20)])
    assert all(abs(r.mean_a - want.mean()) < 1e-3 and r.t_stat == 0 and abs(r.dof - 38) < 1e-6 for r in got)
    got = resample.aa_simulation(users, "ctr", (2, 3), n_sims=20, k=15, seed=1).collect()
    assert all(r.p_value is not None and 0 <= r.p_value <= 1 for r in got)
    share = resample.false_positive_rate(spark.createDataFrame([(0.01,), (None,), (0.5,), (0.6,)], "p_value double")).first()
    assert (share.n_sims, share.n_significant, share.n_undefined, share.share) == (4, 1, 1, 0.25)


def test_bootstrap_weights_are_poisson_of_the_cell(spark):
    m = 200                                          # 64 three times, and 8
    users = spark.createDataFrame([(1, i, 1, 1) for i in range(m)] + [(2, 1000, 1, 1)],
                                  "exp_group int, user_id long, likes long, views long")
    got = resample.poisson_bootstrap(users, (1, 2), 4000, seed=3).toPandas()
    w = got[got.exp_group == 1].views
    assert abs(w.mean() - m) < 4 * (m / 4000) ** 0.5
    assert 0.9 < w.var() / m < 1.1
    one = got[got.exp_group == 2].views
    assert abs(one.mean() - 1) < 0.1 and 0.9 < one.var() < 1.1
