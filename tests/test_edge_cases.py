"""Hand-made frames for the semantic traps listed in FIXTURES.md section 3."""

import datetime as dt
import os
import subprocess
import sys

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pulsekit.functions.columns import fmt_fixed, fmt_percent, round_half_even
from pulsekit.operators import anomaly, audience, mart, messaging
from pulsekit.operators.experiment import resample, transforms, two_sample, user_metrics as um
from pulsekit.operators.experiment.histogram import histogram
from pulsekit.sources import create_mart_table, read_mart, write_mart
from tests.conftest import ROOT, SF_SMALL

FEED = "user_id long, time timestamp_ntz, action string, gender int, age int, os string, exp_group int"
MSG = "user_id long, receiver_id long, time timestamp_ntz, gender int, age int, os string"
D = dt.datetime(2024, 1, 14, 10, 0)
AS_OF = dt.date(2024, 1, 15)


def feed_rows(spark, rows):
    return spark.createDataFrame(rows, FEED)


def test_zero_views_gives_null_ctr(spark):
    f = feed_rows(spark, [(1, D, "like", 0, 20, "iOS", 1), (2, D, "view", 1, 30, "iOS", 1)])
    u = {r.user_id: r for r in um.user_ctr(f, D.date(), D.date()).collect()}
    assert u[1].likes == 1 and u[1].views == 0 and u[1].ctr is None
    assert u[2].ctr == 0.0


def test_half_even_rounding_and_text(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (1.005,), (None,)], "x double")
    got = df.select(round_half_even(F.col("x"), 2).alias("r"), fmt_fixed(F.col("x")).alias("s"),
                    fmt_percent(F.col("x")).alias("p")).collect()
    # the scaled value is rounded: 0.125*100 = 12.5 -> 12; 1.005*100 = 100.49999999999999 -> 100
    assert [r.r for r in got[:3]] == [0.12, 0.38, 1.0]
    assert [r.s for r in got] == ["0.12", "0.38", "1.00", "nan"]
    assert got[0].p == "12.50%" and got[3].p == "nan"


def test_user_zero_and_feed_only(spark):
    f = feed_rows(spark, [(0, D, "view", 0, 20, "iOS", 1), (5, D, "view", 1, 22, "iOS", 1)])
    m = spark.createDataFrame([(5, 0, D, 1, 22, "iOS")], MSG)
    both = audience.dau_both(f, m, AS_OF).collect()
    only = audience.dau_feed_only(f, m, AS_OF).collect()
    monly = audience.dau_message_only(f, m, AS_OF).collect()
    assert both[0].users == 1 and only[0].users == 1 and monly == []


def test_null_dimension_merges_and_fills(spark):
    day = dt.datetime(2024, 1, 15, 9, 0)
    f = feed_rows(spark, [(7, day, "view", None, 30, "iOS", 1), (7, day, "like", None, 30, "iOS", 1)])
    m = spark.createDataFrame([(7, 8, day, None, 30, "iOS")], MSG)
    merged = mart.user_day_merged(f, m, AS_OF).collect()
    assert len(merged) == 1                       # NULL keys matched each other
    r = merged[0]
    assert r.gender == 0 and r.views == 1 and r.likes == 1 and r.messages_sent == 1
    out = {(x.dimension, x.dimension_value): x for x in mart.slice_mart(
        mart.user_day_merged(f, m, AS_OF)).collect()}
    assert out[("gender", "0")].views == 1
    # every dimension sums to the same totals
    totals = pd.DataFrame([x.asDict() for x in out.values()]).groupby("dimension")["views"].sum()
    assert totals.nunique() == 1


def test_fan_out_weighted_versus_true(spark):
    rows = [(1, 2, dt.datetime(2024, 1, 10, h), 0, 20, "iOS") for h in (1, 2, 3)]
    rows += [(1, 2, dt.datetime(2024, 1, 11, h), 0, 20, "iOS") for h in (1, 2)]
    m = spark.createDataFrame(rows, MSG)
    w = {r.event_date.day: r.messages_sent for r in messaging.message_daily_weighted(m, AS_OF).collect()}
    t = {r.event_date.day: r.messages_sent for r in messaging.message_daily(m, AS_OF).collect()}
    assert w == {10: 15, 11: 10}
    assert t == {10: 3, 11: 2}


def test_receive_only_user_option(spark):
    day = dt.datetime(2024, 1, 15, 9, 0)
    m = spark.createDataFrame([(1, 99, day, 0, 20, "iOS")], MSG)
    assert {r.user_id for r in messaging.message_user_slice(m, AS_OF).collect()} == {1}
    got = {r.user_id: r for r in messaging.message_user_slice(m, AS_OF, include_receivers=True).collect()}
    assert set(got) == {1, 99}
    assert got[99].messages_received == 1 and got[99].number_of_senders == 1


@pytest.fixture
def mart_table(spark, tmp_path):
    name = "test_mart_" + tmp_path.name.replace("-", "_")
    create_mart_table(spark, name, str(tmp_path / "mart"))
    yield name
    spark.sql(f"DROP TABLE {name}")


def day_mart(spark, day):
    at = dt.datetime.combine(day, dt.time(9))
    f = feed_rows(spark, [(1, at, "view", 0, 20, "iOS", 1)])
    m = spark.createDataFrame([(1, 2, at, 0, 20, "iOS")], MSG)
    return mart.daily_slice_mart(f, m, day)


def test_mart_rerun_replaces_partition(spark, mart_table):
    before = AS_OF - dt.timedelta(days=1)
    write_mart(day_mart(spark, before), mart_table, before)
    for _ in range(2):
        write_mart(day_mart(spark, AS_OF), mart_table, AS_OF)
        assert read_mart(spark, mart_table).count() == 6
        assert spark.table(mart_table).where(F.col("event_date") == F.lit(AS_OF)).count() == 3


def test_mart_rerun_with_an_empty_day_clears_it(spark, mart_table):
    before = AS_OF - dt.timedelta(days=1)
    write_mart(day_mart(spark, before), mart_table, before)
    write_mart(day_mart(spark, AS_OF), mart_table, AS_OF)
    write_mart(day_mart(spark, AS_OF).where("false"), mart_table, AS_OF)
    assert {r.event_date for r in read_mart(spark, mart_table).collect()} == {before}


def test_mart_refuses_rows_of_another_day(spark, mart_table):
    with pytest.raises(Exception, match="a row of another day"):
        write_mart(day_mart(spark, AS_OF), mart_table, AS_OF - dt.timedelta(days=1))


def test_messages_without_receiver_keep_their_sender(spark):
    at, day = dt.datetime(2024, 1, 14, 10), dt.date(2024, 1, 14)
    f = feed_rows(spark, [(1, at, "view", 0, 20, "iOS", 1), (2, at, "view", 1, 30, "iOS", 1)])
    m = spark.createDataFrame([(1, 9, at, 0, 20, "iOS"), (2, None, at, 1, 30, "iOS")], MSG)
    assert audience.dau_both(f, m, AS_OF).first().users == 2
    assert audience.dau_feed_only(f, m, AS_OF).collect() == []
    rows = {r.user_id: r for r in messaging.message_user_slice(m, day).collect()}
    assert set(rows) == {1, 2}
    assert (rows[2].messages_sent, rows[2].number_of_receivers) == (0, 0)
    assert (rows[1].messages_sent, rows[1].number_of_receivers) == (1, 1)
    for daily in (messaging.message_daily, messaging.message_daily_weighted):
        r = daily(m, AS_OF).first()
        assert (r.number_of_user_id, r.messages_sent, r.number_of_receivers) == (2, 1, 1)


def test_sender_with_two_looks_has_two_rows_with_the_same_totals(spark):
    at, day = dt.datetime(2024, 1, 14, 10), dt.date(2024, 1, 14)
    m = spark.createDataFrame([(1, 9, at, 0, 20, "iOS"), (1, 9, at, 0, 20, "Android"), (9, 1, at, 1, 30, "iOS")], MSG)
    rows = [r for r in messaging.message_user_slice(m, day).collect() if r.user_id == 1]
    assert {r.os for r in rows} == {"iOS", "Android"}
    assert all((r.messages_sent, r.number_of_receivers, r.messages_received, r.number_of_senders) == (2, 1, 1, 1)
               for r in rows)


def test_alert_text_names_its_slice(spark):
    rows = [("dau", os, dt.datetime(2024, 1, 15, 10, 15 * i), float(v)) for os in ("iOS", "Android")
            for i, v in enumerate((1, 2))]
    keys = ("metric", "os")
    bands = anomaly.anomaly_bands(spark.createDataFrame(rows, "metric string, os string, ts timestamp_ntz, value double"),
                                  keys=keys)
    got = anomaly.alert_messages(anomaly.anomaly_flags(bands, keys), keys=keys).collect()
    assert {r.os for r in got} == {"iOS", "Android"}
    assert all(f"[os = {r.os}]" in r.message for r in got)


def test_histogram_leaves_nan_out(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,), (3.0,)], "v double")
    rows = sorted(histogram(df, "v", 2).collect(), key=lambda r: r.bin)
    assert [(r.bin, r.lower, r.upper, r["count"]) for r in rows] == [(0, 1.0, 2.0, 1), (1, 2.0, 3.0, 2)]
    assert histogram(df.where("v is null"), "v", 2).collect() == []


def test_tests_on_tiny_groups_give_null(spark):
    one = spark.createDataFrame([(1, 0.5)], "exp_group int, ctr double")
    r = two_sample.mann_whitney(one, "ctr", 1, 2).first()
    assert r.n_a == 1 and r.n_b == 0 and r.p_value is None and r.prob_a_gt_b is None
    assert two_sample.welch_test(one, "ctr", [(1, 2)]).first().p_value is None
    users = one.withColumn("user_id", F.lit(1).cast("long"))
    assert resample.prob_a_gt_b_mc(users, "ctr", 1, 2, 10).first().share is None
    boot = spark.createDataFrame([(0, 1, 0.5)], "rep long, exp_group int, global_ctr double")
    assert resample.bootstrap_diff(boot, 1, 2).first().share_positive is None


def test_rank_sums_of_billions(spark, monkeypatch):
    counts = spark.createDataFrame([(0.1, 4 * 10**9, 4 * 10**9, 8 * 10**9),
                                    (0.2, 4 * 10**9, 4 * 10**9, 8 * 10**9)],
                                   "value double, n_a long, n_b long, n_all long")
    monkeypatch.setattr(two_sample, "value_counts", lambda *a, **k: counts)
    r = two_sample.mann_whitney(counts, "value", 1, 2).first()
    assert r.prob_a_gt_b == pytest.approx(0.25) and r.prob_a_eq_b == pytest.approx(0.5)


def test_workers_get_the_package(tmp_path):
    """A job started in another folder: the package is only on the driver's path."""
    code = ("import sys; sys.path.insert(0, %r)\n"
            "import __spark_entry__ as E\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "print('ROWS', E.queries()['welch_ctr'](s, %r).count())\n" % (ROOT, SF_SMALL))
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "ROWS 3" in out.stdout, out.stderr[-2000:]


def test_bucket_quantile_edge(spark):
    # 10 users in one bucket, q = 0.9 -> element index 9 (the largest), not 8
    rows = [(1, i, i, 10, i / 10.0) for i in range(10)]
    users = spark.createDataFrame(rows, "exp_group int, user_id long, likes long, views long, ctr double")
    b = transforms.bucket_ctr(users, n_buckets=1, q=0.9).collect()
    assert len(b) == 1 and b[0].ctr9 == pytest.approx(0.9)


def test_smoothing_limits(spark):
    users = spark.createDataFrame([(1, 1, 2, 10), (1, 2, 8, 10)], "exp_group int, user_id long, likes long, views long")
    raw = {r.user_id: r.smoothed_ctr for r in transforms.smoothed_ctr(users, 1e-9).collect()}
    big = {r.user_id: r.smoothed_ctr for r in transforms.smoothed_ctr(users, 1e9).collect()}
    assert raw[1] == pytest.approx(0.2) and raw[2] == pytest.approx(0.8)
    assert big[1] == pytest.approx(0.5, abs=1e-6) and big[2] == pytest.approx(0.5, abs=1e-6)


def test_linearized_likes_sum_to_zero_in_control(spark):
    users = spark.createDataFrame([(0, 1, 2, 10), (0, 2, 5, 7), (3, 3, 1, 4)],
                                  "exp_group int, user_id long, likes long, views long")
    ll = transforms.lin_likes(users, {0: 0, 3: 0})
    s = ll.filter("exp_group = 0").agg(F.sum("lin_likes")).first()[0]
    assert s == pytest.approx(0.0, abs=1e-12)


def _series(spark, values):
    t0 = dt.datetime(2024, 1, 14)
    rows = [("m", t0 + dt.timedelta(minutes=15 * i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "metric string, ts timestamp_ntz, value double")


def test_bands_match_pandas(spark):
    vals = [5, 7, 6, 8, 9, 30, 7, 6, None, 8, 7, 9, 10]
    got = anomaly.anomaly_bands(_series(spark, vals)).orderBy("ts").toPandas()
    s = pd.Series(vals, dtype="float64")
    q25 = s.shift(1).rolling(5).quantile(0.25)
    q75 = s.shift(1).rolling(5).quantile(0.75)
    up = (q75 + 3 * (q75 - q25)).rolling(5, center=True, min_periods=1).mean()
    low = (q25 - 3 * (q75 - q25)).rolling(5, center=True, min_periods=1).mean()
    pd.testing.assert_series_equal(got["q25"], q25, check_names=False)
    pd.testing.assert_series_equal(got["up"], up, check_names=False)
    pd.testing.assert_series_equal(got["low"], low, check_names=False)


def test_constant_series_then_spike_alerts_last_row_only(spark):
    vals = [10] * 8 + [50]
    flags = anomaly.anomaly_flags(anomaly.anomaly_bands(_series(spark, vals))).first()
    assert flags.is_alert is True and flags.value == 50.0
    quiet = anomaly.anomaly_flags(anomaly.anomaly_bands(_series(spark, [10] * 9))).first()
    assert quiet.is_alert is False
    short = anomaly.anomaly_flags(anomaly.anomaly_bands(_series(spark, [10, 11, 12]))).first()
    assert short.is_alert is False and short.up is None


def test_alert_text(spark):
    flags = anomaly.anomaly_flags(anomaly.anomaly_bands(_series(spark, [10] * 8 + [50])))
    msg = anomaly.alert_messages(flags, only_alerts=True).first().message
    assert msg == "Metric m: current value 50.00, change from previous value -400.00%"


def test_audience_identity(spark):
    from pulsekit.operators import feed as feedm
    from pulsekit.sources import load_fixture_tables
    fd, ms = load_fixture_tables(spark, "/root/testdata/sf0.01")
    split = audience.audience_split(fd, ms, AS_OF)
    both = {r.event_date: r.users for r in split["both"].collect()}
    only = {r.event_date: r.users for r in split["feed_only"].collect()}
    dau = {r.event_date: r.dau for r in feedm.feed_week(fd, AS_OF).collect()}
    assert dau and all(both.get(d, 0) + only.get(d, 0) == n for d, n in dau.items())


def test_xxhash_buckets(spark):
    from pulsekit.functions.hashing import hash_bucket
    df = spark.range(5000).select(hash_bucket(F.col("id"), 50, "xxhash64").alias("b"))
    r = df.agg(F.min("b"), F.max("b"), F.count_distinct("b")).first()
    assert r[0] == 0 and r[1] == 49 and r[2] == 50
    again = spark.range(5000).select(hash_bucket(F.col("id"), 50, "xxhash64").alias("b"))
    assert df.exceptAll(again).count() == 0
