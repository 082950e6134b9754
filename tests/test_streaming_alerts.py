"""Streamed alerts against the batch operators."""

import datetime as dt

from pyspark.sql import functions as F

from pulsekit.operators import anomaly, intraday
from pulsekit.params import DEFAULT_PARAMS as P
from pulsekit.sources import load_fixture_tables
from pulsekit.streaming import alerts
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


def wanted(feed, messages):
    bands = anomaly.anomaly_bands(intraday.metrics_long(intraday.metrics_15m(feed, messages, P.as_of_ts)))
    return rows(bands), rows(anomaly.anomaly_flags(bands))


def logs(spark):
    feed, messages = load_fixture_tables(spark, SF_SMALL)
    nobody = feed.limit(20).withColumn("user_id", F.lit(None).cast("long"))
    return feed.unionByName(nobody), messages


def test_late_and_repeated_batches_equal_the_batch_job(spark, tmp_path):
    feed, messages = logs(spark)
    store = str(tmp_path / "store")
    # rows dealt by hash: every batch holds rows of all buckets, most of them late
    every = alerts.tagged(feed, messages).withColumn("part", F.pmod(F.xxhash64("user_id", "time", "src"), F.lit(3)))
    every = every.persist()
    for number in range(3):
        batch = every.where(F.col("part") == number).drop("part")
        alerts.fold(batch, number, store, P.as_of_ts)
        if number == 1:                      # the batch before it fails and runs again
            alerts.fold(batch, number, store, P.as_of_ts)
            first = rows(spark.read.parquet(f"{store}/alerts"))
    bands, flags = wanted(feed, messages)
    assert rows(alerts.newest(spark, store, "bands")) == bands
    assert rows(alerts.newest(spark, store, "flags")) == flags
    # an alert is raised once
    raised = spark.read.parquet(f"{store}/alerts").groupBy("metric", "ts").count()
    assert raised.where("count > 1").count() == 0 and set(first) <= set(rows(spark.read.parquet(f"{store}/alerts")))


def test_production_logs_as_streams(spark, tmp_path):
    """Two parquet logs, read file by file, and a run that finds nothing new."""
    feed, messages = logs(spark)
    feed.repartition(3).write.parquet(str(tmp_path / "feed"))
    messages.repartition(2).write.parquet(str(tmp_path / "messages"))

    def run():
        streams = [spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
                   for df, name in ((feed, "feed"), (messages, "messages"))]
        q = alerts.start_alerts(*streams, str(tmp_path / "store"), str(tmp_path / "ckpt"), lambda: P.as_of_ts, every=None)
        assert q.awaitTermination(200) and q.exception() is None

    run()
    bands, flags = wanted(feed, messages)
    assert rows(alerts.newest(spark, str(tmp_path / "store"), "bands")) == bands
    assert rows(alerts.newest(spark, str(tmp_path / "store"), "flags")) == flags
    numbers = spark.read.parquet(str(tmp_path / "store" / "bands")).select("batch").distinct().count()
    assert numbers >= 3
    run()
    assert spark.read.parquet(str(tmp_path / "store" / "bands")).select("batch").distinct().count() == numbers


def test_an_alert_and_old_buckets(spark, tmp_path):
    """A jump raises one alert; a day outside the window is not read."""
    store, start = str(tmp_path / "store"), dt.datetime(2024, 1, 14)
    steady = [("feed", u, start + dt.timedelta(minutes=15 * i, seconds=u), "view") for i in range(20) for u in range(3)]
    jump = [("feed", u, start + dt.timedelta(minutes=15 * 20, seconds=u), "view") for u in range(60)]
    old = [("feed", 1, start - dt.timedelta(days=9), "view")]
    schema = "src string, user_id long, time timestamp_ntz, action string"
    as_of = start + dt.timedelta(minutes=15 * 21)
    for number, part in enumerate((steady + old, jump, [("feed", 99, start, "like")])):
        alerts.fold(spark.createDataFrame(part, schema), number, store, as_of)
    found = spark.read.parquet(f"{store}/alerts").orderBy("metric").collect()
    assert [(r["metric"], r["batch"]) for r in found] == [("users_feed", 1), ("views", 1)]
    assert alerts.newest(spark, store, "bands").agg(F.min("ts")).first()[0] == start
    assert "current value 60.00" in found[0]["message"]


def test_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "src string, user_id long, time timestamp_ntz, action string")
    alerts.fold(none, 0, str(tmp_path / "store"), P.as_of_ts)
    assert not alerts.exists(spark, str(tmp_path / "store" / "bands"))
