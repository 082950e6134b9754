"""Alerts on the two production logs as streams.

Every micro-batch is folded into a store of partial aggregates, a row for each
(15-minute bucket, log, user) of the batch, under its date and batch number.  The
two days of the alert window are then read back, metrics, bands and flags computed
by the batch operators, and written under the batch number; an alert that an earlier
batch has raised for the same series and bucket is not raised again.

* Distinct users are exact: the store holds users, not counts.
* Late rows, however late, fall into their bucket, and the bands that see it change.
* A micro-batch that runs again overwrites its own partitions, so nothing counts twice.
* Only the folders of the window's two days are listed, whatever the store holds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsekit.functions.columns import count_nonnull_if, hour_minute, quarter_hour, safe_div, time_range
from pulsekit.operators.anomaly import alert_messages, anomaly_bands, anomaly_flags
from pulsekit.operators.intraday import alert_window, metrics_long

PARTIAL = ["ts", "src", "user_id", "views", "likes", "sent"]


def tagged(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Both logs as one frame: src, user_id, time, action."""
    f = feed.select(F.lit("feed").alias("src"), "user_id", "time", "action")
    m = messages.select(F.lit("message").alias("src"), "user_id", "time", F.lit(None).cast("string").alias("action"))
    return f.unionByName(m)


def partials(rows: DataFrame) -> DataFrame:
    """What a batch of tagged rows adds to each (bucket, log, user).  A null user
    keeps its bucket but counts nowhere, as in the batch metrics."""
    return rows.groupBy(quarter_hour("time").alias("ts"), "src", "user_id").agg(
        count_nonnull_if("user_id", F.col("action") == "view").alias("views"),
        count_nonnull_if("user_id", F.col("action") == "like").alias("likes"),
        count_nonnull_if("user_id", F.col("src") == "message").alias("sent"))


def metrics_of(stored: DataFrame) -> DataFrame:
    """The columns of ``intraday.metrics_15m`` from stored partials."""
    def users(src):
        return F.count_distinct(F.when(F.col("src") == src, F.col("user_id")))

    def total(c):
        return F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c if c != "sent" else "sent_message")

    m = stored.groupBy("ts").agg(users("feed").alias("users_feed"), total("views"), total("likes"),
                                 users("message").alias("users_message"), total("sent"))
    return m.select("ts", F.to_date("ts").alias("date"), hour_minute("ts").alias("hm"), "users_feed", "views", "likes",
                    safe_div(F.col("likes"), F.col("views")).alias("ctr"), "users_message", "sent_message")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_store(spark: SparkSession, store: str, start: dt.datetime, end: dt.datetime) -> DataFrame | None:
    """Partials of the buckets from ``start`` to before ``end``."""
    days = [start.date() + dt.timedelta(days=i) for i in range((end.date() - start.date()).days + 1)]
    folders = [f"{store}/partials/date={d}" for d in days if exists(spark, f"{store}/partials/date={d}")]
    if not folders:
        return None
    rows = spark.read.option("basePath", f"{store}/partials").parquet(*folders)
    return rows.where(time_range(rows, "ts", start, end))


def fold(batch: DataFrame, number: int, store: str, as_of: dt.datetime, a: float = 3.0, n: int = 5) -> None:
    """Put one micro-batch of tagged rows into the store and write bands, flags and
    new alerts as of a wall clock time."""
    spark = batch.sparkSession
    (partials(batch).withColumn("date", F.to_date("ts")).withColumn("batch", F.lit(number))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date", "batch")
     .parquet(f"{store}/partials"))
    stored = read_store(spark, store, *alert_window(as_of))
    if stored is None:
        return
    anomaly_bands(metrics_long(metrics_of(stored)), a, n).write.mode("overwrite").parquet(f"{store}/bands/batch={number}")
    flags = anomaly_flags(spark.read.parquet(f"{store}/bands/batch={number}"))
    flags.write.mode("overwrite").parquet(f"{store}/flags/batch={number}")
    alerts = alert_messages(spark.read.parquet(f"{store}/flags/batch={number}"), only_alerts=True)
    if exists(spark, f"{store}/alerts"):
        # with a schema, as the folder may hold no alert yet
        raised = spark.read.schema(alerts.withColumn("batch", F.lit(0)).schema).parquet(f"{store}/alerts")
        raised = raised.where((F.col("batch") < number) & time_range(raised, "ts", *alert_window(as_of)))
        alerts = alerts.join(raised, ["metric", "ts"], "left_anti")
    (alerts.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(f"{store}/alerts"))


def start_alerts(feed: DataFrame, messages: DataFrame, store: str, checkpoint: str, clock: Callable[[], dt.datetime],
                 a: float = 3.0, n: int = 5, every: str | None = "1 minute") -> StreamingQuery:
    """Run over two streaming logs (``spark.readStream``).  ``clock`` gives the time a
    batch is judged at, in the session's time zone; ``every=None`` takes what is
    there in micro-batches and ends."""
    writer = (tagged(feed, messages).writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, number: fold(batch, number, store, clock(), a, n)))
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def newest(spark: SparkSession, store: str, what: str) -> DataFrame:
    """``bands`` or ``flags`` as the newest batch has left them."""
    every = spark.read.parquet(f"{store}/{what}")
    number = every.agg(F.max("batch")).first()[0]
    return every.where(F.col("batch") == number).drop("batch")
