"""Structured Streaming variant of the 15-minute metrics.

Both logs are tagged and unioned into one stream, so a single windowed
aggregation yields feed and messenger metrics per bucket -- no stream-stream
join of aggregates (which Structured Streaming does not support).  Exact
distinct counts are not available on streams; users per bucket use
``approx_count_distinct``.  With a watermark the file sink appends each
bucket once, after it is final, and the checkpoint makes the sink
exactly-once across restarts.  The batch ``anomaly_bands`` then runs over
the sink table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsekit.functions.columns import safe_div
from pulsekit.sources.events import fixture_feed_actions, fixture_message_actions


def _tagged(events: DataFrame) -> DataFrame:
    feed = fixture_feed_actions(events).select(
        F.lit("feed").alias("src"), "user_id", "time", "action")
    msg = fixture_message_actions(events).select(
        F.lit("message").alias("src"), "user_id", "time", F.lit(None).cast("string").alias("action"))
    return feed.unionByName(msg)


def metrics_15m_stream(events: DataFrame, watermark: str = "30 minutes") -> DataFrame:
    """Streaming (or batch) frame: one row per finished 15-minute bucket."""
    t = _tagged(events)
    if dict(t.dtypes)["time"] == "timestamp_ntz":
        # watermarks need TIMESTAMP; cast in (and back out below) under the
        # session time zone, a round trip that is the identity
        t = t.withColumn("time", F.col("time").cast("timestamp"))
    t = t.withWatermark("time", watermark)
    is_feed = F.col("src") == "feed"
    is_msg = F.col("src") == "message"
    agg = t.groupBy(F.window("time", "15 minutes").alias("w")).agg(
        F.approx_count_distinct(F.when(is_feed, F.col("user_id"))).alias("users_feed"),
        F.count_if(is_feed & (F.col("action") == "view")).alias("views"),
        F.count_if(is_feed & (F.col("action") == "like")).alias("likes"),
        F.approx_count_distinct(F.when(is_msg, F.col("user_id"))).alias("users_message"),
        F.count_if(is_msg).alias("sent_message"),
    )
    start = F.col("w.start").cast(dict(events.dtypes).get("ts", "timestamp"))
    return agg.select(
        start.alias("ts"), F.to_date(start).alias("date"),
        "users_feed", "views", "likes", safe_div(F.col("likes"), F.col("views")).alias("ctr"),
        "users_message", "sent_message")


def start_metrics_15m(spark: SparkSession, events_dir: str, sink_path: str, checkpoint: str,
                      available_now: bool = True, watermark: str = "30 minutes") -> StreamingQuery:
    """Read new ``events`` parquet files from ``events_dir`` and append
    finished buckets to a parquet table partitioned by date."""
    schema = spark.read.parquet(f"{events_dir.rstrip('/')}/events.parquet").schema
    events = (spark.readStream.schema(schema)
              .option("pathGlobFilter", "events*.parquet")
              .parquet(events_dir))
    out = metrics_15m_stream(events, watermark)
    writer = (out.writeStream.format("parquet").outputMode("append")
              .option("path", sink_path).option("checkpointLocation", checkpoint)
              .partitionBy("date"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
