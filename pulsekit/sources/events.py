"""The two event logs: ``feed_actions`` and ``message_actions``.

Production layout: two parquet tables (or catalog tables) with the columns
below, ideally partitioned by event date so the day filters prune files.

    feed_actions:    user_id, time, action ('view'|'like'), gender, age, os, exp_group
    message_actions: user_id (sender), receiver_id, time, gender, age, os

The test data ships a single ``events`` table; the fixture views derive both
logs from it with integer arithmetic only (see FIXTURES.md), so an SQL
engine can build the very same views.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsekit.functions.columns import DATE_PARTITION_FLAG
from pulsekit.functions.hashing import ab_split

# Fixed fixture rules (FIXTURES.md section 2).
FEED_EVENT_TYPES = ("view", "click")        # click -> like, view -> view
MESSAGE_EVENT_TYPES = ("signup", "purchase")
RECEIVER_SPREAD = 7                         # receiver = |user + event_id % 7 - 3|
AGE_BASE, AGE_STEP, AGE_SPAN = 15, 7, 50    # age = 15 + (user * 7) % 50


def _dims(uid: Column) -> list[Column]:
    return [
        (uid % 2).cast("int").alias("gender"),
        (F.lit(AGE_BASE) + (uid * AGE_STEP) % AGE_SPAN).cast("int").alias("age"),
        F.when(uid % 3 == 0, F.lit("iOS")).otherwise(F.lit("Android")).alias("os"),
    ]


def fixture_feed_actions(events: DataFrame, salt: str = "exp_mess_1", n_groups: int = 5) -> DataFrame:
    uid = F.col("user_id")
    return events.filter(F.col("event_type").isin(*FEED_EVENT_TYPES)).select(
        uid.alias("user_id"),
        F.col("ts").alias("time"),
        F.when(F.col("event_type") == "click", F.lit("like")).otherwise(F.lit("view")).alias("action"),
        *_dims(uid),
        ab_split(uid, salt, n_groups).alias("exp_group"),
    )


def fixture_message_actions(events: DataFrame) -> DataFrame:
    uid = F.col("user_id")
    half = RECEIVER_SPREAD // 2
    return events.filter(F.col("event_type").isin(*MESSAGE_EVENT_TYPES)).select(
        uid.alias("user_id"),
        F.abs(uid + F.col("event_id") % RECEIVER_SPREAD - half).alias("receiver_id"),
        F.col("ts").alias("time"),
        *_dims(uid),
    )


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a stream of its files: a folder, or one file, which a
    stream finds by its name in the folder around it."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()
    reader = spark.readStream.schema(read_events(spark, sf_dir).schema)
    return reader.parquet(path) if folder else reader.option("pathGlobFilter", "events*.parquet").parquet(sf_dir)


_FIXTURE_PLANS: dict = {}


def load_fixture_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(feed_actions, message_actions) fixture views over ``sf_dir``.

    The lazy plan objects are memoised per session and directory (no data
    is cached), so building many queries does not re-describe the views."""
    key = (id(spark), sf_dir.rstrip("/"))
    if key not in _FIXTURE_PLANS:
        events = read_events(spark, sf_dir)
        _FIXTURE_PLANS[key] = (spark, fixture_feed_actions(events), fixture_message_actions(events))
    _, feed, messages = _FIXTURE_PLANS[key]
    return feed, messages


def _read_table(spark: SparkSession, source: str) -> DataFrame:
    return spark.read.parquet(source) if "/" in source else spark.table(source)


def _mark_partition(df: DataFrame, date_partition: str | None) -> DataFrame:
    if date_partition is None:
        return df
    return df.withMetadata(date_partition, {DATE_PARTITION_FLAG: True})


def feed_actions(spark: SparkSession, source: str, date_partition: str | None = None) -> DataFrame:
    """Production feed log from a parquet path or a catalog table name.

    ``date_partition`` names a date partition column equal to the date of
    ``time`` (e.g. ``event_date``); every time-range filter then also prunes
    partitions."""
    return _mark_partition(_read_table(spark, source), date_partition)


def message_actions(spark: SparkSession, source: str, date_partition: str | None = None) -> DataFrame:
    """Production message log; the source spelling ``reciever_id`` is exposed
    as ``receiver_id``.  ``date_partition`` as for ``feed_actions``."""
    df = _read_table(spark, source)
    if "reciever_id" in df.columns:
        df = df.withColumnRenamed("reciever_id", "receiver_id")
    return _mark_partition(df, date_partition)
