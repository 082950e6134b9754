"""15-minute metrics of both services over the alert window.

Window: from 00:00 of the day before ``as_of_ts`` up to the start of the
15-minute bucket containing ``as_of_ts`` (the open bucket is left out).
Each log is aggregated per bucket on its own, then the two small results
are full-joined on the bucket start.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import (
    count_nonnull_if, hour_minute, quarter_hour, safe_div, time_range, ts_literal,
)

METRICS = ["users_feed", "views", "likes", "ctr", "users_message", "sent_message"]


def floor_quarter_hour(ts: dt.datetime) -> dt.datetime:
    return ts.replace(minute=ts.minute - ts.minute % 15, second=0, microsecond=0)


def alert_window(as_of_ts: dt.datetime) -> tuple[dt.datetime, dt.datetime]:
    start = dt.datetime.combine(as_of_ts.date() - dt.timedelta(days=1), dt.time())
    return start, floor_quarter_hour(as_of_ts)


def bucket_grid(spark, start: dt.datetime, end: dt.datetime, like) -> DataFrame:
    """Every 15-minute bucket start in [start, end): at most 4 * 24 * days rows."""
    first = ts_literal(start, like)
    last = ts_literal(end - dt.timedelta(minutes=15), like)
    return spark.range(1).select(
        F.explode(F.sequence(first, last, F.expr("INTERVAL 15 MINUTES"))).alias("ts"))


def metrics_15m(feed: DataFrame, messages: DataFrame, as_of_ts: dt.datetime,
                ctr_default: float | None = None, include_received: bool = False,
                densify: bool = False) -> DataFrame:
    """``metrics_between`` over the alert window of ``as_of_ts``."""
    return metrics_between(feed, messages, *alert_window(as_of_ts), ctr_default, include_received, densify)


def metrics_between(feed: DataFrame, messages: DataFrame, start: dt.datetime, end: dt.datetime,
                    ctr_default: float | None = None, include_received: bool = False,
                    densify: bool = False) -> DataFrame:
    """ts, date, hm, users_feed, views, likes, ctr, users_message, sent_message.

    Buckets present in one log only get 0 counts for the other; CTR is NULL
    where the bucket has no views (``ctr_default=0.0`` gives the reference's
    0 for message-only buckets).  ``include_received`` adds
    ``users_received`` (distinct receivers).  ``densify`` adds empty buckets
    of the window with zero counts, so every series has one row per bucket.
    """
    f = (feed.filter(time_range(feed, "time", start, end))
             .groupBy(quarter_hour("time").alias("ts"))
             .agg(F.count_distinct("user_id").alias("users_feed"),
                  count_nonnull_if("user_id", F.col("action") == "view").alias("views"),
                  count_nonnull_if("user_id", F.col("action") == "like").alias("likes")))
    msg_aggs = [F.count_distinct("user_id").alias("users_message"),
                F.count("user_id").alias("sent_message")]
    if include_received:
        msg_aggs.append(F.count_distinct("receiver_id").alias("users_received"))
    m = (messages.filter(time_range(messages, "time", start, end))
                 .groupBy(quarter_hour("time").alias("ts"))
                 .agg(*msg_aggs))
    j = f.join(m, "ts", "full")
    if densify:
        grid = bucket_grid(feed.sparkSession, start, end, feed.schema["time"].dataType)
        j = grid.join(j, "ts", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    ctr = safe_div(F.col("likes"), F.col("views"))
    if ctr_default is not None:
        ctr = F.when(F.col("users_feed").isNull(), F.lit(float(ctr_default))).otherwise(ctr)
    extra = [z("users_received")] if include_received else []
    return j.select(
        "ts",
        F.to_date("ts").alias("date"),
        hour_minute("ts").alias("hm"),
        z("users_feed"), z("views"), z("likes"),
        ctr.alias("ctr"),
        z("users_message"), z("sent_message"), *extra,
    )


def metrics_long(wide: DataFrame, metrics: list[str] = METRICS) -> DataFrame:
    """(ts, metric, value) rows, one per metric and bucket."""
    cast = wide.select("ts", *[F.col(c).cast("double").alias(c) for c in metrics])
    return cast.unpivot(["ts"], metrics, "metric", "value")
