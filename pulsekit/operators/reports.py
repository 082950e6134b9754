"""Report frames: the daily texts and the long series behind the charts.

Chat delivery and figure rendering stay outside Spark; these functions
return one-row report frames (values plus the formatted text) and long
(chart, x, series, y) frames a plotting client can draw directly.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import fmt_fixed
from pulsekit.operators import audience, feed as feedm, messaging


def daily_feed_report(feed: DataFrame, as_of: dt.date) -> DataFrame:
    y = feedm.feed_yesterday(feed, as_of)
    text = F.concat(
        F.lit("Feed metrics for "), F.date_format("event_date", "yyyy-MM-dd"),
        F.lit(": DAU = "), F.col("dau").cast("string"),
        F.lit(", views = "), F.col("views").cast("string"),
        F.lit(", likes = "), F.col("likes").cast("string"),
        F.lit(", CTR = "), fmt_fixed(F.col("ctr"), 2))
    return y.select("event_date", "dau", "views", "likes", "ctr", text.alias("message"))


def daily_app_report(feed: DataFrame, messages: DataFrame, as_of: dt.date) -> DataFrame:
    """Yesterday's views, likes, messages sent, feed DAU and messenger DAU.

    Messages are yesterday's real count (the reference took the first row of
    an unordered weekly result); the week-weighted figure it showed is kept
    as ``messages_sent_weighted``."""
    day = as_of - dt.timedelta(days=1)
    # two one-row parts stacked and folded by one global aggregate (no join)
    y = feedm.feed_yesterday(feed, as_of).select("views", "likes", F.col("dau").alias("feed_dau"))
    parts = y.unionByName(messaging.messages_yesterday(messages, as_of), allowMissingColumns=True)
    z = lambda c: F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c)
    out = parts.agg(z("views"), z("likes"), z("messages_sent"), z("messages_sent_weighted"),
                    z("feed_dau"), z("messenger_dau"))
    out = out.select(F.lit(day).alias("event_date"), "*")
    text = F.concat(
        F.lit("App events for "), F.date_format("event_date", "yyyy-MM-dd"),
        F.lit(": views = "), F.col("views").cast("string"),
        F.lit(", likes = "), F.col("likes").cast("string"),
        F.lit(", messages sent = "), F.col("messages_sent").cast("string"),
        F.lit(", feed DAU = "), F.col("feed_dau").cast("string"),
        F.lit(", messenger DAU = "), F.col("messenger_dau").cast("string"))
    return out.withColumn("message", text)


def _charts(days: DataFrame, charts: list[tuple[str, str, Column]]) -> DataFrame:
    """A row (chart, x, series, y) for each day and entry whose ``when`` is not null."""
    rows = F.array(*[F.when(when.isNotNull(), F.struct(
        F.lit(chart).alias("chart"), F.lit(series).alias("series"), F.col(series).cast("double").alias("y")))
        for chart, series, when in charts])
    return (days.select(F.col("event_date").alias("x"), F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("r"))
            .select("r.chart", "x", "r.series", "r.y"))


def feed_series_long(feed: DataFrame, messages: DataFrame, as_of: dt.date) -> DataFrame:
    """Series of the four weekly charts: feed metrics, audience split,
    feed events per user, messenger events per user.  The first three come from
    one aggregate of both logs; the feed's points are there on days with a feed
    row, a part of the audience's on days with a row of it."""
    days = audience.week_overview(feed, messages, as_of).select("*", *feedm.feed_ratios())
    has_feed = F.col("dau")
    charts = [("feed_7d", c, has_feed) for c in ("dau", "likes", "views", "ctr")]
    charts += [("audience_7d", c, F.col(c)) for c in audience.PARTS]
    charts += [("feed_per_user_7d", c, has_feed) for c in ("likes_per_user", "views_per_user", "ctr")]
    msg = messaging.message_daily_weighted(messages, as_of)
    return _charts(days, charts).unionByName(_charts(msg, [
        ("messages_7d", c, F.col("event_date"))
        for c in ("msg_sent_per_user", "msg_received_per_user", "receivers_per_user")]))
