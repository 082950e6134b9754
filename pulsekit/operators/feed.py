"""Feed metrics: DAU, likes, views, CTR per day and for one day.

One aggregation computes every daily metric, so a report reads the feed
log once instead of once per metric.  Day filters are half-open ranges on
the raw ``time`` column and reach the parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import count_nonnull_if, day_range, round_half_even, safe_div

LIKE, VIEW = "like", "view"


def _is(action: str):
    return F.col("action") == F.lit(action)


def _distinct_users(approx: bool, rsd: float = 0.01):
    return F.approx_count_distinct("user_id", rsd) if approx else F.count_distinct("user_id")


def feed_counts(feed: DataFrame, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """Per event_date: likes, views, ctr.  No user is counted, so a task passes
    on a row per day."""
    f = feed.filter(day_range(feed, "time", first_day, last_day))
    agg = f.groupBy(F.to_date("time").alias("event_date")).agg(
        count_nonnull_if("user_id", _is(LIKE)).alias("likes"),
        count_nonnull_if("user_id", _is(VIEW)).alias("views"))
    return agg.withColumn("ctr", round_half_even(safe_div(F.col("likes"), F.col("views")), 2))


def feed_user_days(feed: DataFrame, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """(event_date, user_id, likes, views): one row per active user
    and day, the first aggregate of the metrics that count users."""
    f = feed.filter(day_range(feed, "time", first_day, last_day))
    days = f.groupBy(F.to_date("time").alias("event_date"), "user_id").agg(
        count_nonnull_if("user_id", _is(LIKE)).alias("likes"),
        count_nonnull_if("user_id", _is(VIEW)).alias("views"),
    )
    return days


def feed_daily(feed: DataFrame, first_day: dt.date, last_day: dt.date, approx: bool = False) -> DataFrame:
    """Per event_date: dau, likes, views, ctr (2 places, half-even),
    likes_per_user, views_per_user.  ``approx`` counts DAU with HyperLogLog++
    in one pass instead of exactly from the per-user-day rows."""
    if approx:
        f = feed.filter(day_range(feed, "time", first_day, last_day))
        agg = f.groupBy(F.to_date("time").alias("event_date")).agg(
            _distinct_users(True).alias("dau"),
            count_nonnull_if("user_id", _is(LIKE)).alias("likes"),
            count_nonnull_if("user_id", _is(VIEW)).alias("views"),
        )
    else:
        days = feed_user_days(feed, first_day, last_day)
        agg = days.groupBy("event_date").agg(
            F.count(F.col("user_id")).alias("dau"),
            F.sum("likes").alias("likes"),
            F.sum("views").alias("views"),
        )
    return agg.select("event_date", "dau", "likes", "views", *feed_ratios())


def feed_ratios() -> list[Column]:
    """ctr (2 places, half-even), likes_per_user, views_per_user."""
    return [
        round_half_even(safe_div(F.col("likes"), F.col("views")), 2).alias("ctr"),
        safe_div(F.col("likes"), F.col("dau")).alias("likes_per_user"),
        safe_div(F.col("views"), F.col("dau")).alias("views_per_user"),
    ]


def trailing_week(as_of: dt.date, days: int = 7) -> tuple[dt.date, dt.date]:
    """``today()-7 .. today()-1``: the last full days before ``as_of``."""
    return as_of - dt.timedelta(days=days), as_of - dt.timedelta(days=1)


def feed_week(feed: DataFrame, as_of: dt.date, approx: bool = False) -> DataFrame:
    first, last = trailing_week(as_of)
    return feed_daily(feed, first, last, approx)


def feed_yesterday(feed: DataFrame, as_of: dt.date, approx: bool = False) -> DataFrame:
    """One row: the four headline metrics of ``as_of - 1`` (one scan, one
    aggregate; an empty day still yields one row of zeros).  ``approx``
    counts DAU with HyperLogLog++."""
    day = as_of - dt.timedelta(days=1)
    f = feed.filter(day_range(feed, "time", day, day))
    agg = f.agg(
        _distinct_users(approx).alias("dau"),
        count_nonnull_if("user_id", _is(LIKE)).alias("likes"),
        count_nonnull_if("user_id", _is(VIEW)).alias("views"),
    )
    return agg.select(
        F.lit(day).alias("event_date"), "dau", "likes", "views",
        round_half_even(safe_div(F.col("likes"), F.col("views")), 2).alias("ctr"),
    )
