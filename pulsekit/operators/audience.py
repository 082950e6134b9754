"""Audience overlap per day: users active in both services, feed only,
messenger only.

Both logs are stacked, each row with the bit of its service; one aggregate by
(event_date, user_id) ors the bits and a second counts users by their bits.
No join: every log is read once, a user's rows collapse before the shuffle,
and a real user id 0 is not mistaken for "no match".
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import count_nonnull_if, day_range
from pulsekit.operators.feed import LIKE, VIEW, trailing_week


FEED, MESSENGER = 1, 2


def active_days(log: DataFrame, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """Distinct (user_id, event_date) of any log."""
    return (log.filter(day_range(log, "time", first_day, last_day))
               .select("user_id", F.to_date("time").alias("event_date"))
               .distinct())


def service_days(feed: DataFrame, messages: DataFrame, first_day: dt.date, last_day: dt.date) -> DataFrame:
    """(event_date, user_id, services, likes, views): one row per user and day of
    either log; ``services`` has the bit of each log that the user is in."""
    def rows(log: DataFrame, bit: int, like: Column, view: Column) -> DataFrame:
        return log.filter(day_range(log, "time", first_day, last_day)).select(
            F.to_date("time").alias("event_date"), "user_id", F.lit(bit).alias("service"),
            like.alias("is_like"), view.alias("is_view"))

    no = F.lit(False)
    both = rows(feed, FEED, F.col("action") == LIKE, F.col("action") == VIEW).unionByName(
        rows(messages, MESSENGER, no, no))
    return both.groupBy("event_date", "user_id").agg(
        F.bit_or("service").alias("services"),
        count_nonnull_if("user_id", F.col("is_like")).alias("likes"),
        count_nonnull_if("user_id", F.col("is_view")).alias("views"))


def in_both() -> Column:
    """Null ids match nobody: they are a row of each log, never of both."""
    return (F.col("services") == FEED + MESSENGER) & F.col("user_id").isNotNull()


def _in(bit: int) -> Column:
    return F.col("services").bitwiseAND(bit) != 0


#: Which (user, day) rows each part of the audience counts.
PARTS = {
    "both": in_both,
    "feed_only": lambda: _in(FEED) & ~in_both(),
    "message_only": lambda: _in(MESSENGER) & ~in_both(),
}


def audience_split(feed: DataFrame, messages: DataFrame, as_of: dt.date) -> dict[str, DataFrame]:
    """Users per day of each part, for days on which the part has a row."""
    days = service_days(feed, messages, *trailing_week(as_of))
    return {part: days.filter(which()).groupBy("event_date").agg(F.count("user_id").alias("users"))
            for part, which in PARTS.items()}


def week_overview(feed: DataFrame, messages: DataFrame, as_of: dt.date) -> DataFrame:
    """Per day, from one aggregate of both logs: ``dau``, ``likes``, ``views`` of the
    feed (null on days without a feed row) and the three parts of the audience (null
    on days on which the part has no row)."""
    def users(which: Column) -> Column:
        return F.when(F.count_if(which) > 0, F.count(F.when(which, F.col("user_id"))))

    active = _in(FEED)
    days = service_days(feed, messages, *trailing_week(as_of))
    return days.groupBy("event_date").agg(
        users(active).alias("dau"),
        *[F.sum(F.when(active, F.col(c))).alias(c) for c in ("likes", "views")],
        *[users(which()).alias(part) for part, which in PARTS.items()])


def dau_both(feed: DataFrame, messages: DataFrame, as_of: dt.date) -> DataFrame:
    return audience_split(feed, messages, as_of)["both"]


def dau_feed_only(feed: DataFrame, messages: DataFrame, as_of: dt.date) -> DataFrame:
    return audience_split(feed, messages, as_of)["feed_only"]


def dau_message_only(feed: DataFrame, messages: DataFrame, as_of: dt.date) -> DataFrame:
    return audience_split(feed, messages, as_of)["message_only"]
