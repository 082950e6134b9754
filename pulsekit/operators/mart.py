"""Daily ETL: user-day slices of both logs, their outer merge, and the
per-dimension mart (gender, os, age) with six measures.

The three per-dimension groupings are one ``GROUPING SETS`` aggregate: the
merged rows are expanded once, partially aggregated map-side and shuffled
as (dimension, value) groups -- a few hundred rows per day -- instead of
three separate passes and a union.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import count_nonnull_if, day_range
from pulsekit.operators.messaging import message_user_slice

DIMS = ["gender", "age", "os"]
MESSAGE_COUNTS = ["messages_received", "number_of_receivers", "messages_sent", "number_of_senders"]
FEED_COUNTS = ["likes", "views"]
MART_DIMENSIONS = ["gender", "os", "age"]   # output order of the reference


def feed_user_slice(feed: DataFrame, day: dt.date) -> DataFrame:
    """Per (user, gender, age, os) on ``day``: likes, views."""
    f = feed.filter(day_range(feed, "time", day, day))
    return f.groupBy("user_id", *DIMS, F.to_date("time").alias("event_date")).agg(
        count_nonnull_if("user_id", F.col("action") == "like").alias("likes"),
        count_nonnull_if("user_id", F.col("action") == "view").alias("views"),
    )


def user_day_merged(feed: DataFrame, messages: DataFrame, day: dt.date,
                    include_receivers: bool = False) -> DataFrame:
    """Outer merge of the message and feed slices on (user_id, gender, age, os).

    Both slices have a row per key, so the merge is their union, with 0 for the
    other's measures, added up by key: one shuffle, and NULL keys meet as in a
    pandas merge.  Missing keys become 0 afterwards (the whole frame is filled).
    """
    keys = ["user_id"] + DIMS
    both = message_user_slice(messages, day, include_receivers).unionByName(
        feed_user_slice(feed, day), allowMissingColumns=True)
    measures = MESSAGE_COUNTS + FEED_COUNTS
    merged = both.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in measures],
        F.max("event_date").alias("event_date"))
    zero = {"user_id": ("long", 0), "gender": ("int", 0), "age": ("int", 0), "os": ("string", "0")}
    return merged.select(*[F.coalesce(F.col(k), F.lit(v)).cast(t).alias(k) for k, (t, v) in zero.items()],
                         *measures, "event_date")


def slice_mart(merged: DataFrame) -> DataFrame:
    """Sums and max(event_date) per gender, per os and per age, stacked as
    (event_date, dimension, dimension_value, views, likes, messages_received,
    messages_sent, users_received, users_sent)."""
    g = merged.groupingSets(
        [[F.col(d)] for d in MART_DIMENSIONS], *[F.col(d) for d in MART_DIMENSIONS]
    ).agg(
        F.grouping_id(*[F.col(d) for d in MART_DIMENSIONS]).alias("_gid"),
        F.sum("views").alias("views"),
        F.sum("likes").alias("likes"),
        F.sum("messages_received").alias("messages_received"),
        F.sum("messages_sent").alias("messages_sent"),
        F.sum("number_of_senders").alias("users_received"),
        F.sum("number_of_receivers").alias("users_sent"),
        F.max("event_date").alias("event_date"),
    )
    # grouping_id bit i (from the left) is 1 when dimension i is NOT grouped
    n = len(MART_DIMENSIONS)
    which = None
    for i, d in enumerate(MART_DIMENSIONS):
        gid = (2 ** n - 1) ^ (1 << (n - 1 - i))
        label = F.when(F.col("_gid") == gid, F.lit(d))
        value = F.when(F.col("_gid") == gid, F.col(d).cast("string"))
        which = (label, value) if which is None else (
            F.coalesce(which[0], label), F.coalesce(which[1], value))
    out = g.select(
        "event_date",
        which[0].alias("dimension"),
        which[1].alias("dimension_value"),
        *[F.col(c).cast("long").alias(c) for c in
          ("views", "likes", "messages_received", "messages_sent", "users_received", "users_sent")],
    )
    # a NULL key of the active dimension is dropped, as pandas groupby does
    return out.filter(F.col("dimension_value").isNotNull())


def daily_slice_mart(feed: DataFrame, messages: DataFrame, day: dt.date,
                     include_receivers: bool = False) -> DataFrame:
    return slice_mart(user_day_merged(feed, messages, day, include_receivers))
