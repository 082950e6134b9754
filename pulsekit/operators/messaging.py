"""Messenger metrics: per-user slices and per-day totals.

Each job scans the log once and reduces it to (sender, receiver) pair counts.
Every pair then gives two rows, one for its sender and one for its receiver, and
one aggregate by user adds them up: no join, and nothing is computed twice.  A
message without a receiver makes its sender active, but is neither sent to nor
received by anyone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsekit.functions.columns import day_range, safe_div
from pulsekit.operators.feed import trailing_week

DIMS = ["gender", "age", "os"]
COUNTS = ["messages_received", "number_of_receivers", "messages_sent", "number_of_senders"]


def user_totals(msgs: DataFrame, keys: tuple[str, ...] = (), dims: bool = False) -> DataFrame:
    """(keys.., user_id, rows, COUNTS.., [dims]): per user the log rows sent, and
    what the user sent and received.  ``dims``: the distinct (gender, age, os) the
    user sent with, as an array.  Users with ``rows`` = 0 only received."""
    people = [F.collect_set(F.struct(*DIMS)).alias("dims")] if dims else []
    pairs = (msgs.where("user_id is not null").groupBy(*keys, "user_id", "receiver_id")
             .agg(F.count(F.lit(1)).alias("n"), *people))
    to = F.col("receiver_id").isNotNull()

    def side(user: str, rows, received, receivers, sent, senders):
        kept = "dims" if user == "user_id" else "cast(null as array<struct<gender:int,age:int,os:string>>)"
        return F.struct(F.col(user).alias("user_id"), F.expr(rows).alias("rows"),
                        *[F.expr(e).cast("long").alias(c) for e, c in
                          zip((received, receivers, sent, senders), COUNTS)],
                        *([F.expr(kept).alias("dims")] if dims else []))

    heard = "if(receiver_id is null, 0, {})".format
    both = F.filter(F.array(side("user_id", "n", "0", heard("1"), heard("n"), "0"),
                            F.when(to, side("receiver_id", "0L", "n", "0", "0", "1"))),
                    lambda x: x.isNotNull())
    sums = [F.sum(f"u.{c}").alias(c) for c in ("rows", *COUNTS)]
    if dims:        # a set of the few sets that a user's pairs have
        sums.append(F.array_distinct(F.flatten(F.collect_set("u.dims"))).alias("dims"))
    return (pairs.select(*keys, F.explode(both).alias("u"))
            .groupBy(*keys, "u.user_id").agg(*sums))


def message_user_slice(messages: DataFrame, day: dt.date, include_receivers: bool = False) -> DataFrame:
    """One row per sender active on ``day`` (and its dimensions), with the
    day's messages_received, number_of_receivers, messages_sent,
    number_of_senders; missing counts are 0.

    ``include_receivers`` adds users who only received messages that day
    (their dimensions are unknown in the log and stay NULL).
    """
    totals = user_totals(messages.filter(day_range(messages, "time", day, day)), dims=True)
    people = totals.where("rows > 0").select("*", F.explode("dims").alias("d"))
    columns = [F.col(f"d.{c}").alias(c) for c in DIMS]
    if include_receivers:
        people = totals.select("*", F.explode_outer("dims").alias("d"))
    return people.select("user_id", *columns, *COUNTS, F.lit(day).alias("event_date"))


def _daily_from_user_days(user_days: DataFrame) -> DataFrame:
    """Sum the per-(day, sender) weighted columns to per-day rows."""
    agg = user_days.groupBy("event_date").agg(
        F.count("user_id").alias("number_of_user_id"),
        F.sum("w_received").cast("long").alias("messages_received"),
        F.sum("w_receivers").cast("long").alias("number_of_receivers"),
        F.sum("w_sent").cast("long").alias("messages_sent"),
        F.sum("w_senders").cast("long").alias("number_of_senders"),
    )
    return agg.select(
        "event_date", "number_of_user_id", "messages_received", "number_of_receivers",
        "messages_sent", "number_of_senders",
        safe_div(F.col("messages_sent"), F.col("number_of_user_id")).alias("msg_sent_per_user"),
        safe_div(F.col("messages_received"), F.col("number_of_user_id")).alias("msg_received_per_user"),
        safe_div(F.col("number_of_receivers"), F.col("number_of_user_id")).alias("receivers_per_user"),
    )


def message_daily_weighted(messages: DataFrame, as_of: dt.date) -> DataFrame:
    """The reference's weekly message report, same numbers.

    It joins each sender's whole-week totals onto every message row and sums
    by day, so a total counts once per message the user sent that day.  Here
    messages are first counted per (day, sender) and the weekly totals are
    multiplied by that count: identical sums without the row fan-out.
    """
    first, last = trailing_week(as_of)
    m = messages.filter(day_range(messages, "time", first, last)).withColumn("event_date", F.to_date("time"))
    # the week's rows, not the days', hold a user's distinct receivers and
    # senders: count rows per day beside the totals, in the same aggregate
    days = [first + dt.timedelta(days=k) for k in range((last - first).days + 1)]
    totals = user_day_totals(m, days).where("rows > 0")
    per_day = totals.select("user_id", *COUNTS, F.explode(F.map_from_arrays(
        F.array(*[F.lit(d) for d in days]), F.array(*[F.col(f"d{k}") for k in range(len(days))])
    )).alias("event_date", "n")).where("n > 0")
    weighted = {"w_received": "messages_received", "w_receivers": "number_of_receivers",
                "w_sent": "messages_sent", "w_senders": "number_of_senders"}
    return _daily_from_user_days(per_day.select(
        "event_date", "user_id", *[(F.col("n") * F.col(c)).alias(w) for w, c in weighted.items()]))


def messages_yesterday(messages: DataFrame, as_of: dt.date) -> DataFrame:
    """One row: ``messenger_dau`` and ``messages_sent`` of the day before ``as_of``, and
    ``messages_sent_weighted``, that day's figure of ``message_daily_weighted``; all
    from one aggregate of the week."""
    first, last = trailing_week(as_of)
    m = messages.filter(day_range(messages, "time", first, last)).withColumn("event_date", F.to_date("time"))
    active = user_day_totals(m, [last]).where("d0 > 0 and user_id is not null")
    return active.agg(F.count(F.lit(1)).alias("messenger_dau"), F.sum("s0").alias("messages_sent"),
                      F.sum(F.col("d0") * F.col("messages_sent")).alias("messages_sent_weighted"))


def user_day_totals(msgs: DataFrame, days: list[dt.date]) -> DataFrame:
    """``user_totals`` over all ``days`` with the rows the user sent on each of
    them (d0, d1, ...), and of these the ones with a receiver (s0, s1, ...)."""
    on = [F.count_if(F.col("event_date") == F.lit(d)).alias(f"d{k}") for k, d in enumerate(days)]
    pairs = (msgs.where("user_id is not null").groupBy("user_id", "receiver_id")
             .agg(F.count(F.lit(1)).alias("n"), *on))
    heard = F.col("receiver_id").isNotNull().cast("long")
    zero = F.lit(0).cast("long")
    sender = F.struct(F.col("user_id"), F.col("n").alias("rows"), zero.alias(COUNTS[0]), heard.alias(COUNTS[1]),
                      (heard * F.col("n")).alias(COUNTS[2]), zero.alias(COUNTS[3]),
                      *[F.col(f"d{k}") for k in range(len(days))],
                      *[(heard * F.col(f"d{k}")).alias(f"s{k}") for k in range(len(days))])
    receiver = F.struct(F.col("receiver_id").alias("user_id"), zero.alias("rows"), F.col("n").alias(COUNTS[0]),
                        zero.alias(COUNTS[1]), zero.alias(COUNTS[2]), F.lit(1).cast("long").alias(COUNTS[3]),
                        *[zero.alias(f"{c}{k}") for c in "ds" for k in range(len(days))])
    both = F.filter(F.array(sender, F.when(heard == 1, receiver)), lambda x: x.isNotNull())
    names = ["rows", *COUNTS, *[f"{c}{k}" for c in "ds" for k in range(len(days))]]
    return (pairs.select(F.explode(both).alias("u")).groupBy("u.user_id")
            .agg(*[F.sum(f"u.{c}").alias(c) for c in names]))


def message_daily(messages: DataFrame, as_of: dt.date) -> DataFrame:
    """Per-day message totals over the day's senders, each counted once:
    what the weekly report means to show."""
    first, last = trailing_week(as_of)
    return message_daily_range(messages, first, last)


def message_daily_range(messages: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    m = messages.filter(day_range(messages, "time", first, last)).withColumn(
        "event_date", F.to_date("time"))
    senders = user_totals(m, ("event_date",)).where("rows > 0")
    return _daily_from_user_days(senders.select(
        "event_date", "user_id", F.col("messages_received").alias("w_received"),
        F.col("number_of_receivers").alias("w_receivers"), F.col("messages_sent").alias("w_sent"),
        F.col("number_of_senders").alias("w_senders")))
