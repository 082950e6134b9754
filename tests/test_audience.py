"""Audience overlap from one aggregate: null ids, user 0, empty logs, days of one log only."""

import datetime as dt

import pytest

from pulsekit.operators import audience, feed as feedm, reports

AS_OF = dt.date(2024, 1, 15)
FEED = "user_id long, time timestamp_ntz, action string"
MESSAGES = "user_id long, receiver_id long, time timestamp_ntz"


def at(day, hour=3):
    return dt.datetime(2024, 1, day, hour)


FEED_ROWS = [(0, at(10), "view"), (0, at(10, 4), "like"), (1, at(10), "view"), (None, at(10), "view"),
             (2, at(11), "like"), (None, at(13), "view"), (3, at(15), "view"), (4, at(7), "view")]
MESSAGE_ROWS = [(0, 1, at(10)), (5, 0, at(10)), (None, 2, at(10)), (2, 0, at(12)), (2, 0, at(12, 9)), (3, 1, at(14))]


def by_sets(feed_rows, message_rows):
    """The three parts by plain sets: day -> users (null ids are rows without a user)."""
    out = {part: {} for part in audience.PARTS}
    logs = [{(r[k].date(), r[0]) for r in rows if at(8).date() <= r[k].date() < AS_OF}
            for rows, k in ((feed_rows, 1), (message_rows, 2))]
    for bit, (mine, other) in enumerate((logs, logs[::-1])):
        for day, user in mine:
            part = "both" if user is not None and (day, user) in other else ("feed_only", "message_only")[bit]
            out[part].setdefault(day, set()).add(user)
    return {p: {d: len(u - {None}) for d, u in days.items()} for p, days in out.items()}


@pytest.mark.parametrize("feed_rows,message_rows", [
    (FEED_ROWS, MESSAGE_ROWS), (FEED_ROWS, []), ([], MESSAGE_ROWS), ([], []),
])
def test_parts_equal_sets(spark, feed_rows, message_rows):
    feed, messages = spark.createDataFrame(feed_rows, FEED), spark.createDataFrame(message_rows, MESSAGES)
    got = {part: {r.event_date: r.users for r in frame.collect()}
           for part, frame in audience.audience_split(feed, messages, AS_OF).items()}
    assert got == by_sets(feed_rows, message_rows)


def test_overview_and_series_equal_the_separate_frames(spark):
    feed, messages = spark.createDataFrame(FEED_ROWS, FEED), spark.createDataFrame(MESSAGE_ROWS, MESSAGES)
    series = {}
    for r in reports.feed_series_long(feed, messages, AS_OF).collect():
        assert (r.chart, r.series, r.x) not in series
        series[r.chart, r.series, r.x] = r.y
    want = {}
    for part, days in by_sets(FEED_ROWS, MESSAGE_ROWS).items():
        want |= {("audience_7d", part, d): float(n) for d, n in days.items()}
    for r in feedm.feed_week(feed, AS_OF).collect():
        for chart, names in (("feed_7d", ("dau", "likes", "views", "ctr")),
                             ("feed_per_user_7d", ("likes_per_user", "views_per_user", "ctr"))):
            want |= {(chart, c, r.event_date): r[c] for c in names}
    assert {k: v for k, v in series.items() if k[0] != "messages_7d"} == want
