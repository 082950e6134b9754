"""Report frames: daily texts and weekly chart series."""

from __future__ import annotations

from pulsekit.oracle_sql import div, r6 as s6, rnd, with_fixture
from pulsekit.operators import reports
from pulsekit.params import DEFAULT_PARAMS as P
from pulsekit.plans.catalog import r6, register
from pulsekit.plans.daily import (
    AUDIENCE_ROWS, FEED_DAILY_SQL, WEEK, WEIGHTED_CTE, YESTERDAY, _ledger, days_where,
)
from pulsekit.sources import load_fixture_tables

YDAY = days_where(YESTERDAY, YESTERDAY)

FEED_Y = f"""
fy AS (
    SELECT DATE '{YESTERDAY}' AS event_date,
           count(DISTINCT user_id) AS dau,
           count(CASE WHEN action = 'like' THEN user_id END) AS likes,
           count(CASE WHEN action = 'view' THEN user_id END) AS views
    FROM feed_actions WHERE {YDAY})"""


def _fmt2(expr: str) -> str:
    return f"coalesce(printf('%.2f', {rnd(expr, 2)}), 'nan')"


@register("daily_feed_report", with_fixture(FEED_Y, f"""
    SELECT event_date, dau, views, likes, {s6(rnd(div('likes', 'views'), 2))} AS ctr,
           'Feed metrics for ' || strftime(event_date, '%Y-%m-%d') || ': DAU = ' || dau || ', views = ' || views
           || ', likes = ' || likes || ', CTR = ' || {_fmt2(rnd(div('likes', 'views'), 2))} AS message
    FROM fy"""))
def q_daily_feed_report(spark, sf_dir):
    fd, _ = load_fixture_tables(spark, sf_dir)
    return r6(reports.daily_feed_report(fd, P.as_of))


@register("daily_app_report", with_fixture(FEED_Y, _ledger(WEEK), WEIGHTED_CTE, f"""
md AS (SELECT CAST(time AS DATE) AS event_date, count(receiver_id) AS messages_sent,
              count(DISTINCT user_id) AS messenger_dau
       FROM message_actions WHERE {YDAY} GROUP BY 1)""", """
    SELECT fy.event_date, fy.views, fy.likes,
           CAST(coalesce(md.messages_sent, 0) AS BIGINT) AS messages_sent,
           CAST(coalesce(w.messages_sent, 0) AS BIGINT) AS messages_sent_weighted,
           fy.dau AS feed_dau, CAST(coalesce(md.messenger_dau, 0) AS BIGINT) AS messenger_dau,
           'App events for ' || strftime(fy.event_date, '%Y-%m-%d') || ': views = ' || fy.views
           || ', likes = ' || fy.likes || ', messages sent = ' || coalesce(md.messages_sent, 0)
           || ', feed DAU = ' || fy.dau || ', messenger DAU = ' || coalesce(md.messenger_dau, 0) AS message
    FROM fy LEFT JOIN md ON md.event_date = fy.event_date
            LEFT JOIN weighted w ON w.event_date = fy.event_date"""))
def q_daily_app_report(spark, sf_dir):
    fd, ms = load_fixture_tables(spark, sf_dir)
    return reports.daily_app_report(fd, ms, P.as_of)


def _series(src: str, chart: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{chart}' AS chart, event_date AS x, '{c}' AS series, {s6(f'CAST("{c}" AS DOUBLE)')} AS y FROM {src}"
        for c in cols)


SERIES_SQL = with_fixture(FEED_DAILY_SQL, AUDIENCE_ROWS, """
both_ AS (SELECT fr.event_date, count(DISTINCT fr.user_id) AS "both" FROM fr JOIN mr
          ON fr.user_id = mr.user_id AND fr.event_date = mr.event_date GROUP BY 1)""", """
fo AS (SELECT fr.event_date, count(DISTINCT fr.user_id) AS feed_only FROM fr LEFT JOIN mr
       ON fr.user_id = mr.user_id AND fr.event_date = mr.event_date WHERE mr.user_id IS NULL GROUP BY 1)""", """
mo AS (SELECT mr.event_date, count(DISTINCT mr.user_id) AS message_only FROM mr LEFT JOIN fr
       ON fr.user_id = mr.user_id AND fr.event_date = mr.event_date WHERE fr.user_id IS NULL GROUP BY 1)""",
    _ledger(WEEK), WEIGHTED_CTE, f"""
daily2 AS (SELECT *, {rnd(div('likes', 'views'), 2)} AS ctr, {div('likes', 'dau')} AS likes_per_user,
                  {div('views', 'dau')} AS views_per_user FROM daily)""",
    " UNION ALL ".join([
        _series("daily2", "feed_7d", ["dau", "likes", "views", "ctr"]),
        _series("both_", "audience_7d", ["both"]),
        _series("fo", "audience_7d", ["feed_only"]),
        _series("mo", "audience_7d", ["message_only"]),
        _series("daily2", "feed_per_user_7d", ["likes_per_user", "views_per_user", "ctr"]),
        _series("weighted", "messages_7d", ["msg_sent_per_user", "msg_received_per_user", "receivers_per_user"]),
    ]))


@register("feed_series_long", SERIES_SQL)
def q_feed_series_long(spark, sf_dir):
    fd, ms = load_fixture_tables(spark, sf_dir)
    return r6(reports.feed_series_long(fd, ms, P.as_of))
