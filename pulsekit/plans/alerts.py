"""Alert job: 15-minute metrics, IQR bands, flags and alert texts."""

from __future__ import annotations

import datetime as dt
import uuid

from pulsekit.oracle_sql import r6 as s6, rnd, with_fixture
from pulsekit.operators import anomaly, intraday
from pulsekit.params import DEFAULT_PARAMS as P
from pulsekit.plans.catalog import r6, register
from pulsekit.plans.daily import days_where
from pulsekit.session import shared_path
from pulsekit.sources import load_fixture_tables
from pulsekit.sources.events import fixture_feed_actions, fixture_message_actions, stream_events
from pulsekit.streaming import alerts as streamed

START, END = intraday.alert_window(P.as_of_ts)
WINDOW = f"time >= TIMESTAMP '{START:%Y-%m-%d %H:%M:%S}' AND time < TIMESTAMP '{END:%Y-%m-%d %H:%M:%S}'"
#: All days of the experiment, for the bands of the history.
HISTORY = days_where(P.exp_start, P.exp_end)
N, A = P.band_n, P.band_a

#: One stream of both logs, a row per bucket of its start; the label columns
#: are derived from the start at the end.
M15_SQL = f"""
stream AS (
    SELECT epoch_us(time) // 900000000 AS slot, user_id, action, 'f' AS log FROM feed_actions WHERE {WINDOW}
    UNION ALL
    SELECT epoch_us(time) // 900000000, user_id, 'sent', 'm' FROM message_actions WHERE {WINDOW}),
slots AS (
    SELECT slot,
           count(DISTINCT user_id) FILTER (WHERE log = 'f') AS users_feed,
           count(user_id) FILTER (WHERE action = 'view') AS views,
           count(user_id) FILTER (WHERE action = 'like') AS likes,
           count(DISTINCT user_id) FILTER (WHERE log = 'm') AS users_message,
           count(user_id) FILTER (WHERE action = 'sent') AS sent_message
    FROM stream GROUP BY slot),
m15 AS (
    SELECT make_timestamp(slot * 900000000) AS ts, CAST(make_timestamp(slot * 900000000) AS DATE) AS date,
           strftime(make_timestamp(slot * 900000000), '%H:%M') AS hm, users_feed, views, likes,
           CAST(likes AS DOUBLE) / NULLIF(CAST(views AS DOUBLE), 0) AS ctr, users_message, sent_message
    FROM slots)"""

LONG_SQL = M15_SQL + ",\nlong AS (" + " UNION ALL ".join(
    f"SELECT ts, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM m15" for m in intraday.METRICS) + ")"

BANDS_SQL = LONG_SQL + f""",
b0 AS (
    SELECT metric, ts, value,
           CASE WHEN count(value) OVER w = {N} THEN quantile_cont(value, 0.25) OVER w END AS q25,
           CASE WHEN count(value) OVER w = {N} THEN quantile_cont(value, 0.75) OVER w END AS q75,
           lag(value) OVER (PARTITION BY metric ORDER BY ts) AS prev_value
    FROM long
    WINDOW w AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN {N} PRECEDING AND 1 PRECEDING)),
b1 AS (
    SELECT *, q75 - q25 AS iqr, q75 + {A!r} * (q75 - q25) AS up_raw, q25 - {A!r} * (q75 - q25) AS low_raw
    FROM b0),
bands AS (
    SELECT metric, ts, value, q25, q75, iqr, prev_value,
           avg(up_raw) OVER c AS up, avg(low_raw) OVER c AS low
    FROM b1
    WINDOW c AS (PARTITION BY metric ORDER BY ts ROWS BETWEEN {N // 2} PRECEDING AND {(N - 1) // 2} FOLLOWING)),
flags AS (
    SELECT metric, ts, value, prev_value, up, low,
           coalesce(value < low OR value > up, false) AS is_alert
    FROM bands QUALIFY row_number() OVER (PARTITION BY metric ORDER BY ts DESC) = 1)"""


def _bands(spark, sf_dir):
    fd, ms = load_fixture_tables(spark, sf_dir)
    long = intraday.metrics_long(intraday.metrics_15m(fd, ms, P.as_of_ts))
    return anomaly.anomaly_bands(long, a=A, n=N)


@register("metrics_15m", with_fixture(M15_SQL, f"""
    SELECT ts, date, hm, users_feed, views, likes, {s6('ctr')} AS ctr, users_message, sent_message
    FROM m15"""))
def q_metrics_15m(spark, sf_dir):
    fd, ms = load_fixture_tables(spark, sf_dir)
    return r6(intraday.metrics_15m(fd, ms, P.as_of_ts)).orderBy("ts")


@register("metrics_15m_long", with_fixture(LONG_SQL, f"SELECT ts, metric, {s6('value')} AS value FROM long"))
def q_metrics_15m_long(spark, sf_dir):
    fd, ms = load_fixture_tables(spark, sf_dir)
    return r6(intraday.metrics_long(intraday.metrics_15m(fd, ms, P.as_of_ts)))


BANDS_OUT = with_fixture(BANDS_SQL, f"""
    SELECT metric, ts, {s6('value')} AS value, {s6('q25')} AS q25, {s6('q75')} AS q75, {s6('iqr')} AS iqr,
           {s6('up')} AS up, {s6('low')} AS low, {s6('prev_value')} AS prev_value
    FROM bands""")


@register("anomaly_bands", BANDS_OUT)
def q_anomaly_bands(spark, sf_dir):
    return r6(_bands(spark, sf_dir))


@register("anomaly_history", BANDS_OUT.replace(WINDOW, HISTORY))
def q_anomaly_history(spark, sf_dir):
    """Bands of every closed bucket of the experiment's days."""
    fd, ms = load_fixture_tables(spark, sf_dir)
    start, end = (dt.datetime.combine(d, dt.time()) for d in (P.exp_start, P.exp_end + dt.timedelta(days=1)))
    long = intraday.metrics_long(intraday.metrics_between(fd, ms, start, end))
    return r6(anomaly.history_bands(long, a=A, n=N))


@register("stream_anomaly_bands", BANDS_OUT)
def q_stream_anomaly_bands(spark, sf_dir):
    """The bands that a stream over the logs leaves in its store."""
    folder = shared_path(spark, f"alerts-{uuid.uuid4().hex[:12]}")
    events = stream_events(spark, sf_dir)
    query = streamed.start_alerts(fixture_feed_actions(events), fixture_message_actions(events), f"{folder}/store",
                                  f"{folder}/checkpoint", lambda: P.as_of_ts, A, N, every=None)
    query.awaitTermination()
    return r6(streamed.newest(spark, f"{folder}/store", "bands"))


@register("anomaly_flags", with_fixture(BANDS_SQL, f"""
    SELECT metric, ts, {s6('value')} AS value, {s6('prev_value')} AS prev_value,
           {s6('up')} AS up, {s6('low')} AS low, is_alert
    FROM flags"""))
def q_anomaly_flags(spark, sf_dir):
    return r6(anomaly.anomaly_flags(_bands(spark, sf_dir)))


_CHANGE = "(1.0 - CAST(value AS DOUBLE) / NULLIF(prev_value, 0))"


@register("alert_messages", with_fixture(BANDS_SQL, f"""
    SELECT metric, ts, is_alert, {s6(_CHANGE)} AS change,
           'Metric ' || metric || ': current value ' || coalesce(printf('%.2f', {rnd('value', 2)}), 'nan')
           || ', change from previous value '
           || coalesce(printf('%.2f%%', {rnd(_CHANGE + ' * 100.0', 2)}), 'nan') AS message
    FROM flags"""))
def q_alert_messages(spark, sf_dir):
    return r6(anomaly.alert_messages(anomaly.anomaly_flags(_bands(spark, sf_dir)), only_alerts=False))
