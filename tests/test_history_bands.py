"""Bands of long series by blocks against the plain window."""

import datetime as dt
import random

import pytest

from pulsekit.operators import messaging
from pulsekit.operators.anomaly import anomaly_bands, history_bands
from pulsekit.operators.prefix import series_index


def series(kind, slot):
    """Three series, one of a null metric, of uneven lengths, with gaps and null values."""
    rng = random.Random(5)
    rows = []
    for metric, n in (("a", 700), ("b", 9), (None, 60)):
        slots = sorted(rng.sample(range(3 * n), n))
        rows += [(metric, slot(s), None if rng.random() < 0.05 else float(rng.randrange(50))) for s in slots]
    rng.shuffle(rows)
    return rows, f"metric string, ts {kind}, value double"


KINDS = [("timestamp_ntz", lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=15 * s)),
         ("timestamp", lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(minutes=15 * s)), ("long", int)]


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is None, r[0] or "", r[1]))


@pytest.mark.parametrize("kind,slot", KINDS)
@pytest.mark.parametrize("block_rows,n", [(1, 5), (3, 5), (64, 4), (10_000, 5)])
def test_blocks_equal_one_window(spark, kind, slot, block_rows, n):
    long = spark.createDataFrame(*series(kind, slot))
    got = history_bands(long, 3.0, n, block_rows=block_rows, n_ranges=11)
    assert sorted_rows(got) == sorted_rows(anomaly_bands(long, 3.0, n))


def test_no_rows(spark):
    long = spark.createDataFrame([], "metric string, ts timestamp_ntz, value double")
    assert history_bands(long).collect() == []


def test_series_index_numbers_each_series(spark):
    rows, schema = series("long", int)
    got = series_index(spark.createDataFrame(rows, schema), ["metric"], "ts", n_ranges=7).collect()
    for metric in ("a", "b", None):
        mine = sorted((r for r in got if r.metric == metric), key=lambda r: r.ts)
        assert [r.idx for r in mine] == list(range(len(mine))) and mine


def test_messages_yesterday_equals_the_daily_frames(spark):
    as_of, yesterday = dt.date(2024, 1, 15), dt.date(2024, 1, 14)
    rng = random.Random(3)
    ids = [None, 0, 1, 2, 3, 4, 5]
    rows = [(rng.choice(ids), rng.choice(ids), dt.datetime(2024, 1, rng.randrange(6, 17), rng.randrange(24)))
            for _ in range(400)]
    for part in (rows, [r for r in rows if r[2].day != 14], []):
        m = spark.createDataFrame(part, "user_id long, receiver_id long, time timestamp_ntz")
        got = messaging.messages_yesterday(m, as_of).first()
        day = messaging.message_daily_range(m, yesterday, yesterday).first()
        weighted = messaging.message_daily_weighted(m, as_of).where(f"event_date = date '{yesterday}'").first()
        assert got.messenger_dau == (day.number_of_user_id if day else 0)
        assert got.messages_sent == (day.messages_sent if day else None)
        assert got.messages_sent_weighted == (weighted.messages_sent if weighted else None)
