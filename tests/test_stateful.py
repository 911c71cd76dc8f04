"""Streaming state: totals in update mode, the trend's buckets under a watermark, corrections, replays."""

import pandas as pd
import pytest

from adpulse.functions.parse import parse_clicks
from adpulse.operators.reports import daily_city_ad_clicks, hourly_trend
from adpulse.schema import BLACKLIST_SCHEMA, MESSAGE_SCHEMA
from adpulse.session import fresh_dir
from adpulse.sinks.writers import read_batches
from adpulse.sources.stream import read_click_stream
from adpulse.streaming import stateful as st

BODY = '{{"userId":{},"accessTime":"{}","province":"P","city":"C","advId":{}}}'


def append(spark, log, *clicks):
    rows = [("t", 0, i, BODY.format(user, time, ad)) for i, (user, time, ad) in enumerate(clicks)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(log)


DAYS = [
    [('"a"', "2024-01-02 10:00:00", '"1"'), ('"b"', "2024-01-02 10:09:59.9", '"1"'), ('"bad"', "2024-01-02 10:00:00", '"1"')],
    [('"a"', "2024-01-05 00:05:00", '"1"'), ("null", "2024-01-05 00:00:00", "null"), ('"a"', "2024-01-05", '"2"')],
    [('"a"', "2024-01-01 23:55:00", '"1"'), ('"a"', "2024-01-04 23:59:59", '"1"'), ('"b"', "2024-01-02 10:05:00", '"2"')],
]


def run(spark, log, start):
    for clicks in DAYS:
        append(spark, log, *clicks)
        query = start(read_click_stream(spark, path=log))
        query.awaitTermination()
        assert query.exception() is None
    return query


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def blacklist(spark):
    return spark.createDataFrame([("bad",), (None,)], BLACKLIST_SCHEMA)


def kept_clicks(spark, log):
    return parse_clicks(spark.read.schema(MESSAGE_SCHEMA).parquet(log)).where("user_id IS NULL OR user_id <> 'bad'")


def test_totals_in_update_mode_equal_the_batch_form(spark, blacklist):
    log, root = fresh_dir(spark, "upd_log"), fresh_dir(spark, "upd")
    run(spark, log, lambda s: st.start_daily_city_counts(spark, s, root, blacklist, {"availableNow": True}))
    assert rows_of(st.daily_city_totals(spark, root)) == rows_of(daily_city_ad_clicks(kept_clicks(spark, log)))
    last = read_batches(spark, f"{root}/totals", st.TOTALS_SCHEMA).where("batch_id = 2")
    assert {(str(r.click_day), r.adv_id) for r in last.collect()} == {
        ("2024-01-01", "1"), ("2024-01-04", "1"), ("2024-01-02", "2"),
    }


def test_trend_with_late_clicks_equals_the_batch_form(spark, blacklist):
    log, tables = fresh_dir(spark, "late_log"), st.TrendState(fresh_dir(spark, "late"))
    query = run(spark, log, lambda s: st.start_trend_state(spark, s, tables, blacklist, {"availableNow": True}))
    assert rows_of(st.trend_from_state(spark, tables)) == rows_of(hourly_trend(kept_clicks(spark, log)))
    late = read_batches(spark, tables.buckets, st.BUCKET_SCHEMA).where("late")
    assert {r.batch_id for r in late.collect()} == {2} and late.count() >= 1
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 * tables.shards  # a row per ad and shard


class FakeState:
    def __init__(self):
        self.value = None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value


def test_a_key_holds_few_buckets_however_long_the_stream():
    tables = st.TrendState("unused", delay="30 minutes")
    advance, state, total, late = st._advance(600, 1800), FakeState(), 0, 0
    kept = {}
    for k in range(500):
        seconds = pd.DataFrame({"second": [k * 400, k * 400 + 399, max(0, k * 400 - 5000), 7]})
        for out in advance(("ad", 0), iter([seconds.iloc[:2], seconds.iloc[2:]]), state):
            for _, _, bucket, clicks, is_late in out.itertuples(index=False):
                if is_late:
                    late += clicks
                else:
                    kept[bucket] = max(kept.get(bucket, 0), clicks)
        total += 4
        assert len(state.value[1]) <= tables.open_buckets()
    assert sum(kept.values()) + late == total and late > 400


def test_windows_that_buckets_cannot_build_are_refused(spark):
    log = fresh_dir(spark, "refused_log")
    append(spark, log)
    stream = read_click_stream(spark, path=log)
    with pytest.raises(ValueError):
        st.start_trend_state(spark, stream, st.TrendState("x", length="25 minutes"))
