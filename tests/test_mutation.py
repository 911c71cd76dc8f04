"""With the blacklist switched off, every report that claims to apply it must differ from its statement."""

import pytest

from adpulse.plans import catalog, streams
from adpulse.streaming import feedback
from tools.oracle_check import compare, duck

BATCH = ("daily_city_ad_clicks", "top_ads_by_province", "top_ads_by_day_province", "hourly_trend", "trend_last_hour", "filter_blacklisted")
STREAM = ("stream_daily_city_ad_clicks", "stream_top_ads_by_province", "stream_trend_last_hour", "stream_hourly_trend")
SF_DIR = "/root/testdata/sf0.01"  # on the smallest tables no report of one hour meets a blacklisted user


def everything(rows, *args, **kwargs):
    return rows


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", BATCH)
def test_batch_reports_need_the_filter(spark, con, monkeypatch, name):
    monkeypatch.setattr(catalog, "drop_flagged_users", everything)
    monkeypatch.setattr(catalog, "filter_blacklisted", everything)
    assert not compare(spark, name, SF_DIR, con)["values_match"]


def test_stream_reports_need_the_filter(spark, con, monkeypatch):
    monkeypatch.setattr(feedback, "filter_blacklisted", everything)
    tables = streams.run_fixture_stream(spark, SF_DIR, streams.TEST_THRESHOLD)
    monkeypatch.setattr(streams, "run_fixture_stream", lambda *args, **kwargs: tables)
    assert [name for name in STREAM if compare(spark, name, SF_DIR, con)["values_match"]] == []
