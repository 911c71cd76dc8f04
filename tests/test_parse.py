"""Parsing click messages: edge rows (FIXTURES.md)."""

import pytest
from pyspark.errors import PySparkException

from adpulse.functions.parse import parse_clicks
from adpulse.schema import MESSAGE_SCHEMA


def messages(spark, values):
    rows = [("clicks", 0, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


GOOD = '{"userId":"7","accessTime":"2024-01-02 03:04:05.000006","province":"P","city":"C","advId":"9"}'


def test_good_message(spark):
    row = parse_clicks(messages(spark, [GOOD])).collect()[0]
    assert (row.user_id, row.province, row.city, row.adv_id) == ("7", "P", "C", "9")
    assert str(row.click_day) == "2024-01-02"
    assert row.ts.isoformat().startswith("2024-01-02T03:04:05.000006")
    assert (row.topic, row.partition, row.offset) == ("clicks", 0, 0)
    assert "value" not in parse_clicks(messages(spark, [GOOD])).columns


def test_unknown_keys_numbers_and_key_case(spark):
    text = '{"userId":42,"accessTime":"2024-01-02","province":"P","City":"X","advId":"","extra":{"a":1}}'
    row = parse_clicks(messages(spark, [text])).collect()[0]
    assert row.user_id == "42"  # numbers become text
    assert row.city is None  # keys match case-sensitively
    assert row.adv_id == ""  # an empty ad id stays an empty id
    assert row.ts is None and str(row.click_day) == "2024-01-02"  # a bare day has no time


def test_null_user_is_kept(spark):
    text = '{"accessTime":"2024-01-02 00:00:00","advId":"1"}'
    row = parse_clicks(messages(spark, [text])).collect()[0]
    assert row.user_id is None and row.adv_id == "1"


@pytest.mark.parametrize(
    "bad",
    ['{"userId":"1",', "not json", "", None, '{"userId":"1","accessTime":"yesterday"}', '{"userId":"1"}'],
)
def test_failfast_rejects(spark, bad):
    with pytest.raises(Exception) as err:
        parse_clicks(messages(spark, [GOOD, bad])).collect()
    assert isinstance(err.value, (PySparkException, Exception))


def test_quarantine_splits_good_and_bad(spark):
    values = [GOOD, '{"userId":"1",', "", None, '{"userId":"1","accessTime":"13/01/2024"}', "{}"]
    good, bad = parse_clicks(messages(spark, values), mode="QUARANTINE")
    assert good.count() == 1
    errors = {r.offset: r.error for r in bad.collect()}
    assert errors == {1: "malformed", 2: "empty", 3: "empty", 4: "bad accessTime", 5: "malformed"}
    # nothing is lost: every message is in exactly one output
    assert good.count() + bad.count() == len(values)
    assert set(bad.columns) == {"topic", "partition", "offset", "value", "error"}


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        parse_clicks(messages(spark, [GOOD]), mode="DROP")


def test_with_click_time_on_a_text_column(spark):
    from adpulse.functions.parse import with_click_time

    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-03",), ("soon",)], "access_time string")
    rows = with_click_time(df).collect()
    assert [str(r.click_day) for r in rows] == ["2024-01-02", "2024-01-03", "None"]
    assert rows[0].ts is not None and rows[1].ts is None and rows[2].ts is None


@pytest.mark.parametrize("rest", [" junk", "{}", ",", "]", "}", "] }", ',{"a":1}', ' "x"', "0"])
def test_json_followed_by_anything_is_malformed(spark, rest):
    good = '{"userId":"1","accessTime":"2024-01-01","province":"}{","city":"],[","advId":"2","more":[1,{"a":[]}]}'
    rows = spark.createDataFrame([("t", 0, 0, good), ("t", 0, 1, good + " \n"), ("t", 0, 2, good + rest)], MESSAGE_SCHEMA)
    kept, bad = parse_clicks(rows, mode="QUARANTINE")
    assert [r.offset for r in kept.orderBy("offset").collect()] == [0, 1]
    assert [(r.offset, r.error) for r in bad.collect()] == [(2, "malformed")]
    assert parse_clicks(rows.where("offset < 2")).count() == 2
    with pytest.raises(Exception):
        parse_clicks(rows).collect()
