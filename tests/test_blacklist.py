"""Counting and blacklisting: edge rows (FIXTURES.md)."""

import datetime as dt


from adpulse.operators.blacklist import blacklist_rows, derive_blacklist, filter_blacklisted
from adpulse.operators.counts import click_counts, total_click_counts, typed_click_counts

DAY = dt.date(2024, 1, 1)


def clicks(spark, rows):
    return spark.createDataFrame(rows, "click_day date, user_id string, adv_id string")


def test_threshold_is_strict(spark):
    rows = [(DAY, "a", "1")] * 100 + [(DAY, "b", "1")] * 101
    users = {r.user_id for r in derive_blacklist(click_counts(clicks(spark, rows)), 100).collect()}
    assert users == {"b"}


def test_partials_are_summed_before_the_threshold(spark):
    partials = spark.createDataFrame(
        [(DAY, "a", "1", 60, 0), (DAY, "a", "1", 41, 1), (DAY, "b", "1", 100, 0)],
        "click_day date, user_id string, adv_id string, clicks long, batch_id long",
    )
    rows = blacklist_rows(partials, 100).collect()
    assert [(r.user_id, r.clicks) for r in rows] == [("a", 101)]


def test_rows_repeat_per_group_users_do_not(spark):
    d2 = DAY + dt.timedelta(days=1)
    rows = [(DAY, "a", "1")] * 3 + [(d2, "a", "1")] * 3 + [(DAY, "a", "2")] * 3
    counts = click_counts(clicks(spark, rows))
    assert derive_blacklist(counts, 2, distinct=False).count() == 3
    assert derive_blacklist(counts, 2).count() == 1


def test_separator_inside_ids_keeps_columns(spark):
    rows = [(DAY, "u__x", "a__b")] * 2 + [(DAY, "u", "")] * 2
    got = {(r.user_id, r.adv_id, r.clicks) for r in click_counts(clicks(spark, rows)).collect()}
    assert got == {("u__x", "a__b", 2), ("u", "", 2)}


def test_filter_keeps_null_users_and_ignores_null_entries(spark):
    data = clicks(spark, [(DAY, "a", "1"), (DAY, "b", "1"), (DAY, None, "1")])
    bl = spark.createDataFrame([("a",), ("a",), (None,)], "user_id string")
    left = filter_blacklisted(data, bl)
    assert sorted(str(r.user_id) for r in left.collect()) == ["None", "b"]
    # forced broadcast gives the same rows
    assert sorted(str(r.user_id) for r in filter_blacklisted(data, bl, broadcast=True).collect()) == ["None", "b"]


def test_blacklist_applies_to_every_day_and_ad(spark):
    d2 = DAY + dt.timedelta(days=3)
    data = clicks(spark, [(DAY, "a", "1"), (d2, "a", "7"), (DAY, "b", "1")])
    bl = spark.createDataFrame([("a",)], "user_id string")
    assert [r.user_id for r in filter_blacklisted(data, bl).collect()] == ["b"]


def test_typed_read_back(spark):
    table = spark.createDataFrame([("u", "9", "2024-01-05", "101")], "user_id string, adv_id string, click_day string, clicks string")
    row = typed_click_counts(table).collect()[0]
    assert row.click_day == dt.date(2024, 1, 5) and row.clicks == 101
    assert dict(typed_click_counts(table).dtypes) == {"user_id": "string", "adv_id": "string", "click_day": "date", "clicks": "int"}


def test_total_counts(spark):
    partials = spark.createDataFrame([(DAY, "a", "1", 2), (DAY, "a", "1", 3)], "click_day date, user_id string, adv_id string, clicks long")
    assert total_click_counts(partials).collect()[0].clicks == 5


def test_sql_form_equals_dataframe_form(spark):
    from adpulse.operators.blacklist import blacklist_sql

    rows = [(DAY, "a", "1")] * 3 + [(DAY, "a", "2")] * 3 + [(DAY, "b", "1")]
    counts = click_counts(clicks(spark, rows))
    assert sorted(r.user_id for r in blacklist_sql(counts, 2).collect()) == ["a", "a"]
    assert sorted(r.user_id for r in blacklist_sql(counts, 2).collect()) == sorted(
        r.user_id for r in derive_blacklist(counts, 2, distinct=False).collect()
    )


def test_registered_view_answers_sql(spark):
    from adpulse.sinks.writers import register_views

    rows = [(DAY, "a", "1")] * 3 + [(DAY, "b", "1")]
    register_views(spark, clickcount=click_counts(clicks(spark, rows)))
    got = spark.sql("SELECT user_id FROM clickcount GROUP BY click_day, user_id, adv_id HAVING sum(clicks) > 2").collect()
    assert [r.user_id for r in got] == ["a"]


def test_mark_method_equals_anti_join(spark):
    data = clicks(spark, [(DAY, "a", "1"), (DAY, "b", "1"), (DAY, None, "1"), (DAY, "c", "2")])
    bl = spark.createDataFrame([("a",), ("a",), (None,), ("c",)], "user_id string")
    anti = filter_blacklisted(data, bl)
    mark = filter_blacklisted(data, bl, method="mark")
    assert mark.columns == data.columns
    assert sorted(map(str, map(tuple, mark.collect()))) == sorted(map(str, map(tuple, anti.collect())))


def test_mark_method_stays_above_the_aggregate(spark, capsys):
    counts = click_counts(clicks(spark, [(DAY, "a", "1"), (DAY, "b", "1")]))
    bl = spark.createDataFrame([("a",)], "user_id string")
    capsys.readouterr()
    filter_blacklisted(counts, bl, method="mark").explain()
    plan = capsys.readouterr().out
    join_at = min(plan.find("LeftOuter"), 10**9)
    assert "LeftAnti" not in plan and join_at < plan.find("HashAggregate")  # join above (printed before) the aggregate


def test_drop_flagged_users_equals_filter_of_derived_blacklist(spark):
    from adpulse.operators.blacklist import drop_flagged_users

    d2 = DAY + dt.timedelta(days=1)
    rows = [(DAY, "a", "1")] * 3 + [(d2, "a", "2")] + [(DAY, "b", "1")] * 2 + [(DAY, None, "1")] * 5 + [(d2, "c", "3")]
    counts = click_counts(clicks(spark, rows))
    for threshold in (0, 1, 2, 3, 10):
        one_pass = sorted(map(str, map(tuple, drop_flagged_users(counts, threshold).collect())))
        two_pass = sorted(map(str, map(tuple, filter_blacklisted(counts, derive_blacklist(counts, threshold)).collect())))
        assert one_pass == two_pass, threshold
    # partial rows per group are totalled first: 2 + 2 > 3
    partials = spark.createDataFrame([(DAY, "a", "1", 2), (DAY, "a", "1", 2), (DAY, "b", "1", 3)],
                                     "click_day date, user_id string, adv_id string, clicks long")
    assert [r.user_id for r in drop_flagged_users(partials, 3).collect()] == ["b"]
