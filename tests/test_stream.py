"""The click stream: replay safety, the feedback invariant, restart, late clicks, compaction."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import adpulse.streaming.feedback as fb
from adpulse.plans.streams import run_fixture_stream
from adpulse.schema import CITY_COUNT_SCHEMA, COUNT_SCHEMA, MESSAGE_SCHEMA
from adpulse.session import fresh_dir
from adpulse.sinks.writers import read_batches
from adpulse.sources.fixtures import messages_from_events
from adpulse.sources.stream import message_slices, read_click_stream
from adpulse.functions.parse import parse_clicks


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def tables_state(spark, tables):
    return (
        rows_of(read_batches(spark, tables.user_counts, COUNT_SCHEMA)),
        rows_of(read_batches(spark, tables.city_counts, CITY_COUNT_SCHEMA)),
        rows_of(fb.published_blacklist(spark, tables)),
        rows_of(fb.stream_committed_offsets(spark, tables, "g")),
    )


@pytest.fixture(scope="module")
def fixture_messages(spark, sf_small):
    return messages_from_events(spark, sf_small, keep_event_id=True).persist()


def test_replayed_batch_leaves_tables_unchanged(spark, fixture_messages):
    tables = fb.ClickTables(fresh_dir(spark, "replay"))
    tables.create(spark)
    parts = message_slices(fixture_messages, 3)
    fb.process_batch(spark, parts[0], 0, tables, threshold=1, group_id="g")
    fb.process_batch(spark, parts[1], 1, tables, threshold=1, group_id="g")
    once = tables_state(spark, tables)
    fb.process_batch(spark, parts[1], 1, tables, threshold=1, group_id="g")  # replay of the last batch
    assert tables_state(spark, tables) == once


def test_blacklisted_users_do_not_depend_on_batch_boundaries(spark, fixture_messages):
    def users(slices):
        tables = fb.ClickTables(fresh_dir(spark, f"invariant{slices}"))
        tables.create(spark)
        for k, part in enumerate(message_slices(fixture_messages, slices)):
            fb.process_batch(spark, part, k, tables, threshold=1, group_id="g")
        return {r.user_id for r in fb.published_blacklist(spark, tables).collect()}

    one, seven = users(1), users(7)
    assert one == seven and len(one) == 10  # FIXTURES.md: 10 users at sf0.001


def test_seed_blacklist_is_applied_from_the_first_batch(spark, fixture_messages):
    seed = fresh_dir(spark, "seed")
    spark.createDataFrame([(8,), (None,)], "id long").write.parquet(seed)  # any first column, any type
    tables = fb.ClickTables(fresh_dir(spark, "seeded"))
    tables.create(spark)
    fb.process_batch(spark, fixture_messages.drop("event_id"), 0, tables, threshold=100, group_id="g", seed_path=seed)
    counts = read_batches(spark, tables.user_counts, COUNT_SCHEMA)
    assert counts.where(F.col("user_id") == "8").count() == 0
    assert counts.where(F.col("user_id") == "3").count() > 0
    assert {r.user_id for r in fb.published_blacklist(spark, tables).collect()} == {"8"}


def test_quarantine_mode_keeps_bad_messages(spark):
    good = '{"userId":"1","accessTime":"2024-01-01 00:00:00","province":"P","city":"C","advId":"2"}'
    batch = spark.createDataFrame([("t", 0, 0, good), ("t", 0, 1, "{oops"), ("t", 0, 2, "")], MESSAGE_SCHEMA)
    tables = fb.ClickTables(fresh_dir(spark, "quarantine"))
    tables.create(spark)
    fb.process_batch(spark, batch, 0, tables, group_id="g", parse_mode="QUARANTINE")
    assert spark.read.parquet(tables.quarantine).count() == 2
    assert read_batches(spark, tables.user_counts, COUNT_SCHEMA).count() == 1
    # the ledger still moves past the bad messages
    assert fb.stream_committed_offsets(spark, tables, "g").collect()[0].committed_offset == 3


def test_stream_equals_batch_and_ledger_reaches_the_end(spark, sf_small):
    tables = run_fixture_stream(spark, sf_small, 1)
    from adpulse.plans.catalog import q_blacklist_users

    batch = {r.user_id for r in q_blacklist_users(spark, sf_small).collect()}
    assert {r.user_id for r in fb.published_blacklist(spark, tables).collect()} == batch and len(batch) == 10
    committed = {r.partition: r.committed_offset for r in fb.stream_committed_offsets(spark, tables, "ad-clicks").collect()}
    assert committed == {0: 250, 1: 250, 2: 250, 3: 250}


def test_failed_batch_replays_without_double_counting(spark, fixture_messages, monkeypatch):
    log = fresh_dir(spark, "log")
    parts = message_slices(fixture_messages, 2)
    clean_run = fb.ClickTables(fresh_dir(spark, "clean_run"))
    crashed = fb.ClickTables(fresh_dir(spark, "crashed"))

    def run(tables):
        q = fb.run_click_stream(spark, read_click_stream(spark, path=log), tables, group_id="g", threshold=1,
                                trigger={"availableNow": True})
        q.awaitTermination()

    parts[0].write.parquet(log)
    run(clean_run)
    run(crashed)
    parts[1].write.mode("append").parquet(log)
    run(clean_run)

    real_publish = fb.publish_blacklist
    calls = {"n": 0}

    def crash_once(*args, **kwargs):  # fails after batch 1 wrote its counts
        calls["n"] += 1
        raise RuntimeError("executor lost")

    monkeypatch.setattr(fb, "publish_blacklist", crash_once)
    with pytest.raises(Exception):
        run(crashed)
    assert calls["n"] == 1
    monkeypatch.setattr(fb, "publish_blacklist", real_publish)
    run(crashed)  # restart from the checkpoint: batch 1 is replayed under the same id
    assert tables_state(spark, crashed)[:3] == tables_state(spark, clean_run)[:3]


def test_late_clicks_and_open_windows_count(spark):
    body = '{{"userId":"u","accessTime":"{}","province":"P","city":"C","advId":"1"}}'
    tables = fb.ClickTables(fresh_dir(spark, "late"))
    tables.create(spark)
    for k, times in enumerate((["2024-01-01 10:00:00", "2024-01-01 12:00:00"], ["2024-01-01 08:00:00", "2024-01-01 11:55:00"])):
        batch = spark.createDataFrame([("t", k, i, body.format(t)) for i, t in enumerate(times)], MESSAGE_SCHEMA)
        fb.process_batch(spark, batch, k, tables, group_id="g")
    starts = {r.window_start: r.clicks for r in fb.hourly_trend_so_far(spark, tables).collect()}
    assert starts[dt.datetime(2024, 1, 1, 8, 0)] == 1 and starts[dt.datetime(2024, 1, 1, 7, 10)] == 1
    assert starts[dt.datetime(2024, 1, 1, 11, 10)] == 2 and starts[dt.datetime(2024, 1, 1, 11, 0)] == 1
    assert starts[dt.datetime(2024, 1, 1, 12, 0)] == 1  # still open
    with pytest.raises(ValueError):
        fb.hourly_trend_so_far(spark, tables, "1 hour", "90 seconds")


def test_trend_from_minute_counts_is_exact_at_the_span_borders(spark):
    from adpulse.operators.reports import trend_last_hour

    times = ["2024-01-15 11:00:00", "2024-01-15 11:00:00.5", "2024-01-15 11:59:59", "2024-01-15 12:00:00",
             "2024-01-15 12:00:00.5", "2024-01-15 12:00:00"]
    body = '{{"userId":"u","accessTime":"{}","province":"P","city":"C","advId":"1"}}'
    batch = spark.createDataFrame([("t", 0, i, body.format(t)) for i, t in enumerate(times)], MESSAGE_SCHEMA)
    tables = fb.ClickTables(fresh_dir(spark, "minutes"))
    tables.create(spark)
    fb.process_batch(spark, batch, 0, tables, group_id="g")
    stored = rows_of(fb.trend_last_hour_so_far(spark, tables, "2024-01-15 12:00:00"))
    direct = rows_of(trend_last_hour(parse_clicks(batch), "2024-01-15 12:00:00").select("minute", "adv_id", "clicks"))
    assert stored == direct
    assert [r[2] for r in stored] == [1, 1, 2]
    with pytest.raises(ValueError):
        fb.trend_last_hour_so_far(spark, tables, "2024-01-15 12:00:30")


def test_message_archive_and_console_preview(spark):
    from adpulse.streaming.sinks import start_console_preview, start_message_archive

    log, out = fresh_dir(spark, "arch_log"), fresh_dir(spark, "arch_out")
    rows = [("t", 0, i, f"m{i}") for i in range(25)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).write.parquet(log)
    q = start_message_archive(read_click_stream(spark, path=log), f"{out}/text", f"{out}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    q.awaitTermination()  # a second run over the same checkpoint adds nothing
    q = start_message_archive(read_click_stream(spark, path=log), f"{out}/text", f"{out}/ck", trigger={"availableNow": True})
    q.awaitTermination()
    assert sorted(r.value for r in spark.read.text(f"{out}/text").collect()) == sorted(f"m{i}" for i in range(25))
    p = start_console_preview(read_click_stream(spark, path=log), 3, trigger={"availableNow": True})
    p.awaitTermination()
    assert p.exception() is None


def test_compaction_keeps_every_result(spark, fixture_messages):
    from adpulse.streaming.maintenance import compact_tables

    def run(tables, parts):
        for k, part in parts:
            fb.process_batch(spark, part, k, tables, threshold=1, group_id="g")

    def results(tables):
        return (
            rows_of(fb.daily_city_counts(spark, tables)),
            rows_of(fb.top_ads_so_far(spark, tables)),
            rows_of(fb.published_blacklist(spark, tables)),
            rows_of(fb.stream_committed_offsets(spark, tables, "g")),
            rows_of(fb.minute_trend_so_far(spark, tables)),
            rows_of(fb.blacklist_snapshot(spark, tables, 99, None).distinct()),
        )

    parts = list(enumerate(message_slices(fixture_messages, 5)))
    plain, compacted = fb.ClickTables(fresh_dir(spark, "plain")), fb.ClickTables(fresh_dir(spark, "compacted"))
    for t in (plain, compacted):
        t.create(spark)
        run(t, parts[:4])
    compact_tables(spark, compacted, through=2)
    assert results(compacted) == results(plain)
    batches = {r.batch_id for r in read_batches(spark, compacted.user_counts, COUNT_SCHEMA).select("batch_id").distinct().collect()}
    assert batches == {2, 3}
    compact_tables(spark, compacted, through=2)  # a second call with the same bound does nothing
    run(compacted, parts[3:])  # replay of the last batch before compaction, then the next one
    run(plain, parts[4:])
    assert results(compacted) == results(plain)


def test_admission_cap_and_processing_time_trigger(spark):
    log = fresh_dir(spark, "cap_log")
    body = '{"userId":"u","accessTime":"2024-01-01 00:00:00","province":"P","city":"C","advId":"1"}'
    for i in range(3):  # three files
        rows = spark.createDataFrame([("t", 0, i * 10 + j, body) for j in range(10)], MESSAGE_SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(log)  # ten test rows, one file
    tables = fb.ClickTables(fresh_dir(spark, "cap"))
    q = fb.run_click_stream(spark, read_click_stream(spark, path=log, max_files_per_trigger=1), tables,
                            group_id="g", trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert sizes == [10, 10, 10]  # one file per micro-batch
    assert fb.stream_committed_offsets(spark, tables, "g").collect()[0].committed_offset == 30


def test_seed_reader_is_called_every_batch(spark, fixture_messages):
    calls = []

    def reader(s):
        calls.append(1)
        return s.createDataFrame([("8",)], "anything string")

    tables = fb.ClickTables(fresh_dir(spark, "seed_reader"))
    tables.create(spark)
    for k, part in enumerate(message_slices(fixture_messages, 2)):
        fb.process_batch(spark, part.drop("event_id"), k, tables, group_id="g", seed_path=reader)
    assert len(calls) >= 2
    assert read_batches(spark, tables.user_counts, COUNT_SCHEMA).where(F.col("user_id") == "8").count() == 0


def test_compaction_inside_the_stream_and_after_an_interruption(spark, fixture_messages, monkeypatch):
    import adpulse.streaming.maintenance as mt

    parts = list(enumerate(message_slices(fixture_messages, 6)))
    plain, inline = fb.ClickTables(fresh_dir(spark, "plain2")), fb.ClickTables(fresh_dir(spark, "inline"))
    for t, every in ((plain, None), (inline, 2)):
        t.create(spark)
        for k, part in parts[:5]:
            fb.process_batch(spark, part, k, t, threshold=1, group_id="g", compact_every=every)
    batches = {r.batch_id for r in read_batches(spark, inline.user_counts, COUNT_SCHEMA).select("batch_id").distinct().collect()}
    assert batches <= {1, 3, 4}  # compacted through 1 at batch 2, through 3 at batch 4

    # Batch 5 compacts through 4; its first attempt dies before the manifest of the first table is switched.
    real = mt.write_manifest

    def dying(*args, **kwargs):
        raise RuntimeError("executor lost before the switch")

    monkeypatch.setattr(mt, "write_manifest", dying)
    fb.process_batch(spark, parts[5][1], 5, plain, threshold=1, group_id="g", compact_every=None)
    with pytest.raises(RuntimeError):
        fb.process_batch(spark, parts[5][1], 5, inline, threshold=1, group_id="g", compact_every=5)
    monkeypatch.setattr(mt, "write_manifest", real)
    fb.process_batch(spark, parts[5][1], 5, inline, threshold=1, group_id="g", compact_every=5)  # the replay
    for read in (fb.daily_city_counts, fb.top_ads_so_far, fb.published_blacklist, fb.minute_trend_so_far):
        assert rows_of(read(spark, inline)) == rows_of(read(spark, plain))
    assert rows_of(fb.stream_committed_offsets(spark, inline, "g")) == rows_of(fb.stream_committed_offsets(spark, plain, "g"))


BODY = '{{"userId":"{}","accessTime":"2024-01-0{} 10:00:00","province":"P","city":"C","advId":"1"}}'


def small_batch(spark, *clicks):
    rows = [("t", 0, i, BODY.format(user, day)) for i, (user, day) in enumerate(clicks)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def city_total(spark, tables):
    return sum(r.clicks for r in fb.daily_city_counts(spark, tables).collect())


def fresh_tables(spark, name):
    tables = fb.ClickTables(fresh_dir(spark, name))
    tables.create(spark)
    return tables


def test_batches_after_an_interrupted_compaction_are_kept(spark, monkeypatch):
    import adpulse.streaming.maintenance as mt

    tables = fresh_tables(spark, "interrupted")
    for k in range(3):
        fb.process_batch(spark, small_batch(spark, (f"u{k}", 1)), k, tables, group_id="g", compact_every=None)
    real = mt.write_manifest

    def dying(rows, table, through):
        if table == tables.city_counts:
            raise RuntimeError("lost")
        real(rows, table, through)

    monkeypatch.setattr(mt, "write_manifest", dying)
    with pytest.raises(RuntimeError):
        mt.compact_tables(spark, tables, through=1)
    monkeypatch.setattr(mt, "write_manifest", real)
    for k in range(3, 6):
        fb.process_batch(spark, small_batch(spark, (f"u{k}", 1)), k, tables, group_id="g", compact_every=None)
    mt.compact_tables(spark, tables, through=4)
    assert city_total(spark, tables) == 6


def test_compaction_under_dynamic_overwrite(spark):
    import adpulse.streaming.maintenance as mt

    tables = fresh_tables(spark, "dynamic")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for k in range(3):
            fb.process_batch(spark, small_batch(spark, (f"u{k}", 1)), k, tables, group_id="g", compact_every=None)
        mt.compact_tables(spark, tables, through=1)
        assert city_total(spark, tables) == 3
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


def test_replay_after_the_seed_grew_leaves_no_stale_day(spark):
    seed = fresh_dir(spark, "grown_seed")
    spark.createDataFrame([], "user_id string").write.parquet(seed)
    tables = fresh_tables(spark, "stale")
    batch = small_batch(spark, ("u1", 1), ("u2", 2))
    fb.process_batch(spark, batch, 0, tables, group_id="g", seed_path=seed)
    spark.createDataFrame([("u1",)], "user_id string").write.mode("append").parquet(seed)
    fb.process_batch(spark, batch, 0, tables, group_id="g", seed_path=seed)
    assert city_total(spark, tables) == 1


def test_readers_see_full_totals_during_compaction_and_untouched_days_keep_their_files(spark, monkeypatch):
    import os

    import adpulse.streaming.maintenance as mt

    tables = fresh_tables(spark, "reader")
    for k, day in enumerate((1, 2, 3, 3)):
        fb.process_batch(spark, small_batch(spark, (f"u{k}", day)), k, tables, group_id="g", compact_every=None)
    started = fb.daily_city_counts(spark, tables)
    seen = []
    real = mt.write_manifest

    def watched(rows, table, through):
        seen.append(city_total(spark, tables))
        real(rows, table, through)
        seen.append(city_total(spark, tables))

    monkeypatch.setattr(mt, "write_manifest", watched)
    mt.compact_tables(spark, tables, through=2)
    assert set(seen) == {4} and sum(r.clicks for r in started.collect()) == 4
    root = tables.city_counts.removeprefix("file:") + "/merged/version=2"
    files = {f: os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(root) for f in names}
    fb.process_batch(spark, small_batch(spark, ("u9", 3)), 4, tables, group_id="g", compact_every=None)
    mt.compact_tables(spark, tables, through=4)
    after = {f: os.stat(f"{d}/{f}").st_mtime_ns for d, _, names in os.walk(root) for f in names}
    assert after == files and city_total(spark, tables) == 5
    new = os.listdir(tables.city_counts.removeprefix("file:") + "/merged/version=4")
    assert [n for n in new if n.startswith("click_day")] == ["click_day=2024-01-03"]


def test_clean_clicks_are_kept_once_and_previewed(spark, fixture_messages, capsys):
    from adpulse.streaming.sinks import clean_click_preview, clean_click_table, clean_clicks_so_far

    tables, kept = fb.ClickTables(fresh_dir(spark, "clean")), fresh_dir(spark, "clean_rows")
    tables.create(spark)
    store = clean_click_table(kept)
    for k, part in enumerate(message_slices(fixture_messages, 2)):
        for _ in range(2):  # each batch is replayed
            fb.process_batch(spark, part, k, tables, threshold=1, group_id="g", clean_to=store)
    counted = sum(r.clicks for r in fb.daily_city_counts(spark, tables).collect())
    rows = clean_clicks_so_far(spark, kept)
    assert rows.count() == counted and {r.batch_id for r in rows.select("batch_id").distinct().collect()} == {0, 1}
    capsys.readouterr()
    clean_click_preview(2)(rows.drop("batch_id"), 0)
    assert "only showing top 2 rows" in capsys.readouterr().out


def test_log_starts_at_the_ledger_under_a_cap(spark):
    from adpulse.streaming.sinks import clean_click_table, clean_clicks_so_far

    log, kept = fresh_dir(spark, "resume_log"), fresh_dir(spark, "resume_rows")
    body = '{"userId":"u","accessTime":"2024-01-01 00:00:00","province":"P","city":"C","advId":"1"}'
    for i in range(3):
        rows = spark.createDataFrame([("t", 0, i * 10 + j, body) for j in range(10)], MESSAGE_SCHEMA)
        rows.coalesce(1).write.mode("append").parquet(log)  # ten test rows, one file
    starts = spark.createDataFrame([("t", 0, 13)], "topic string, partition int, start_offset long")
    tables = fb.ClickTables(fresh_dir(spark, "resume"))
    for _ in range(2):  # the second run finds nothing new
        stream = read_click_stream(spark, path=log, starting_offsets=starts, max_files_per_trigger=1)
        q = fb.run_click_stream(spark, stream, tables, group_id="g", trigger={"availableNow": True}, clean_to=clean_click_table(kept))
        q.awaitTermination()
    assert sorted(r.offset for r in clean_clicks_so_far(spark, kept).collect()) == list(range(13, 30))
    assert fb.stream_committed_offsets(spark, tables, "g").collect()[0].committed_offset == 30
