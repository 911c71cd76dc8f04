"""Resuming a stored log loses no message: empty logs, later partitions, a crash between ledger and checkpoint."""

import pytest
from pyspark.sql import functions as F

import adpulse.streaming.feedback as fb
from adpulse.operators.offsets import committed_offsets, latest_offsets, observe_ranges, resume_read, start_positions
from adpulse.schema import LEDGER_SCHEMA, MESSAGE_SCHEMA, RANGE_LOG_SCHEMA, START_SCHEMA
from adpulse.session import fresh_dir
from adpulse.sinks.writers import read_batches
from adpulse.sources.stream import read_click_stream

BODY = '{"userId":"u","accessTime":"2024-01-01 10:00:00","province":"P","city":"C","advId":"1"}'


def append(spark, log, *places):
    rows = [("t", partition, offset, BODY) for partition, offset in places]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(log)


def run(spark, log, tables):
    """One start of the stream as an application would do it: positions from the ledger, kept at the first start."""

    def starts():
        stored = spark.read.schema(MESSAGE_SCHEMA).parquet(log)
        ledger = read_batches(spark, tables.ledger, RANGE_LOG_SCHEMA).select(*LEDGER_SCHEMA.fieldNames(), "batch_id")
        return start_positions(latest_offsets(stored), committed_offsets(ledger, "g"))

    tables.create(spark)
    stream = read_click_stream(spark, path=log, starting_offsets=tables.started(spark, starts))
    query = fb.run_click_stream(spark, stream, tables, group_id="g", trigger={"availableNow": True})
    query.awaitTermination()


def total(spark, tables):
    return sum(r.clicks for r in fb.daily_city_counts(spark, tables).collect())


def test_a_log_that_was_empty_is_read_from_then_on(spark):
    log, tables = fresh_dir(spark, "empty_log"), fb.ClickTables(fresh_dir(spark, "empty_tables"))
    append(spark, log)
    run(spark, log, tables)
    append(spark, log, (0, 0), (0, 1))
    run(spark, log, tables)
    assert total(spark, tables) == 2


def test_a_partition_that_came_later_is_read_from_its_beginning(spark):
    log, tables = fresh_dir(spark, "grown_log"), fb.ClickTables(fresh_dir(spark, "grown_tables"))
    append(spark, log, (0, 0), (0, 1))
    run(spark, log, tables)  # nothing was committed: the start is the end of the log
    assert total(spark, tables) == 0
    append(spark, log, (0, 2), (1, 0))
    run(spark, log, tables)
    assert total(spark, tables) == 2


def test_a_crash_between_ledger_and_checkpoint_keeps_the_batch(spark):
    log, tables = fresh_dir(spark, "crash_log"), fb.ClickTables(fresh_dir(spark, "crash_tables"))
    append(spark, log)
    run(spark, log, tables)
    append(spark, log, (0, 0), (0, 1), (1, 0))

    real = fb.process_batch

    def dying(*args, **kwargs):  # the batch is done and its ledger written; the checkpoint never hears of it
        real(*args, **kwargs)
        raise RuntimeError("driver lost")

    fb.process_batch = dying
    try:
        with pytest.raises(Exception, match="driver lost"):
            run(spark, log, tables)
    finally:
        fb.process_batch = real
    assert total(spark, tables) == 3
    ledger = {(r.partition, r.committed_offset) for r in fb.stream_committed_offsets(spark, tables, "g").collect()}
    assert ledger == {(0, 2), (1, 1)}
    run(spark, log, tables)  # the replay reads what the batch read
    assert total(spark, tables) == 3
    ledger = {(r.partition, r.committed_offset) for r in fb.stream_committed_offsets(spark, tables, "g").collect()}
    assert ledger == {(0, 2), (1, 1)}


def test_the_start_record_is_written_once_and_again_after_a_torn_write(spark):
    tables = fb.ClickTables(fresh_dir(spark, "record"))
    first = spark.createDataFrame([("t", 0, 5)], START_SCHEMA)
    later = spark.createDataFrame([("t", 0, 9)], START_SCHEMA)
    assert tables.started(spark, lambda: first).collect() == first.collect()
    assert tables.started(spark, lambda: later).collect() == first.collect()
    torn = fb.ClickTables(fresh_dir(spark, "torn"))
    later.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(torn.start)
    assert torn.started(spark, lambda: first).collect() == first.collect()


@pytest.mark.parametrize("listed", [[(0, 3)], [(0, 3), (2, 1)], [(0, 3), (500, 1)], [(0, None)], []])
def test_only_rows_below_a_listed_start_are_left_out(spark, listed):
    rows = [(t, p, o, "") for t in ("t", "u", None) for p in (0, 1, 2, 500, None) for o in range(5)]
    log = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    starts = spark.createDataFrame([("t", p, o) for p, o in listed], START_SCHEMA)
    below = {("t", p, o) for p, s in listed if s is not None for o in range(s)}
    want = [r[:3] for r in rows if r[:3] not in below]
    assert sorted((tuple(r)[:3] for r in resume_read(log, starts).collect()), key=repr) == sorted(want, key=repr)


def test_ranges_are_observed_in_the_pass_that_reads_the_messages(spark):
    rows = [("t", 0, k, "") for k in (7, 3, 5)] + [("t", 2, 9, "")]
    messages = spark.createDataFrame(rows, MESSAGE_SCHEMA).repartition(3)
    seen, ranges = observe_ranges(messages, [("t", 0), ("t", 1), ("t", 2)])
    assert seen.groupBy("topic").count().collect()[0][1] == 4
    assert ranges() == [("t", 0, 3, 8), ("t", 2, 9, 10)]
    seen, ranges = observe_ranges(messages, [("t", 0)])
    seen.count()
    assert ranges() is None  # a message of a partition that is not listed
    assert observe_ranges(messages, [])[1]() is None
    assert observe_ranges(messages, [("t", p) for p in range(100)])[1]() is None


def test_a_batch_whose_clicks_are_all_blacklisted_still_moves_the_ledger(spark):
    """Spark may find the join empty and drop the observation with it: the ranges are aggregated then."""
    seed = spark.createDataFrame([("u",)], "user_id string")
    tables = fb.ClickTables(fresh_dir(spark, "all_out"))
    tables.create(spark)
    known = set()
    for k in range(2):
        batch = spark.createDataFrame([("t", 0, 2 * k + i, BODY) for i in range(2)], MESSAGE_SCHEMA)
        fb.process_batch(spark, batch, k, tables, group_id="g", seed_path=lambda s: seed, known_partitions=known)
        assert known == {("t", 0)}
    assert total(spark, tables) == 0
    found = {(r.batch_id, r.from_offset, r.until_offset) for r in fb.stream_offset_ranges(spark, tables, "g").collect()}
    assert found == {(0, 0, 2), (1, 2, 4)}
    empty = spark.createDataFrame([], MESSAGE_SCHEMA)
    fb.process_batch(spark, empty, 2, tables, group_id="g", known_partitions=known)
    assert fb.stream_offset_ranges(spark, tables, "g").where(F.col("batch_id") == 2).count() == 0
