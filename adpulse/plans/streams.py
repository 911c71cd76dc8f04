"""Registered queries that go through Structured Streaming.

Each one cuts the message log made from `events` into `STREAM_SLICES`
consecutive slices and appends them one by one to a log folder on shared
storage; after each append the streaming query is (re)started from its
checkpoint with `availableNow`, which reads exactly the new slice as one
micro-batch. So the log arrives in order, and every slice after the first also
exercises recovery from the checkpoint. The query returns a DataFrame over
what the stream wrote.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from adpulse.plans.catalog import CLICK_OUT, TREND_AS_OF, present, q_blacklist_users
from adpulse.operators.offsets import committed_offsets, latest_offsets, start_positions
from adpulse.session import fresh_dir
from adpulse.schema import BLACKLIST_SCHEMA, DEFAULT_THRESHOLD
from adpulse.sinks.writers import publish_blacklist, read_blacklist
from adpulse.sources.fixtures import LEDGER_GROUP, TOPIC, ledger_from_messages, messages_from_events, read_fixture
from adpulse.sources.stream import message_slices, read_click_stream
from adpulse.sources.tables import read_table
from adpulse.streaming.feedback import (
    CleanSink,
    ClickTables,
    SeedReader,
    daily_city_counts,
    hourly_trend_so_far,
    published_blacklist,
    run_click_stream,
    running_top_ads,
    stream_committed_offsets,
    stream_offset_ranges,
    top_ads_so_far,
    trend_last_hour_so_far,
)
from adpulse.streaming.sinks import clean_click_table, clean_clicks_so_far
from adpulse.streaming.stateful import TrendState, daily_city_totals, start_daily_city_counts, start_trend_state, trend_from_state

STREAM_SLICES = 5
TEST_THRESHOLD = 1
SEED_EVERY = 7  # the outside blacklist names each customer whose key this divides
FILES_PER_TRIGGER = 2  # admission cap of the resumed stream
BYTES_PER_TRIGGER = 4 << 30  # admission cap of the sliced streams: above a slice, so that each is one micro-batch
LATE_ORDER = (0, 2, 1, 4, 3)  # the order in which the slices reach the stream with a watermark
CAPPED_FILES = 3  # files of a slice where the cap takes one file a batch
ROW_GROUP_BYTES = 16 << 20  # row groups of those files, before compression
INTERVAL = "5 seconds"  # the default micro-batch interval, for the stream that runs on the clock


def _await(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")


def replay_in_slices(
    spark: SparkSession,
    sf_dir: str,
    start: Callable[[str], StreamingQuery],
    order: Sequence[int] = tuple(range(STREAM_SLICES)),
    files: int | None = None,
) -> None:
    """Append the fixture's message log slice by slice (in `order`); after each, run `start(log_path)` until drained.

    The whole log is written once to shared storage, sorted by `event_id` within
    files, and each slice is a range read of that copy (the range predicate
    reaches the scan), so nothing is cached on executors that could be lost.

    `files` is the number of files that each slice is dealt to, whatever the cores and splits of the session; their
    row groups are small, so that many tasks read one file. By default a slice has as many as its read has tasks.
    """
    staged, log = fresh_dir(spark, "message_source"), fresh_dir(spark, "message_log")
    messages_from_events(spark, sf_dir, keep_event_id=True).sortWithinPartitions("event_id").write.parquet(staged)
    parts = message_slices(spark.read.parquet(staged), STREAM_SLICES)
    for part in [parts[at] for at in order]:
        if files is None:
            part.write.mode("append").parquet(log)
        else:
            dealt = part.repartition(files, "partition", "offset", "value")
            dealt.write.mode("append").option("parquet.block.size", ROW_GROUP_BYTES).parquet(log)
        _await(start(log))


def run_fixture_stream(
    spark: SparkSession,
    sf_dir: str,
    threshold: int,
    seed: SeedReader | None = None,
    clean_to: CleanSink | None = None,
    max_bytes: int = BYTES_PER_TRIGGER,
    running_totals: bool = False,
    files: int | None = None,
) -> ClickTables:
    tables = ClickTables(fresh_dir(spark, "click_stream"))

    def start(log: str) -> StreamingQuery:
        stream = read_click_stream(spark, path=log, max_bytes_per_trigger=max_bytes)
        return run_click_stream(
            spark, stream, tables, group_id=LEDGER_GROUP, threshold=threshold, seed_path=seed,
            trigger={"availableNow": True}, clean_to=clean_to, running_totals=running_totals,
        )

    replay_in_slices(spark, sf_dir, start, files=files)
    return tables


def q_stream_daily_city_ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(daily_city_counts(spark, run_fixture_stream(spark, sf_dir, TEST_THRESHOLD)))


def q_stream_blacklist_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published_blacklist(spark, run_fixture_stream(spark, sf_dir, TEST_THRESHOLD))


def q_stream_capped_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blacklist of a stream whose cap, one byte, cuts every slice into a micro-batch per file.

    Which users are flagged does not depend on where batches end. A slice has `CAPPED_FILES` files, so the number of
    batches does not follow the cores of the session, and a batch's messages grow as the log does.
    """
    tables = run_fixture_stream(spark, sf_dir, TEST_THRESHOLD, max_bytes=1, files=CAPPED_FILES)
    return published_blacklist(spark, tables)


def q_stream_running_top_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top ads per province from running totals that each batch carries on."""
    return running_top_ads(spark, run_fixture_stream(spark, sf_dir, TEST_THRESHOLD, running_totals=True))


def q_stream_top_ads_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_ads_so_far(spark, run_fixture_stream(spark, sf_dir, TEST_THRESHOLD), by=("province",), n=3)


def q_stream_committed_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offsets the stream committed to its ledger: once the log is drained, the end of every partition."""
    tables = run_fixture_stream(spark, sf_dir, TEST_THRESHOLD)
    return stream_committed_offsets(spark, tables, LEDGER_GROUP)


def q_stream_offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The range of offsets that each micro-batch read, observed while it counted its clicks."""
    return stream_offset_ranges(spark, run_fixture_stream(spark, sf_dir, TEST_THRESHOLD), LEDGER_GROUP)


def q_stream_trend_last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-minute clicks per ad in the hour up to 2024-01-15 12:00, from the stream's minute counts."""
    tables = run_fixture_stream(spark, sf_dir, TEST_THRESHOLD)
    return present(trend_last_hour_so_far(spark, tables, TREND_AS_OF))


def q_stream_hourly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 1 h / 10 min trend of the stream's clean clicks, open windows included."""
    return present(hourly_trend_so_far(spark, run_fixture_stream(spark, sf_dir, TEST_THRESHOLD)))


def q_stream_clean_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filtered clicks themselves: what each micro-batch let through."""
    kept = fresh_dir(spark, "clean_clicks")
    run_fixture_stream(spark, sf_dir, TEST_THRESHOLD, clean_to=clean_click_table(kept))
    return present(clean_clicks_so_far(spark, kept).select(*CLICK_OUT))


def q_stream_seeded_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts under an outside blacklist that is a stored table, re-read every batch; a number is its first column."""
    table = fresh_dir(spark, "outside_blacklist")
    named = read_fixture(spark, sf_dir, "customer").where(F.col("c_custkey") % SEED_EVERY == 0)
    named.select("c_custkey", "c_name").write.parquet(table)
    tables = run_fixture_stream(spark, sf_dir, TEST_THRESHOLD, seed=lambda s: read_table(s, "blacklist", path=table))
    return present(daily_city_counts(spark, tables))


def _stored_log(spark: SparkSession, sf_dir: str) -> str:
    log = fresh_dir(spark, "message_log")
    messages_from_events(spark, sf_dir).write.parquet(log)
    return log


def q_stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that starts where the group's ledger says, else at the end, under an admission cap of files.

    The log lies there as files when the stream starts. The first run is stopped after a batch of `FILES_PER_TRIGGER` files or
    more; the second finds the kept start record and drains the rest, also though its own ledger has moved by then. The
    default threshold flags nobody in `events` (FIXTURES.md), so the rows do not depend on where batches end.
    """
    log, kept = _stored_log(spark, sf_dir), fresh_dir(spark, "resumed_clicks")
    tables = ClickTables(fresh_dir(spark, "resumed_stream"))
    tables.create(spark)

    def starts() -> DataFrame:
        stored = spark.read.parquet(log)
        committed = committed_offsets(ledger_from_messages(stored), LEDGER_GROUP, TOPIC)
        return start_positions(latest_offsets(stored), committed)

    def start(trigger: dict) -> StreamingQuery:
        stream = read_click_stream(
            spark, path=log, starting_offsets=tables.started(spark, starts), max_files_per_trigger=FILES_PER_TRIGGER
        )
        return run_click_stream(
            spark, stream, tables, group_id=LEDGER_GROUP, threshold=DEFAULT_THRESHOLD,
            trigger=trigger, clean_to=clean_click_table(kept),
        )

    first = start({"processingTime": "0 seconds"})
    while first.isActive and first.lastProgress is None:
        first.awaitTermination(1)
    first.stop()
    _await(start({"availableNow": True}))
    return present(clean_clicks_so_far(spark, kept).select(*CLICK_OUT))


def q_stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of a stream on the default interval: a micro-batch every 5 seconds until the log is drained.

    At the default threshold, where the cut into batches cannot matter. One batch may take up to half of the files.
    """
    log, tables = _stored_log(spark, sf_dir), ClickTables(fresh_dir(spark, "interval_stream"))
    n_files = len(spark.read.parquet(log).inputFiles())
    stream = read_click_stream(spark, path=log, max_files_per_trigger=-(-n_files // 2))
    query = run_click_stream(
        spark, stream, tables, group_id=LEDGER_GROUP, threshold=DEFAULT_THRESHOLD, trigger={"processingTime": INTERVAL}
    )
    query.processAllAvailable()
    query.stop()
    return present(daily_city_counts(spark, tables))


def _final_blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users that the whole log blacklists, published and read back: the list of a stream without feedback."""
    path = fresh_dir(spark, "published_blacklist")
    publish_blacklist(q_blacklist_users(spark, sf_dir), path=path)
    return read_blacklist(spark, path, BLACKLIST_SCHEMA)


def q_stream_daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts out of streaming state in update mode, restarted after each slice."""
    root, blacklist = fresh_dir(spark, "daily_totals"), _final_blacklist(spark, sf_dir)

    def start(log: str) -> StreamingQuery:
        stream = read_click_stream(spark, path=log, max_bytes_per_trigger=BYTES_PER_TRIGGER)
        return start_daily_city_counts(spark, stream, root, blacklist, trigger={"availableNow": True})

    replay_in_slices(spark, sf_dir, start)
    return present(daily_city_totals(spark, root))


def q_stream_trend_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sliding trend out of state under a watermark; two slices of five arrive days late, behind it."""
    tables, blacklist = TrendState(fresh_dir(spark, "trend_state")), _final_blacklist(spark, sf_dir)

    def start(log: str) -> StreamingQuery:
        stream = read_click_stream(spark, path=log, max_bytes_per_trigger=BYTES_PER_TRIGGER)
        return start_trend_state(spark, stream, tables, blacklist, trigger={"availableNow": True})

    replay_in_slices(spark, sf_dir, start, LATE_ORDER)
    return present(trend_from_state(spark, tables))


def stream_queries() -> dict:
    return {
        "stream_daily_city_ad_clicks": q_stream_daily_city_ad_clicks,
        "stream_blacklist_users": q_stream_blacklist_users,
        "stream_top_ads_by_province": q_stream_top_ads_by_province,
        "stream_capped_blacklist": q_stream_capped_blacklist,
        "stream_running_top_ads": q_stream_running_top_ads,
        "stream_committed_offsets": q_stream_committed_offsets,
        "stream_offset_ranges": q_stream_offset_ranges,
        "stream_trend_last_hour": q_stream_trend_last_hour,
        "stream_hourly_trend": q_stream_hourly_trend,
        "stream_clean_clicks": q_stream_clean_clicks,
        "stream_seeded_blacklist": q_stream_seeded_blacklist,
        "stream_resume": q_stream_resume,
        "stream_interval": q_stream_interval,
        "stream_daily_totals": q_stream_daily_totals,
        "stream_trend_state": q_stream_trend_state,
    }
