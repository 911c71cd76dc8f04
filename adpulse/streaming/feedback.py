"""The click stream with its blacklist feedback loop, replay-safe.

Per micro-batch `k` (one `foreachBatch` call):

1. Snapshot of the blacklist = seed entries (an outside, read-only table,
   re-read every batch) plus every user flagged by batches before `k`.
2. Parse the batch, drop the snapshot's users (left anti join), and count the
   clean clicks by one GROUPING SETS aggregation per (day, user, ad) for the
   blacklist, per (day, province, city, ad) for the daily and top-N reports, and
   per (minute, ad) for the trends: one pass, one write of batch `k` of `counts`.
   The offset ranges of the batch are observed in the same pass.
3. Flag the users of groups touched in batch `k` whose total (all batches up
   to `k`) is above the threshold: only the batch's own days are read, of merged
   rows only its users' buckets. Store them as batch `k` of `flagged`, and
   append the users new to it to the published blacklist.
4. Advance the offset ledger by the observed ranges, last.

Every write replaces the folder of batch `k` as a whole, and step 1 reads only
batches before `k`, so replaying batch `k` after a failure (Structured
Streaming replays it under the same id from its checkpoint) leaves what one
run would, also if the seed changed in between. A step reads what the step
before has written, never a cached result that another thread is still
filling. Where the stream starts in a stored log is written once with its
tables (`ClickTables.started`): a replay reads the same messages however far the
ledger has moved. Reports are read from the tables at any time, also while they are
compacted (`daily_city_counts`, `top_ads_so_far`, `minute_trend_so_far`,
`trend_last_hour_so_far`, `hourly_trend_so_far`, `published_blacklist`,
`stream_committed_offsets`, `stream_offset_ranges` below).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from adpulse.functions.parse import parse_clicks
from adpulse.operators.blacklist import derive_blacklist, filter_blacklisted
from adpulse.operators.counts import total_click_counts
from adpulse.operators.offsets import batch_offset_ranges, committed_offsets, observe_ranges
from adpulse.operators.reports import (
    CITY_KEYS,
    DEFAULT_SLIDE,
    DEFAULT_WINDOW,
    bucketable,
    interval_seconds,
    spread_buckets,
    top_ads,
    trend_last_hour,
)
from adpulse.schema import (
    ALL_COUNTS_SCHEMA,
    BLACKLIST_SCHEMA,
    CITY_COUNT_SCHEMA,
    COUNT_SCHEMA,
    DEFAULT_THRESHOLD,
    MINUTE_COUNT_SCHEMA,
    PROVINCE_TOTALS_SCHEMA,
    RANGE_LOG_SCHEMA,
    START_SCHEMA,
)
from adpulse.sinks.writers import (
    CountTable,
    batch_path,
    current_manifest,
    ensure_table,
    folder_values,
    is_written,
    numbered_folders,
    publish_blacklist,
    read_batches,
    read_live,
    read_merged_days,
    read_one_batch,
    remove_folder,
    write_batch,
)
from adpulse.sources.tables import load_blacklist

BY_KIND = ("click_day", "kind")

# Merged user counts are stored in this many buckets a day, by a hash of the user.
USER_BUCKETS = 16
BUCKET_FIELD = T.StructField("user_bucket", T.IntegerType())

# Merge the finished batches' partitions every this many micro-batches (one hour at 5 s).
DEFAULT_COMPACT_EVERY = 720

FLAGGED_SCHEMA = T.StructType([*BLACKLIST_SCHEMA.fields, T.StructField("batch_id", T.LongType())])


@dataclass(frozen=True)
class ClickTables:
    """Where one click stream keeps its state (a folder on shared storage)."""

    root: str

    user_buckets: int = USER_BUCKETS

    @property
    def counts(self) -> str:
        return f"{self.root}/counts"

    @property
    def user_counts(self) -> CountTable:
        return CountTable(self.counts, "user")

    @property
    def city_counts(self) -> CountTable:
        return CountTable(self.counts, "city")

    @property
    def minute_counts(self) -> CountTable:
        return CountTable(self.counts, "minute")

    @property
    def flagged(self) -> str:
        return f"{self.root}/flagged"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def blacklist(self) -> str:
        return f"{self.root}/blacklist"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/_checkpoint"

    @property
    def province_totals(self) -> str:
        return f"{self.root}/province_totals"

    @property
    def start(self) -> str:
        return f"{self.root}/start"

    def create(self, spark: SparkSession) -> None:
        for path, schema, by in (
            (self.counts, ALL_COUNTS_SCHEMA, BY_KIND),
            (self.flagged, FLAGGED_SCHEMA, ()),
            (self.blacklist, FLAGGED_SCHEMA, ()),
            (self.ledger, RANGE_LOG_SCHEMA, ()),
        ):
            ensure_table(spark, path, schema, by)

    def started(self, spark: SparkSession, starts: Callable[[], DataFrame]) -> DataFrame:
        """Where this stream started in a stored log: `starts()` the first time, what was kept then ever after.

        The file source's checkpoint knows which files a batch read, not the positions within them; with the same
        positions at each restart, a batch that is replayed reads what it read before, also when the ledger has
        moved in between. Partitions that the record does not name are read from their beginning (`resume_read`).
        """
        if not is_written(spark, self.start):
            starts().select(*START_SCHEMA.fieldNames()).coalesce(1).write.mode("overwrite").parquet(self.start)
        return spark.read.schema(START_SCHEMA).parquet(self.start)


def user_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")


SeedReader = Callable[[SparkSession], DataFrame]
CleanSink = Callable[[DataFrame, int], None]


def _seed(spark: SparkSession, seed: str | SeedReader | None) -> DataFrame:
    """The outside blacklist, read now: a Parquet path, or a function that reads it (e.g. over JDBC)."""
    if seed is None:
        return spark.createDataFrame([], BLACKLIST_SCHEMA)
    table = seed(spark) if callable(seed) else spark.read.parquet(seed)
    return load_blacklist(table)


def blacklist_snapshot(
    spark: SparkSession, tables: ClickTables, batch_id: int, seed_path: str | SeedReader | None
) -> DataFrame:
    """Users blacklisted when batch `batch_id` starts: seed plus users flagged by earlier batches."""
    flagged = read_batches(spark, tables.flagged, FLAGGED_SCHEMA).where(F.col("batch_id") < batch_id)
    return _seed(spark, seed_path).unionByName(flagged.select("user_id"))


def batch_counts(clean: DataFrame) -> DataFrame:
    """Counts of all kinds (`KIND_COLUMNS`) of the clean clicks, by one GROUPING SETS aggregation.

    Every click is expanded to its three groups and summed before the shuffle, so the input is read once, and a
    hot group costs a row per task. Clicks without a time have no minute.
    """
    minute = F.date_trunc("minute", "ts")
    rows = clean.select(
        "click_day", "user_id", "adv_id", "province", "city", minute.alias("minute"), (F.col("ts") == minute).alias("_on")
    )
    sets = [["click_day", "user_id", "adv_id"], ["click_day", "province", "city", "adv_id"], ["click_day", "minute", "adv_id"]]
    counted = rows.groupingSets(sets, "click_day", "user_id", "adv_id", "province", "city", "minute").agg(
        F.count(F.lit(1)).alias("clicks"),
        F.count(F.when(F.col("_on"), True)).alias("on_minute"),
        F.when(F.grouping("user_id") == 0, "user").when(F.grouping("province") == 0, "city").otherwise("minute").alias("kind"),
    )
    in_minute = F.col("kind") == "minute"
    kept = counted.where(~in_minute | F.col("minute").isNotNull()).withColumn("on_minute", F.when(in_minute, F.col("on_minute")))
    return kept.select(*[f.name for f in ALL_COUNTS_SCHEMA if f.name != "batch_id"])


def touched_counts(spark: SparkSession, tables: ClickTables, batch_id: int) -> DataFrame:
    """Stored counts, up to batch `batch_id`, of the (day, user, ad) groups that this batch touched.

    Reads the batch's own days only: of the batches since the last compaction by the days' literals, of the
    merged rows only these days' folders, and in them only the buckets of the batch's users (dynamic partition
    pruning through the join, wherever the batch's groups are few enough to be broadcast). So the rows read do not
    grow with the days before.
    """
    days = [dt.date.fromisoformat(d) for d in folder_values(spark, batch_path(tables.counts, batch_id), "click_day")]
    now = read_one_batch(spark, tables.user_counts, COUNT_SCHEMA, batch_id)
    keys = now.select(
        F.col("click_day").alias("_day"), F.col("user_id").alias("_user"), F.col("adv_id").alias("_adv"),
        user_bucket(tables.user_buckets).alias("_bucket"),
    )
    # A parsed click always has a day, so plain equality holds there, and Spark can prune by it.
    same = (
        (F.col("click_day") == F.col("_day"))
        & F.col("user_id").eqNullSafe(F.col("_user"))
        & F.col("adv_id").eqNullSafe(F.col("_adv"))
    )
    through, manifest = current_manifest(spark, tables.user_counts)
    since = (F.col("batch_id") > through) & (F.col("batch_id") <= batch_id) & F.col("click_day").isin(days)
    parts = read_live(spark, tables.user_counts, COUNT_SCHEMA, since).join(keys, same, "left_semi")
    if manifest is not None and days:
        merged = read_merged_days(spark, tables.user_counts, COUNT_SCHEMA, manifest, days, [BUCKET_FIELD])
        if merged is not None:
            in_bucket = merged.join(keys, same & (F.col(BUCKET_FIELD.name) == F.col("_bucket")), "left_semi")
            parts = parts.unionByName(in_bucket.drop(BUCKET_FIELD.name))
    return parts


# Batches whose running totals stay readable.
RETAINED_TOTALS = 10


def write_running_totals(spark: SparkSession, tables: ClickTables, batch_id: int) -> None:
    """Store the clicks per (province, ad) of all batches up to `batch_id`: the batch before's totals and its own counts.

    One row per province and ad, whatever the number of batches. The first batch that keeps totals sums the
    counts before it once. A replay reads the same batch before and leaves the same rows.
    """
    own = read_one_batch(spark, tables.city_counts, CITY_COUNT_SCHEMA, batch_id)
    path = tables.province_totals
    if is_written(spark, batch_path(path, batch_id - 1)):
        before = read_one_batch(spark, path, PROVINCE_TOTALS_SCHEMA, batch_id - 1)
    else:
        before = read_batches(spark, tables.city_counts, CITY_COUNT_SCHEMA).where(F.col("batch_id") < batch_id)
    keys = ("province", "adv_id")
    rows = before.select(*keys, "clicks").unionByName(own.select(*keys, "clicks"))
    write_batch(total_click_counts(rows, keys), path, batch_id)
    for old in numbered_folders(spark, f"{path}/live", "batch_id"):
        if old <= batch_id - RETAINED_TOTALS:
            remove_folder(spark, batch_path(path, old))


def running_top_ads(spark: SparkSession, tables: ClickTables, n: int = 3) -> DataFrame:
    """Top-`n` ads per province from the newest running totals: no history is summed."""
    written = numbered_folders(spark, f"{tables.province_totals}/live", "batch_id")
    if not written:
        return top_ads(spark.createDataFrame([], PROVINCE_TOTALS_SCHEMA), by=("province",), n=n, counted=True)
    newest = read_one_batch(spark, tables.province_totals, PROVINCE_TOTALS_SCHEMA, written[-1])
    return top_ads(newest, by=("province",), n=n, counted=True)


def process_batch(
    spark: SparkSession,
    messages: DataFrame,
    batch_id: int,
    tables: ClickTables,
    *,
    threshold: int = DEFAULT_THRESHOLD,
    group_id: str,
    seed_path: str | SeedReader | None = None,
    parse_mode: str = "FAILFAST",
    compact_every: int | None = DEFAULT_COMPACT_EVERY,
    clean_to: CleanSink | None = None,
    known_partitions: set[tuple[str, int]] | None = None,
    running_totals: bool = False,
) -> None:
    """One micro-batch of the click stream (steps 1-4 of the module doc).

    `clean_to(clicks, batch_id)` gets the batch's clean clicks after the count table is written
    and before the ledger moves, so a replay calls it again under the same id
    (`clean_click_table`, `clean_click_preview` in `adpulse.streaming.sinks`).

    The messages are read once, by the write of the counts. They are cached only where something reads them
    again: the clean clicks for `clean_to`, the messages for the quarantine or for ranges that cannot be observed.
    `known_partitions` are the topic partitions whose ranges are observed in that pass; the batch's own are added to it.

    `running_totals` also keeps totals per province and ad (`write_running_totals`, read by `running_top_ads`).

    Every `compact_every` batches, the batch first merges the partitions of
    all batches before it (`compact_tables`), which keeps the number of
    directories a batch lists and reads bounded in a stream that never stops.
    A replay of the batch finishes an interrupted compaction.
    """
    if compact_every and batch_id > 0 and batch_id % compact_every == 0:
        from adpulse.streaming.maintenance import compact_tables

        compact_tables(spark, tables, through=batch_id - 1)

    cached = []
    try:
        if parse_mode == "QUARANTINE":
            messages = messages.persist()
            cached.append(messages)
        observed, ranges_seen = observe_ranges(messages, known_partitions or ())
        if observed is messages and not cached:  # the ranges will be aggregated: keep the source from being read twice
            messages = observed = messages.persist()
            cached.append(messages)
        if parse_mode == "QUARANTINE":
            clicks, _ = parse_clicks(observed, mode="QUARANTINE")
        else:
            clicks = parse_clicks(observed, mode=parse_mode)
        clean = filter_blacklisted(clicks, blacklist_snapshot(spark, tables, batch_id, seed_path))
        if clean_to is not None:
            # The batch's own session: let AQE also size the partitions of the cached plan.
            spark.conf.set("spark.sql.optimizer.canChangeCachedPlanOutputPartitioning", "true")
            clean = clean.persist()
            cached.append(clean)
        write_batch(batch_counts(clean), tables.counts, batch_id, BY_KIND)
        if parse_mode == "QUARANTINE":
            write_batch(parse_clicks(messages, mode="QUARANTINE")[1], tables.quarantine, batch_id)
        if clean_to is not None:
            clean_to(clean, batch_id)
        if running_totals:
            write_running_totals(spark, tables, batch_id)

        # Totals of the groups that this batch touched, from what is stored now.
        touched = touched_counts(spark, tables, batch_id).select("click_day", "user_id", "adv_id", "clicks")
        write_batch(derive_blacklist(touched, threshold), tables.flagged, batch_id)

        # The published blacklist grows by the users that are new to it.
        flagged = read_one_batch(spark, tables.flagged, FLAGGED_SCHEMA, batch_id)
        entries = _seed(spark, seed_path).unionByName(flagged.select("user_id")).where(F.col("user_id").isNotNull())
        known = read_batches(spark, tables.blacklist, FLAGGED_SCHEMA).where(F.col("batch_id") < batch_id)
        new = entries.distinct().join(known.select("user_id"), "user_id", "left_anti")
        publish_blacklist(new, path=tables.blacklist, batch_id=batch_id)

        # Last, once the data is written: the ledger. One row per topic partition.
        ranges = ranges_seen()
        if ranges is None:
            ranges = [tuple(row) for row in batch_offset_ranges(messages).collect()]
        if known_partitions is not None:
            known_partitions.update((topic, partition) for topic, partition, _, _ in ranges)
        entries = [(group_id, topic, partition, until, start) for topic, partition, start, until in ranges]
        row = T.StructType(RANGE_LOG_SCHEMA.fields[:5])
        write_batch(spark.createDataFrame(entries, row).coalesce(1), tables.ledger, batch_id)
    finally:
        # Blocking, so no block of this batch is still being dropped when the next batch caches and reads.
        for df in cached:
            df.unpersist(blocking=True)


def run_click_stream(
    spark: SparkSession,
    messages: DataFrame,
    tables: ClickTables,
    *,
    group_id: str,
    threshold: int = DEFAULT_THRESHOLD,
    seed_path: str | SeedReader | None = None,
    parse_mode: str = "FAILFAST",
    trigger: dict | None = None,
    query_name: str | None = None,
    compact_every: int | None = DEFAULT_COMPACT_EVERY,
    clean_to: CleanSink | None = None,
    running_totals: bool = False,
) -> StreamingQuery:
    """Start the click stream over a streaming `messages` DataFrame (see `read_click_stream`).

    `seed_path` names the outside blacklist (entries that do not come from the
    counts): a Parquet path, or a function `spark -> DataFrame` that reads it,
    for instance `lambda s: read_table(s, "blacklist", url=..., properties=...)`
    for a database table. It is read again at every batch.

    `trigger` is passed to `DataStreamWriter.trigger`: the reference's 5 s
    batches are `{"processingTime": "5 seconds"}` (the default);
    `{"availableNow": True}` drains what is there and stops. `clean_to` receives
    every batch's filtered clicks (see `process_batch`).
    """
    tables.create(spark)
    ledger = read_batches(spark, tables.ledger, RANGE_LOG_SCHEMA)
    # One entry per topic partition.
    known = {(row["topic"], row["partition"]) for row in ledger.select("topic", "partition").distinct().collect()}

    def each(batch: DataFrame, batch_id: int) -> None:
        process_batch(
            batch.sparkSession,
            batch,
            batch_id,
            tables,
            threshold=threshold,
            group_id=group_id,
            seed_path=seed_path,
            parse_mode=parse_mode,
            compact_every=compact_every,
            clean_to=clean_to,
            known_partitions=known,
            running_totals=running_totals,
        )

    writer = messages.writeStream.foreachBatch(each).option("checkpointLocation", tables.checkpoint)
    writer = writer.trigger(**(trigger or {"processingTime": "5 seconds"}))
    if query_name:
        writer = writer.queryName(query_name)
    return writer.start()


# ---- reports over the stream's tables -------------------------------------------


def published_blacklist(spark: SparkSession, tables: ClickTables) -> DataFrame:
    """Every user that the seed or the counts ever blacklisted, once (a blacklisting is permanent)."""
    return read_batches(spark, tables.blacklist, FLAGGED_SCHEMA).select("user_id").distinct()


def daily_city_counts(spark: SparkSession, tables: ClickTables) -> DataFrame:
    """Clicks per (day, province, city, ad) so far: the sum of every batch's partials."""
    return total_click_counts(read_batches(spark, tables.city_counts, CITY_COUNT_SCHEMA), CITY_KEYS)


def top_ads_so_far(spark: SparkSession, tables: ClickTables, by=("province",), n: int = 3) -> DataFrame:
    """Top-`n` ads per group from the accumulated city counts."""
    return top_ads(read_batches(spark, tables.city_counts, CITY_COUNT_SCHEMA), by=by, n=n, counted=True)


def minute_trend_so_far(spark: SparkSession, tables: ClickTables) -> DataFrame:
    """Clicks per (minute, ad) so far."""
    return total_click_counts(read_batches(spark, tables.minute_counts, MINUTE_COUNT_SCHEMA), ("minute", "adv_id"))


def trend_last_hour_so_far(
    spark: SparkSession, tables: ClickTables, as_of: str, span_minutes: int = 60, clicks: DataFrame | None = None
) -> DataFrame:
    """`trend_last_hour` (clicks with ts in (as_of - span, as_of], per minute and ad) from the stored minute counts.

    Exact for a minute-aligned `as_of`: the first minute of the span loses its
    clicks at exactly that minute (the span is open there), the minute `as_of`
    keeps only those (the span is closed there), every minute between counts whole.
    Any other `as_of` cuts two minutes in their midst: these two are counted from the clean `clicks`
    (`clean_clicks_so_far`), the minutes between from their counts; without `clicks` it raises.
    """
    end_at = dt.datetime.fromisoformat(as_of)
    start_at = end_at - dt.timedelta(minutes=span_minutes)
    aligned = not (end_at.second or end_at.microsecond)
    if not aligned and clicks is None:
        raise ValueError(f"as_of must fall on a minute, or the clean clicks be given: {as_of!r}")

    def at(moment: dt.datetime) -> Column:
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp")

    first = start_at.date()
    days = [first + dt.timedelta(days=i) for i in range((end_at.date() - first).days + 1)]
    minutes = read_batches(spark, tables.minute_counts, MINUTE_COUNT_SCHEMA).where(F.col("click_day").isin(days))
    if aligned:
        start, end = at(start_at), at(end_at)
        in_span = (
            F.when(F.col("minute") == start, F.col("clicks") - F.col("on_minute"))
            .when(F.col("minute") == end, F.col("on_minute"))
            .otherwise(F.col("clicks"))
        )
        rows = minutes.where((F.col("minute") >= start) & (F.col("minute") <= end)).withColumn("clicks", in_span)
        return total_click_counts(rows, ("minute", "adv_id")).where(F.col("clicks") > 0)
    first_whole = start_at.replace(second=0, microsecond=0) + dt.timedelta(minutes=1)
    last = end_at.replace(second=0, microsecond=0)
    whole = minutes.where((F.col("minute") >= at(first_whole)) & (F.col("minute") < at(last)))
    cut = clicks.where((F.col("ts") < at(first_whole)) | (F.col("ts") >= at(last)))
    cut = trend_last_hour(cut, as_of, f"{span_minutes} minutes")
    return total_click_counts(whole, ("minute", "adv_id")).unionByName(cut)


def hourly_trend_so_far(
    spark: SparkSession,
    tables: ClickTables,
    length: str = DEFAULT_WINDOW,
    slide: str = DEFAULT_SLIDE,
    by: Sequence[str] = ("click_day", "adv_id"),
) -> DataFrame:
    """The sliding trend of the clean clicks so far, from the stored minute counts.

    Late clicks count in the windows that they belong to, windows still open show
    what they hold now, and no streaming state is kept. Exact where window and
    slide are whole minutes and the window a whole number of slides; other
    lengths raise.
    """
    step = interval_seconds(slide)
    if not bucketable(length, slide) or step % 60:
        raise ValueError(f"minute counts give no exact windows of {length!r} every {slide!r}")
    minutes = read_batches(spark, tables.minute_counts, MINUTE_COUNT_SCHEMA)
    return spread_buckets(minutes.withColumnRenamed("minute", "bucket"), length, slide, by)


def stream_committed_offsets(spark: SparkSession, tables: ClickTables, group_id: str) -> DataFrame:
    return committed_offsets(read_batches(spark, tables.ledger, RANGE_LOG_SCHEMA), group_id)


def stream_offset_ranges(spark: SparkSession, tables: ClickTables, group_id: str) -> DataFrame:
    """What each batch read: `batch_id, topic, partition, from_offset, until_offset` (of merged batches, the last range)."""
    rows = read_batches(spark, tables.ledger, RANGE_LOG_SCHEMA).where(F.col("group_id") == group_id)
    return rows.select("batch_id", "topic", "partition", "from_offset", F.col("offset").alias("until_offset"))
