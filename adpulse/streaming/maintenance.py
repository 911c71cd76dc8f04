"""Compaction of a click stream's tables.

Every micro-batch adds one folder to each table. Sums are associative, so the rows
of all batches up to `through` can be merged without changing any report or the
blacklist: the stream's reads ("batches before k") still see the same totals.

When: between runs (never over the last batch of a run, which a restart may
replay), or inside the stream at the start of batch `k` over the batches before
`k` (`process_batch(compact_every=...)`).

How: the days that batches since the last compaction touched are merged with their
earlier merged rows into a new version beside the live data; days that no such batch
touched keep their files. The manifest that names each day's version is written
last, as one file. Until then readers see the table as before; an interrupted
compaction leaves nothing but an unnamed folder, and the next one starts from the
live data again. Folders of batches are removed one compaction after they were
merged, and merged versions one compaction after the last manifest that names them,
so a reader that began before keeps its files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adpulse.schema import ALL_COUNTS_SCHEMA, RANGE_LOG_SCHEMA
from adpulse.sinks.writers import (
    MANIFEST_SCHEMA,
    batch_path,
    current_manifest,
    manifest_path,
    merged_path,
    numbered_folders,
    read_live,
    read_merged,
    remove_folder,
    replace_folder,
)
from adpulse.streaming.feedback import BUCKET_FIELD, BY_KIND, FLAGGED_SCHEMA, ClickTables, user_bucket


def write_manifest(rows: DataFrame, table: str, through: int) -> None:
    """Make `rows` (`day`, `version`, `marker`) the current manifest: the switch of a compaction."""
    replace_folder(rows.coalesce(1), f"{manifest_path(table)}/through={through}")


def _remove_batches(spark: SparkSession, table: str, upto: int) -> None:
    """Delete the live folders of batches `<= upto`."""
    path = spark._jvm.org.apache.hadoop.fs.Path(batch_path(table, 0)).getParent()
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("batch_id=") and int(name.removeprefix("batch_id=")) <= upto:
            files.delete(status.getPath(), True)


def _remove_superseded(spark: SparkSession, table: str, manifest: DataFrame | None, before: int, through: int) -> None:
    """Delete manifests older than the last one, and merged versions that neither it nor the new one names."""
    current = current_manifest(spark, table)[1]
    named = current if manifest is None else current.unionByName(manifest)
    kept = {row["version"] for row in named.select("version").distinct().collect()}
    for version in numbered_folders(spark, merged_path(table), "version"):
        if version not in kept:
            remove_folder(spark, f"{merged_path(table)}/version={version}")
    for old in numbered_folders(spark, manifest_path(table), "through"):
        if old not in (before, through):
            remove_folder(spark, f"{manifest_path(table)}/through={old}")


def compact_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    through: int,
    keys: Sequence[str],
    measures: dict[str, Column],
    buckets: int | None = None,
) -> None:
    """Merge the batches `<= through` of one table, one row per `keys` (see module doc).

    With `buckets` the merged rows of kind `user` are also stored by a hash of their user, so that a batch's
    lookup of its groups opens the buckets of its own users only.
    """
    before, manifest = current_manifest(spark, table)
    if before >= through:
        return
    by_day = "click_day" in keys
    live = read_live(spark, table, schema).where((F.col("batch_id") > before) & (F.col("batch_id") <= through))
    rows = live
    if manifest is not None:
        earlier = read_merged(spark, table, schema, manifest)
        if by_day:
            touched = live.select(F.col("click_day").alias("_touched")).distinct()
            earlier = earlier.join(touched, F.col("click_day").eqNullSafe(F.col("_touched")), "left_semi")
        rows = rows.unionByName(earlier)
    grouped = rows.groupBy(*keys)
    merged = grouped.agg(*[agg.alias(name) for name, agg in measures.items()]) if measures else rows.select(*keys).distinct()
    version = f"{merged_path(table)}/version={through}"
    if buckets is not None:
        of_user = F.when(F.col("kind") == "user", user_bucket(buckets)).otherwise(F.lit(0))
        replace_folder(merged.withColumn(BUCKET_FIELD.name, of_user), version, (*BY_KIND, BUCKET_FIELD.name))
    else:
        replace_folder(merged, version)

    new = F.lit(through).cast("long").alias("version")
    plain = F.lit(False).alias("marker")
    none = F.lit(None).cast("date").alias("day")
    marker = spark.range(1).select(none, new, F.lit(True).alias("marker"))
    if by_day:
        days = live.select(F.col("click_day").alias("day")).distinct().select("day", new, plain)
        if manifest is not None:
            kept = manifest.where(~F.col("marker")).select("day", "version", "marker")
            renamed = days.select(F.col("day").alias("_day"))
            kept = kept.join(renamed, F.col("day").eqNullSafe(F.col("_day")), "left_anti")
            days = days.unionByName(kept)
    else:
        days = spark.range(1).select(none, new, plain)
    write_manifest(days.unionByName(marker).select(*MANIFEST_SCHEMA.fieldNames()[:3]), table, through)
    _remove_batches(spark, table, before)
    _remove_superseded(spark, table, manifest, before, through)


def compact_tables(spark: SparkSession, tables: ClickTables, through: int) -> None:
    """Merge the batches `<= through` of every table of `tables`."""
    counts = {"clicks": F.sum("clicks"), "on_minute": F.sum("on_minute")}
    latest = {"offset": F.max_by("offset", "batch_id"), "from_offset": F.max_by("from_offset", "batch_id")}
    plans = (
        (tables.counts, ALL_COUNTS_SCHEMA, counts, tables.user_buckets),
        (tables.flagged, FLAGGED_SCHEMA, {}, None),
        (tables.blacklist, FLAGGED_SCHEMA, {}, None),
        (tables.ledger, RANGE_LOG_SCHEMA, latest, None),
    )
    for table, schema, measures, buckets in plans:
        keys = [f.name for f in schema.fields if f.name not in measures and f.name != "batch_id"]
        compact_table(spark, table, schema, through, keys, measures, buckets)
