"""Sinks: per-batch count tables, the published blacklist, message archives, views.

A per-batch table is a folder with three parts:

* `live/batch_id=k`: what batch `k` wrote, replaced as a whole, so writing a batch
  twice (a replay after a failure) leaves the table as one write would, whatever
  rows or days the first attempt had;
* `merged/version=t`: rows of many finished batches merged by `compact_tables`,
  never changed once written;
* `manifest/through=t`: which merged version holds each day, and that batches up to
  `t` are merged. It is written last and in one file: readers see the table as it
  was before or after a compaction, never in between.

The count table holds rows of three kinds (`KIND_COLUMNS`), stored by day and kind; a `CountTable`
is its path with the kind that is meant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adpulse.schema import ALL_COUNTS_SCHEMA

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("day", T.DateType()),
        T.StructField("version", T.LongType()),
        T.StructField("marker", T.BooleanType()),
        T.StructField("through", T.LongType()),
    ]
)

#: Versions of a published blacklist that stay readable.
RETAINED_VERSIONS = 10


class CountTable(str):
    """The path of the count table, and the kind of its rows that a reader of this name sees."""

    kind: str

    def __new__(cls, path: str, kind: str) -> CountTable:
        table = super().__new__(cls, path)
        table.kind = kind
        return table


def batch_path(table: str, batch_id: int) -> str:
    return f"{table.rstrip('/')}/live/batch_id={batch_id}"


def merged_path(table: str) -> str:
    return f"{table.rstrip('/')}/merged"


def manifest_path(table: str) -> str:
    return f"{table.rstrip('/')}/manifest"


def numbered_folders(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers n of the folders `key=n` below `path` whose write has ended; none where `path` is missing.

    A listing, not a Spark job. Anything else that goes wrong raises.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith(f"{key}=") and files.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name.removeprefix(f"{key}=")))
    return sorted(found)


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a write to the folder `path` has ended."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def folder_values(spark: SparkSession, path: str, key: str) -> list[str]:
    """The values v of the partition folders `key=v` below `path`, in order. A listing, not a Spark job."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    statuses = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [status.getPath().getName() for status in statuses]
    return sorted(name.removeprefix(f"{key}=") for name in names if name.startswith(f"{key}="))


def remove_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def replace_folder(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole folder `path` by `rows`; a day's rows are gathered first, and split again where they are many."""
    rows = rows.hint("rebalance", *partition_by) if partition_by else rows
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def ensure_table(spark: SparkSession, table: str, schema: T.StructType, partition_by: Sequence[str] = ()) -> None:
    """Create an empty per-batch table, unless one is there already."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").partitionBy("batch_id", *partition_by).parquet(f"{table.rstrip('/')}/live")


def write_batch(rows: DataFrame, table: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Replace what batch `batch_id` wrote to `table` with `rows`, as a whole: empty `rows` empty it."""
    replace_folder(rows.drop("batch_id"), batch_path(table, batch_id), partition_by)


def current_manifest(spark: SparkSession, table: str) -> tuple[int, DataFrame | None]:
    """The batch up to which `table` is merged (-1: none) and the rows of its manifest."""
    written = numbered_folders(spark, manifest_path(table), "through")
    if not written:
        return -1, None
    through = written[-1]
    rows = spark.read.schema(MANIFEST_SCHEMA).option("basePath", manifest_path(table))
    return through, rows.parquet(f"{manifest_path(table)}/through={through}")


def _of_kind(rows: DataFrame, table: str) -> DataFrame:
    return rows.where(F.col("kind") == table.kind) if isinstance(table, CountTable) else rows


def _stored_schema(table: str, schema: T.StructType) -> T.StructType:
    """`schema` as it lies in the files: the count table also has the kind."""
    if isinstance(table, CountTable) and "kind" not in schema.fieldNames():
        return T.StructType([*schema.fields, ALL_COUNTS_SCHEMA["kind"]])
    return schema


def read_merged(
    spark: SparkSession, table: str, schema: T.StructType, manifest: DataFrame, extra: Sequence[T.StructField] = ()
) -> DataFrame:
    """The merged rows that the manifest names, `batch_id` being their version."""
    path = merged_path(table)
    columns = [f for f in _stored_schema(table, schema).fields if f.name != "batch_id"]
    stored = T.StructType([*columns, *extra, T.StructField("version", T.LongType())])
    rows = _of_kind(spark.read.schema(stored).option("basePath", path).parquet(path), table)
    named = manifest.where(~F.col("marker")).select(F.col("day").alias("_day"), F.col("version").alias("_version"))
    same = F.col("version") == F.col("_version")
    if "click_day" in schema.fieldNames():
        same = same & F.col("click_day").eqNullSafe(F.col("_day"))
    kept = [*schema.fieldNames(), *[f.name for f in extra]]
    return rows.join(named, same, "left_semi").withColumnRenamed("version", "batch_id").select(*kept)


def read_merged_days(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    manifest: DataFrame,
    days: Sequence[object],
    extra: Sequence[T.StructField] = (),
) -> DataFrame | None:
    """The merged rows of some days: only these days' folders are listed and read. None where there are none."""
    path = merged_path(table)
    named = manifest.where(~F.col("marker") & F.col("day").isin(list(days))).collect()  # a row per day
    if not named:
        return None
    columns = [f for f in _stored_schema(table, schema).fields if f.name != "batch_id"]
    stored = T.StructType([*columns, *extra, T.StructField("version", T.LongType())])
    folders = [f"{path}/version={row['version']}/click_day={row['day']}" for row in named]
    rows = _of_kind(spark.read.schema(stored).option("basePath", path).parquet(*folders), table)
    return rows.withColumnRenamed("version", "batch_id").select(*schema.fieldNames(), *[f.name for f in extra])


def read_live(spark: SparkSession, table: str, schema: T.StructType, where: Column | None = None) -> DataFrame:
    """Rows of the batches' own folders; `where` may bound `batch_id` and the table's partition columns."""
    path = f"{table.rstrip('/')}/live"
    rows = spark.read.schema(_stored_schema(table, schema)).option("basePath", path).parquet(path)
    rows = _of_kind(rows, table) if where is None else _of_kind(rows, table).where(where)
    return rows.select(*schema.fieldNames())


def read_one_batch(spark: SparkSession, table: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """What batch `batch_id` wrote; no other folder is listed."""
    rows = spark.read.schema(_stored_schema(table, schema)).option("basePath", f"{table.rstrip('/')}/live")
    return _of_kind(rows.parquet(batch_path(table, batch_id)), table).select(*schema.fieldNames())


def read_batches(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """All rows of a per-batch table: merged ones, and those of the batches since."""
    through, manifest = current_manifest(spark, table)
    live = read_live(spark, table, schema)
    if manifest is None:
        return live
    return live.where(F.col("batch_id") > through).unionByName(read_merged(spark, table, schema, manifest))


def append_click_counts(counts: DataFrame, table: str, batch_id: int | None = None) -> None:
    """Store partial click counts per batch.

    With `batch_id`, replace that one partition; without it, `counts` must
    carry a `batch_id` column and each of its batches is replaced (dynamic
    partition overwrite). A batch's rows are gathered before the write, so files
    number about as the batches, and AQE splits a large batch over several tasks.
    """
    if batch_id is not None:
        replace_folder(counts.drop("batch_id"), f"{table.rstrip('/')}/batch_id={batch_id}")
        return
    (
        counts.hint("rebalance", "batch_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(table)
    )


def publish_blacklist(
    blacklist: DataFrame,
    *,
    path: str | None = None,
    batch_id: int | None = None,
    url: str | None = None,
    table: str = "blacklist",
    properties: dict[str, str] | None = None,
    retain: int = RETAINED_VERSIONS,
) -> None:
    """Publish a blacklist: as a new version at `path`, as batch `batch_id` of the per-batch table `path`, or over JDBC.

    A version is a folder of its own, `version=n`, and counts once its write has ended (`_SUCCESS`, written
    last): readers (`read_blacklist`) see the whole list before or the whole list after. The `retain` newest
    versions stay, so a reader keeps the files that it began with while that many replacements pass. One
    publisher at a time: a second one that takes the same number fails.
    """
    if url is not None:
        blacklist.write.mode("overwrite").jdbc(url, table, properties=properties or {})
        return
    if path is None:
        raise ValueError("give either path (Parquet) or url (JDBC)")
    if batch_id is not None:
        write_batch(blacklist, path, batch_id)
        return
    spark = blacklist.sparkSession
    before = numbered_folders(spark, path, "version")
    version = f"{path.rstrip('/')}/version={before[-1] + 1 if before else 0}"
    remove_folder(spark, version)  # what an attempt that died left: it was never read
    blacklist.write.mode("error").parquet(version)
    for old in before[: max(0, len(before) + 1 - retain)]:
        remove_folder(spark, f"{path.rstrip('/')}/version={old}")


def read_blacklist(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The newest published version at `path`; empty before the first one."""
    versions = numbered_folders(spark, path, "version")
    if not versions:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/version={versions[-1]}")


def archive_messages(
    messages: DataFrame,
    path: str | None = None,
    format: str = "text",
    *,
    url: str | None = None,
    table: str = "messages",
    properties: dict[str, str] | None = None,
) -> None:
    """Keep every raw message: as text files (`format="text"`) or appended to a one-column table.

    The table form appends to Parquet at `path`, or over JDBC when `url` is given.
    """
    body = messages.select("value")
    if format == "text":
        body.write.mode("append").text(path)
    elif format == "table":
        if url is not None:
            body.write.mode("append").jdbc(url, table, properties=properties or {})
        else:
            body.write.mode("append").parquet(path)
    else:
        raise ValueError(f"unknown format {format!r}; use text or table")


def register_views(spark: SparkSession, **frames: DataFrame) -> None:
    """Register DataFrames as temp views for SQL (`register_views(spark, clickcount=df)`)."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
