"""Shared pieces of the `llm` operators: column picking, staged tables, key runs, components, word hashes."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.session import fresh_dir

#: Rows of one Arrow batch handed to Python: texts can be long, so batches stay small.
ARROW_ROWS = 256
FOLDS = 5
#: Rows of two or three numbers in one file of an intermediate table, and the fewest files of one.
ROWS_PER_FILE, FEWEST_FILES = 200_000, 8


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python once per application, however the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="adpulse-code-")) / f"{root.name}_code.zip"
    with zipfile.ZipFile(path, "w") as code:
        for source in sorted(root.rglob("*.py")):
            code.write(source, source.relative_to(root.parent))
    sc.addPyFile(str(path))  # Spark serves it to every executor
    _shipped.add(sc.applicationId)


def small_batches(spark: SparkSession) -> None:
    """Make the session ready for Python stages: the code is sent along, and rows come in small Arrow batches.

    Small, so that long texts stay within a worker's memory.
    """
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def pick(df: DataFrame, *names: str, **renamed: str) -> DataFrame:
    """The named columns by exact name, whatever else `df` holds.

    Spark resolves names without regard to case, so an extra column `TEXT` beside
    `text` would make the plain reference ambiguous; here the column is found by
    position. `new=old` renames.
    """
    where = {name: at for at, name in reversed(list(enumerate(df.columns)))}
    plain = df.toDF(*[f"c{at}" for at in range(len(df.columns))])
    wanted = {**{name: name for name in names}, **renamed}
    return plain.select(*[F.col(f"c{where[old]}").alias(new) for new, old in wanted.items()])


#: Tables staged by this application and not yet removed: folder name -> (path, catalog table if it has one).
_staged: dict[str, tuple[str, str | None]] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a write are removed once it is done."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """`df` written to a new folder of the shared storage and read again: cuts the lineage, survives executors."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    _staged[path.rsplit("/", 1)[1]] = path, None
    with _shuffles_removed(spark):
        df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def staged_in_buckets(df: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
    """Like `staged`, as a table bucketed and sorted by `keys`: joins on them need no shuffle of it."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    folder = path.rsplit("/", 1)[1]
    table = folder.replace("-", "_")
    _staged[folder] = path, table
    with _shuffles_removed(spark):
        writer = df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).option("compression", "zstd")
        writer.saveAsTable(table)
    return spark.table(table)


def staged_folders() -> set[str]:
    """Names of the staged folders that are still there."""
    return set(_staged)


def folders_of(*frames: DataFrame) -> set[str]:
    """Names of the staged folders that `frames` read."""
    return {file.rsplit("/", 2)[1] for frame in frames for file in frame.inputFiles()} & set(_staged)


def remove_staged(spark: SparkSession, folders: Iterable[str]) -> None:
    """Delete staged tables. Whoever calls knows that what was made from them is written: nothing reads them again."""
    for folder in folders:
        path, table = _staged.pop(folder)
        if table is not None:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard(*frames: DataFrame) -> None:
    """Delete the staged tables that `frames` read, once what was made from them is staged itself."""
    if frames:
        remove_staged(frames[0].sparkSession, folders_of(*frames))


def fold(doc_id) -> "F.Column":
    """`crc32(doc_id as text) mod 5`; 0 marks the held-out documents. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by `keys`; only one key's rows are held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True))
        start = 0
        for at, value in enumerate(values):
            if value != last:
                if at > start:
                    held.append(batch.slice(start, at - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], at, value
        if start < len(values):
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def connected_components(edges: DataFrame, name: str) -> DataFrame:
    """`node`, `component` (the smallest node reachable) for every node that is not its own component's smallest.

    `edges` has longs `a`, `b`. Alternating large-star and small-star rounds: every
    round joins the edges with each node's smallest neighbour, and is written to
    the shared folder; the number of rounds grows with the logarithm of the
    longest chain. Minima are pre-aggregated and written before they are joined, so
    that each join has a shuffle on both sides and AQE can split a hot node's rows.
    Edges that are stars already need no further round. A round writes as many files as
    its edges need, not one per shuffle partition.
    """
    now = staged(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), name
    )
    while not _are_stars(now):
        parts = files_for(now.count())
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(
            now.select(F.col("v").alias("x"), F.col("u").alias("y"))
        )
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        least = staged(least.coalesce(parts), f"{name}_least")
        # Equal edges may come several times here, never more than there were before; the round's end removes them.
        large = both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v"))
        large = staged(large.coalesce(parts), f"{name}_large")
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts), f"{name}_low")
        moved = large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()
        last, now = now, staged(edges.coalesce(parts), name)
        discard(last, least, large, low)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def files_for(n_rows: int) -> int:
    """How many files a written table of so many narrow rows gets; never one for all."""
    return max(FEWEST_FILES, n_rows // ROWS_PER_FILE)


def _are_stars(edges: DataFrame) -> bool:
    """Whether every `u` has one `v`, and no `v` is a `u`: then each `v` is the smallest node of its component."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    per_node = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per_node.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty()


def spanning_links(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs that join what the symmetric boolean matrix joins, one fewer than the rows at most."""
    left, right = [], []
    unseen = np.ones(len(linked), bool)
    for first in range(len(linked)):
        if not unseen[first]:
            continue
        unseen[first] = False
        todo = [first]
        while todo:
            at = todo.pop()
            found = np.flatnonzero(linked[at] & unseen)
            unseen[found] = False
            todo.extend(found.tolist())
            left.extend([at] * len(found))
            right.extend(found.tolist())
    return np.array(left, dtype=np.int64), np.array(right, dtype=np.int64)


# --- word and shingle hashes -------------------------------------------------------------------

U64 = np.uint64
_STEP = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def scrambled(n: int, salt: int) -> np.ndarray:
    """`n` fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + U64(salt * 1_000_003)) * _STEP)


BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(BASE, -1, 1 << 64)
_powers = {1: np.ones(1, np.uint64), -1: np.ones(1, np.uint64)}


def powers(n: int, sign: int = 1) -> np.ndarray:
    """The first `n` powers of BASE (or of its inverse) modulo 2**64, kept between calls."""
    have = _powers[sign]
    while len(have) < n:
        step = pow(BASE if sign > 0 else _INVERSE, len(have), 1 << 64)
        have = np.concatenate([have, have * U64(step)])
    _powers[sign] = have
    return have[:n]


BYTE_VALUES = scrambled(256, 1)
_LOWER = BYTE_VALUES.copy()
_LOWER[65:91] = BYTE_VALUES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
BLOCK = 1 << 20


def word_hashes(data: bytes) -> np.ndarray:
    """One 64-bit hash per word `[^\\x20\\x09-\\x0D]+` of the text, A-Z lower-cased; block by block."""
    out, at = [], 0
    whole = np.frombuffer(data, np.uint8)
    while at < len(whole):
        end = min(len(whole), at + BLOCK)
        while end < len(whole) and not _SPACE[whole[end]]:
            end += 1
        part = whole[at:end]
        space = _SPACE[part]
        edge = np.diff(np.concatenate([[True], space, [True]]).view(np.int8))
        start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if len(start):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_LOWER[part] * powers(len(part)))])
            out.append(mix((sums[stop] - sums[start]) * powers(len(part), -1)[start]))
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_set(data: bytes, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the word `words`-grams; the whole sequence if it is shorter; empty without words."""
    hashes = word_hashes(data)
    n = min(words, len(hashes))
    if not n:
        return hashes
    total = np.full(len(hashes) - n + 1, n, np.uint64) * _STEP
    for k, factor in enumerate(scrambled(n, 2) | U64(1)):
        total += hashes[k : len(hashes) - n + 1 + k] * factor
    return np.unique(mix(total))


def as_long(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)
