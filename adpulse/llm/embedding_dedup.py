"""Operator 9: near-duplicate embeddings by an epsilon grid order join.

Valid vectors are scaled to length 1 and turned onto the principal directions of
all vectors (any rotation keeps distances). `cosine >= c` is a distance of at most
`eps = sqrt(2 - 2c)`. Per label, vectors are sorted by the grid cells (of side eps)
of their leading principal coordinates and cut into intervals of the sequence,
`BLOCK` rows each. Interval pairs are found by descending a tree over the
intervals: a pair of nodes is followed only where their boxes are no farther apart
than eps. Each surviving pair of blocks halves its intervals recursively in one
task, again skipping provably distant ones, and compares the rest exactly.

Equal vectors of a label are one node with a multiplicity, and a block pair yields
each vector's number of links and a spanning forest, never all its links. A block
is one row, so memory per task is a few blocks.

Vectors that are null, zero, or hold null or non-finite components, and rows whose
label is null, link with nothing. Vectors of different lengths never link. Rows
with a null vec_id link with nothing and are kept; rows that repeat a vec_id are vectors
of their own.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import connected_components, pick, small_batches, spanning_links, staged

COSINE = 0.98
GRID_DIMS = 6
BOX_DIMS = 16
BLOCK = 512
LEAF = 64
FANOUT = 8
#: Box distances come from rounded coordinates.
SLACK = 1e-6


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of products of the unit vectors of a partition: one row per dimension."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        by_size: dict[int, list] = {}
        for vector in batch.column("vector").to_pylist():
            by_size.setdefault(len(vector), []).append(vector)
        for size, vectors in by_size.items():
            x = np.array(vectors)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            sums[size] = sums.get(size, 0) + x.T @ x
    for size, total in sums.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([size] * size, pa.int32()),
                pa.array(range(size), pa.int32()),
                pa.array(total.tolist(), pa.list_(pa.float64())),
            ],
            names=["size", "row", "sums"],
        )


def principal_directions(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The rotation onto principal directions, by vector length; summed over all vectors in Spark."""
    sums = (
        vectors.mapInArrow(_moments, "size int, row int, sums array<double>")
        .select("size", "row", F.posexplode("sums").alias("column", "value"))
        .groupBy("size", "row", "column")
        .agg(F.sum("value").alias("value"))
        .groupBy("size", "row")
        .agg(F.sort_array(F.collect_list(F.struct("column", "value"))).alias("values"))
    )
    found: dict[int, dict[int, list]] = {}
    for size, row, values in sums.toLocalIterator():  # dimensions x dimensions numbers, however many vectors
        found.setdefault(size, {})[row] = [x["value"] for x in values]
    turns = {}
    for size, rows in found.items():
        _, turn = np.linalg.eigh(np.array([rows[k] for k in range(size)]))
        turns[size] = turn[:, ::-1]
    return turns


def _grid(turns: dict[int, np.ndarray], eps: float):
    def grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for vector in batch.column("vector").to_pylist():
                x = np.array(vector)
                y = (x / np.linalg.norm(x)) @ turns[len(x)][:, :GRID_DIMS]
                cells.append(np.floor(y / eps).astype(int).tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cell"]
            )

    return grid


def _blocks(turns: dict[int, np.ndarray]):
    """Cuts rows sorted by (label, size, cell) into blocks: one row each, with its box."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def block() -> pa.RecordBatch:
            x = np.array([r["vector"] for r in held])
            y = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ turns[x.shape[1]][:, :BOX_DIMS]
            row = {
                "label": key[0],
                "size": key[1],
                "first": held[0]["node"],
                "cell": held[0]["cell"],
                "nodes": [r["node"] for r in held],
                "times": [r["times"] for r in held],
                "vectors": x.astype(np.float64).tobytes(),
                "low": y.min(axis=0).tolist(),
                "high": y.max(axis=0).tolist(),
            }
            return pa.RecordBatch.from_pylist([row], schema=BLOCK_ARROW)

        for batch in batches:
            for r in batch.to_pylist():
                now = (r["label"], r["size"])
                if held and (now != key or len(held) == BLOCK):
                    yield block()
                    held = []
                key = now
                held.append(r)
        if held:
            yield block()

    return cut


BLOCK_ARROW = pa.schema(
    [
        ("label", pa.string()), ("size", pa.int32()), ("first", pa.int64()), ("cell", pa.list_(pa.int32())),
        ("nodes", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())), ("vectors", pa.binary()),
        ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
    ]
)
BLOCK_DDL = (
    "label string, size int, first long, cell array<int>, nodes array<long>, times array<long>, vectors binary,"
    " low array<double>, high array<double>"
)


def near_pairs(x: np.ndarray, y: np.ndarray, turn: np.ndarray, cosine: float, same: bool) -> np.ndarray:
    """Boolean matrix of cosine >= `cosine` between the rows of x and y: intervals are halved, distant ones skipped."""
    eps = math.sqrt(max(0.0, 2 - 2 * cosine)) + SLACK
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    y = y / np.linalg.norm(y, axis=1, keepdims=True)
    p, q = x @ turn[:, :BOX_DIMS], y @ turn[:, :BOX_DIMS]
    found = np.zeros((len(x), len(y)), bool)
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        if same and d <= a:
            continue
        gap = np.maximum(0, np.maximum(q[c:d].min(0) - p[a:b].max(0), p[a:b].min(0) - q[c:d].max(0)))
        if gap @ gap > eps * eps:
            continue
        if max(b - a, d - c) <= LEAF:
            found[a:b, c:d] = x[a:b] @ y[c:d].T >= cosine
        elif b - a >= d - c:
            m = (a + b) // 2
            todo += [(a, m, c, d), (m, b, c, d)]
        else:
            m = (c + d) // 2
            todo += [(a, b, c, m), (a, b, m, d)]
    return found | found.T if same else found


def _compare(turns: dict[int, np.ndarray], cosine: float):
    """Block pairs to rows (node, other, links): links of a node, or a spanning link to another node."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                nodes, times = np.array(row["nodes"]), np.array(row["times"])
                size, same = row["size"], row["a"] == row["b"]
                x = np.frombuffer(row["vectors"]).reshape(-1, size)
                if same:
                    hit = near_pairs(x, x, turns[size], cosine, True)
                    np.fill_diagonal(hit, False)
                    links = hit @ times
                    left, right = spanning_links(hit)
                    all_nodes = nodes
                else:
                    more, more_times = np.array(row["nodes_b"]), np.array(row["times_b"])
                    y = np.frombuffer(row["vectors_b"]).reshape(-1, size)
                    hit = near_pairs(x, y, turns[size], cosine, False)
                    links = np.concatenate([hit @ more_times, hit.T @ times])
                    some = np.flatnonzero(np.concatenate([hit.any(1), hit.any(0)]))
                    both = np.zeros((len(some), len(some)), bool)
                    n, cut = len(x), np.searchsorted(some, len(x))
                    both[:cut, cut:] = hit[np.ix_(some[:cut], some[cut:] - n)]
                    left, right = spanning_links(both | both.T)
                    left, right = some[left], some[right]
                    all_nodes = np.concatenate([nodes, more])
                counted = np.flatnonzero(links)
                if len(counted):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate([all_nodes[counted], all_nodes[left]])),
                            pa.array([None] * len(counted) + all_nodes[right].tolist(), pa.int64()),
                            pa.array(links[counted].tolist() + [0] * len(left), pa.int64()),
                        ],
                        names=["node", "other", "links"],
                    )

    return compare


def _gap_within(eps: float):
    return (
        "aggregate(zip_with(zip_with(a_low, b_high, (x, y) -> x - y), zip_with(b_low, a_high, (x, y) -> x - y),"
        " (x, y) -> greatest(x, y, 0D)), 0D, (s, x) -> s + x * x)"
        f" <= {(eps + SLACK) ** 2!r}D"
    )


def _block_pairs(boxes: DataFrame, eps: float, n_blocks: int) -> DataFrame:
    """(a, b), a <= b, of blocks of one label and length whose boxes come within eps; found by descending a tree.

    `boxes` has `block` (numbered along the grid order), `label`, `size`, `low`, `high`.
    """
    levels = max(1, math.ceil(math.log(max(n_blocks, 2), FANOUT)))

    def level(k: int) -> DataFrame:
        """Boxes of the tree nodes `FANOUT ** k` blocks wide."""
        if k == 0:
            return boxes.select(F.col("block").alias("at"), "label", "size", "low", "high")
        node = F.floor(F.col("block") / FANOUT**k).alias("at")
        wide = boxes.select(node, "label", "size", F.posexplode(F.arrays_zip("low", "high")).alias("dim", "side"))
        sides = wide.groupBy("at", "label", "size", "dim").agg(
            F.min("side.low").alias("low"), F.max("side.high").alias("high")
        )
        return sides.groupBy("at", "label", "size").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("dim", "low"))), lambda x: x["low"]).alias("low"),
            F.transform(F.sort_array(F.collect_list(F.struct("dim", "high"))), lambda x: x["high"]).alias("high"),
        )

    root = F.lit(0).cast("long")  # FANOUT ** levels blocks wide: all of them
    pairs = boxes.select("label", "size").distinct().select("label", "size", root.alias("a"), root.alias("b"))
    for k in range(levels - 1, -1, -1):
        boxes_k = level(k)
        child = lambda side: F.explode(F.transform(F.sequence(F.lit(0), F.lit(FANOUT - 1)), lambda i: F.col(side) * FANOUT + i))
        step = pairs.select("label", "size", child("a").alias("a"), "b").select(
            "label", "size", "a", child("b").alias("b")
        )
        step = step.filter("a <= b")
        left = boxes_k.select("label", "size", F.col("at").alias("a"), F.col("low").alias("a_low"), F.col("high").alias("a_high"))
        right = boxes_k.select("label", "size", F.col("at").alias("b"), F.col("low").alias("b_low"), F.col("high").alias("b_high"))
        step = step.join(left, ["label", "size", "a"]).join(right, ["label", "size", "b"])
        pairs = staged(step.filter(_gap_within(eps)).select("label", "size", "a", "b"), f"embedding_pairs{k}")
    return pairs


def near_embeddings(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """`vec_id`, `n_links`, `component_id`, `kept` for every row of `embeddings` (`vec_id`, `embedding`, `label`)."""
    spark = embeddings.sparkSession
    small_batches(spark)
    eps = math.sqrt(max(0.0, 2 - 2 * cosine))
    rows = pick(embeddings, "vec_id", "embedding", "label")
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
        F.col("label").cast("string").alias("label"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("vector", lambda x: x != 0.0)
    # -0.0 and 0.0 are one value; a power of two as scale keeps every bit and stays clear of overflow and underflow.
    top = F.array_max(F.transform("vector", F.abs))
    scale = F.pow(F.lit(2.0), -F.floor(F.log2(top)))
    valid = (
        rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull())
        .filter(finite & some)
        .withColumn("vector", F.transform("vector", lambda x: x * scale + 0.0))
    )
    classes = valid.groupBy("label", "vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("times"))
    classes = staged(
        classes.withColumn("size", F.size("vector")).withColumn("node", F.monotonically_increasing_id()),
        "embedding_classes",
    )
    turns = principal_directions(classes)
    grid = classes.select("label", "size", "node", "times", "vector").mapInArrow(
        _grid(turns, eps),
        "label string, size int, node long, times long, vector array<double>, cell array<int>",
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = grid.repartitionByRange(parts, "label", "size", "cell", "node").sortWithinPartitions(
        "label", "size", "cell", "node"
    )
    blocks = staged(ordered.mapInArrow(_blocks(turns), BLOCK_DDL), "embedding_blocks")
    # Numbers along the grid order: one small row per block.
    n_blocks = blocks.count()
    numbered = blocks.select("label", "size", "cell", "first", "low", "high")
    numbered = staged(_numbered(numbered, ["label", "size", "cell", "first"], "block"), "embedding_boxes")
    pairs = _block_pairs(numbered.select("block", "label", "size", "low", "high"), eps, n_blocks)

    named = blocks.join(numbered.select("label", "size", "first", "block"), ["label", "size", "first"])
    payload = named.select("block", "size", "nodes", "times", "vectors")
    left = payload.withColumnRenamed("block", "a")
    right = payload.select(
        F.col("block").alias("b"), F.col("nodes").alias("nodes_b"), F.col("times").alias("times_b"),
        F.col("vectors").alias("vectors_b"),
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    compared = (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .mapInArrow(_compare(turns, cosine), "node long, other long, links long")
    )
    compared = staged(compared, "embedding_links")
    small_batches(spark)
    groups = connected_components(
        compared.filter("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")),
        "embedding_groups",
    )
    counts = compared.groupBy("node").agg(F.sum("links").alias("links"))
    found = (
        classes.join(counts, "node", "left")
        .join(groups, "node", "left")
        .select(
            "label", "vector", "least",
            (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("root"),
        )
    )
    smallest = found.groupBy("root").agg(F.min("least").alias("component"))
    found = found.join(smallest, "root")
    key = F.struct("label", "vector")
    by_vector = found.select(F.xxhash64(key).alias("h1"), F.hash(key).alias("h2"), "label", "n_links", "component")
    keyed = valid.select("vec_id", F.xxhash64(key).alias("h1"), F.hash(key).alias("h2"), "label")
    linked = keyed.join(by_vector, ["h1", "h2", "label"]).select("vec_id", "n_links", "component")
    rest = rows.select("vec_id", "label", "vector").filter(
        ~(
            F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
            & F.coalesce(finite & some, F.lit(False))
        )
    )
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component"))
    return linked.unionAll(alone).select(
        "vec_id",
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def _numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """`df` numbered from 0 along `order`: numbers within ranges, plus the rows of the ranges before."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()),
        "numbered",
    )
    inner = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    before = ranged.groupBy("part").agg(F.count("*").alias("n"))
    before = before.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )  # one row per range
    return ranged.withColumn("inner", inner).join(before, "part").withColumn(
        name, F.col("inner") + F.col("before")
    ).drop("part", "inner", "before")
