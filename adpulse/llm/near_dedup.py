"""Operator 6: near duplicates by min-max hashing, confirmed on whole shingle sets.

Every permutation `h -> a*h + b (mod 2**64)` of a document's shingle hashes keeps
its minimum and its maximum, so n evaluations give 2 * n signature values. Bands
of 6 values (3 permutations) put documents into buckets. There are as many bands as
it takes that a pair at the threshold shares no bucket with probability below
`MISSED`: (1 - 0.85**6)**30 or (1 - 0.8**6)**46. Documents that share a bucket,
directly or through others, form a cluster, and within a cluster links are
confirmed on whole sets:

* documents with the same set are one node (copies are never expanded);
* a cluster is cut into chunks of bounded rows and shingles; first every chunk
  meets the cluster's chunk 0, then only documents outside the cluster's largest
  component so far meet all chunks. Any pair of different components has then
  been compared, so no link that could join components is lost;
* a chunk pair yields a spanning forest of its links, never all pairs.

Null or word-less texts have an empty set and link with nothing. Rows with a null
doc_id link with nothing, have a null component and are kept. Rows that repeat a
doc_id are one node: rows of different texts get the smallest component that any of
them reaches (a row without words keeps its own id). Very long texts are read whole, their
words block by block. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import (
    U64,
    as_long,
    connected_components,
    discard,
    files_for,
    mix,
    pick,
    runs,
    scrambled,
    shingle_set,
    small_batches,
    spanning_links,
    staged,
)

WORDS = 5
PERCENT = 85
MISSED = 1e-6
PER_BAND = 3
CHUNK_ROWS = 256
CHUNK_SHINGLES = 1_000_000
_BAND_FACTORS = scrambled(2 * PER_BAND, 13) | U64(1)


def n_bands(percent: int) -> int:
    """The fewest bands that miss a pair at the threshold with probability below MISSED."""
    same = (percent / 100) ** (2 * PER_BAND)
    return math.ceil(math.log(MISSED) / math.log1p(-same)) if same < 1 else 1


def min_max(shingles: np.ndarray, permutations: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimum and maximum of the set under every permutation."""
    factors, shifts = scrambled(permutations, 11) | U64(1), scrambled(permutations, 12)
    low = np.full(permutations, np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(permutations, np.uint64)
    for at in range(0, len(shingles), 1024):
        values = shingles[at : at + 1024, None] * factors + shifts
        np.minimum(low, values.min(axis=0), out=low)
        np.maximum(high, values.max(axis=0), out=high)
    return low, high


def band_keys(shingles: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band over the minima and maxima of its permutations."""
    low, high = min_max(shingles, bands * PER_BAND)
    values = np.concatenate([low.reshape(bands, PER_BAND), high.reshape(bands, PER_BAND)], axis=1)
    return mix((values * _BAND_FACTORS).sum(axis=1, dtype=np.uint64))


def _signatures(n: int):
    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, first, second, bands = [], [], [], []
            for data in batch.column("text").cast(pa.binary()).to_pylist():
                shingles = shingle_set(data or b"", WORDS)
                counts.append(len(shingles))
                if len(shingles):
                    first.append(as_long(mix(shingles).sum(keepdims=True))[0])
                    second.append(as_long(np.bitwise_xor.reduce(mix(shingles ^ U64(0x5851F42D4C957F2D)), keepdims=True))[0])
                    bands.append(as_long(band_keys(shingles, n)))
                else:
                    first.append(None)
                    second.append(None)
                    bands.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    return signatures


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix of 100 * intersection >= percent * union over all pairs of the (non-empty) sets."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), sizes)
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], column[shared]
    number = np.cumsum(count > 1) - 1
    column = number[column]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), np.float64)
    width = max(512, min(8192, (1 << 21) // n))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        block = np.zeros((n, width), np.float32)
        block[owner[a:b], column[a:b] - low] = 1
        common += block @ block.T
    common = common.astype(np.int64)
    np.fill_diagonal(common, sizes)
    return 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["cluster", "part_a", "part_b"]):
            ids = np.array(table.column("node").to_pylist(), np.int64)
            sets = [shingle_set(data or b"", WORDS) for data in table.column("text").cast(pa.binary()).to_pylist()]
            some = [at for at, s in enumerate(sets) if len(s)]
            if len(some) < 2:
                continue
            left, right = spanning_links(linked([sets[at] for at in some], percent))
            ids = ids[some]
            if len(left):
                yield pa.RecordBatch.from_arrays([pa.array(ids[left]), pa.array(ids[right])], names=["a", "b"])

    return confirm


def _confirmed(tasks: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links within each (cluster, part_a, part_b) of `tasks`, written."""
    # Written first: where they are few, Spark broadcasts them and moves only the texts that are compared.
    tasks = staged(tasks, "near_tasks")
    rows = tasks.join(texts, "node").select("cluster", "part_a", "part_b", "node", "text")
    dealt = rows.repartition("cluster", "part_a", "part_b").sortWithinPartitions("cluster", "part_a", "part_b")
    return dealt.mapInArrow(_confirm(percent), "a long, b long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id`, `kept` for every row of `docs` (`doc_id`, `text`).

    Documents link at `percent` of Jaccard similarity and above.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = staged(
        docs.mapInArrow(
            _signatures(n_bands(percent)), "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"
        ),
        "near_signatures",
    )
    full = signed.filter("doc_id IS NOT NULL AND n_shingles > 0")
    sets = full.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min("doc_id").alias("node"), F.min_by("bands", "doc_id").alias("bands")
    )
    sets = staged(sets, "near_sets")
    rows = signed.drop("bands")

    # Buckets: every member points to the smallest node of its bucket.
    members = sets.select("node", F.posexplode("bands").alias("band", "key"))
    lowest = members.groupBy("band", "key").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    lowest = lowest.filter("low < high")
    pairs = members.join(lowest, ["band", "key"]).filter("node <> low").select(
        F.col("node").alias("a"), F.col("low").alias("b")
    )
    clusters = connected_components(pairs, "near_clusters")

    # One row per candidate node, with the chunk of its cluster.
    roots = clusters.select("component").distinct().select(F.col("component").alias("node"), "component")
    sizes = sets.groupBy("node").agg(F.max("n_shingles").alias("n"))
    nodes = clusters.unionAll(roots).select("node", F.col("component").alias("cluster")).join(sizes, "node")
    # Figures of a cluster are written before they are joined to its nodes: then AQE can split a hot cluster.
    chunks = nodes.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / CHUNK_ROWS), F.ceil(F.sum("n") / CHUNK_SHINGLES)).alias("chunks")
    )
    chunks = staged(chunks, "near_chunks")
    nodes = staged(
        nodes.join(chunks, "cluster").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks"))),
        "near_nodes",
    )
    discard(clusters, chunks)
    texts = docs.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias("node"), "text")

    # Every chunk with chunk 0 of its cluster (a cluster of one chunk with itself).
    other = F.when(F.col("chunk") == 0, F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).otherwise(
        F.array("chunk")
    )
    zero = F.lit(0).cast("long")
    tasks = nodes.select("cluster", zero.alias("part_a"), F.explode(other).alias("part_b"), "node")
    links = staged(_confirmed(tasks, texts, percent), "near_links")

    # Larger clusters: what lies outside the largest component so far meets every chunk.
    large = nodes.filter("chunks > 1")
    if not large.isEmpty():
        parts = connected_components(links, "near_parts")
        found = large.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
        weights = found.groupBy("cluster", "part").agg(F.count("*").alias("n"))
        few = files_for(nodes.count())
        main = weights.groupBy("cluster").agg(F.max(F.struct("n", "part")).alias("main"))
        main = staged(main.coalesce(few), "near_main")
        rest = found.join(main, "cluster").filter("part <> main.part").select("cluster", "node", "chunks")
        rest = staged(rest.coalesce(few), "near_rest")
        deals = rest.groupBy("cluster").agg(F.ceil(F.count("*") / CHUNK_ROWS).alias("deals"))
        deals = staged(deals.coalesce(few), "near_deals")
        rest_rows = (
            rest.join(deals, "cluster")
            .withColumn("part_a", F.pmod(F.xxhash64("node", F.lit(1)), F.col("deals")))
            .select("cluster", "part_a", F.explode(F.sequence(zero, F.col("chunks") - 1)).alias("part_b"), "node")
        )
        all_rows = large.join(deals, "cluster").select(
            "cluster", F.explode(F.sequence(zero, F.col("deals") - 1)).alias("part_a"), F.col("chunk").alias("part_b"), "node"
        )
        more = staged(_confirmed(rest_rows.unionAll(all_rows).distinct(), texts, percent), "near_more")
        discard(parts, main, rest, deals)
        links = links.unionAll(more)

    # A doc_id over rows with different sets is one node: it ties their sets' nodes together.
    with_set = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    a_set = F.struct("set_a", "set_b", "n_shingles")
    several = with_set.groupBy("doc_id").agg(F.min(a_set).alias("low"), F.max(a_set).alias("high")).filter("low <> high")
    several = staged(several.select("doc_id"), "near_several")
    ties = links
    if not several.isEmpty():
        tied = with_set.join(several, "doc_id").join(sets, ["set_a", "set_b", "n_shingles"])
        ties = links.unionAll(tied.select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    groups = connected_components(ties, "near_groups")
    discard(nodes, links, several)
    named = sets.join(groups, "node", "left")
    named = named.select("set_a", "set_b", "n_shingles", F.coalesce("component", "node").alias("component_id"))
    joined = rows.join(named, ["set_a", "set_b", "n_shingles"], "left")
    component = F.coalesce("component_id", "doc_id")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
