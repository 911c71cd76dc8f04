"""Operator 10: shards by a hierarchical weighted hash tree (DataFrame functions only).

A tree of regions, racks and shards; every shard has a weight, a rack or region the sum of those below. A key
descends it: at each level it goes to the child with the smallest draw -ln(u) / weight, u from a hash of (key,
child), so children are chosen in proportion to their weights; only the children of the nodes on its way are drawn,
not the other shards of the tree.

What a change moves: draws of nodes whose weight is unchanged stay as they are, so a key moves only where a node
on its old or new path changed its weight. A shard that is added in a node of its own (a new region, as the 41st
shard is here) changes no other weight: keys move into it alone. A shard added inside a rack makes that rack and its
region heavier: keys also move into that region from others, and within it into that rack, where they may land
on any of its shards; between subtrees of unchanged weight nothing moves.

The law is `key`: doc_id and the shards decide. Slots number a shard's rows from 0: distinct rows are numbered
within hash buckets of a shard, equal ones counted, and the buckets' sizes give the offsets, so no task holds a
whole shard, nor all of many equal rows.

A null doc_id is a key of its own. Rows that repeat a doc_id share its shard and
have slots of their own. Null texts have no bytes; their crc32 is that of the
empty text. Very long texts are measured whole; empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import pick, staged

SHARDS = 40
SHARDS_PER_RACK = 5
RACKS_PER_REGION = 2
ROW_BYTES = 16
ROWS_PER_BUCKET = 20_000
#: So many equal rows are written out by one task.
EQUALS_PER_TASK = 100_000


def hash_tree(weights: Sequence[float]) -> list[list[list[tuple[int, float]]]]:
    """Regions of racks of (shard, weight), filled in order of shard number."""
    racks: list[list[tuple[int, float]]] = []
    for shard, weight in enumerate(weights):
        if shard % SHARDS_PER_RACK == 0:
            racks.append([])
        racks[-1].append((shard, float(weight)))
    return [racks[at : at + RACKS_PER_REGION] for at in range(0, len(racks), RACKS_PER_REGION)]


def tree_shard(key: Column, weights: Sequence[float]) -> Column:
    """The shard that `key` descends to in the tree of `weights` (0 keeps a shard empty)."""

    def node(name: str, weight: float, below: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(weight).alias("weight"), below.alias("below"))

    def weight_of(shards: list[tuple[int, float]]) -> float:
        return sum(w for _, w in shards)

    regions, number = [], 0
    for at, racks in enumerate(hash_tree(weights)):
        held = []
        for rack in racks:
            shards = F.array(*[node(f"shard {s}", w, F.lit(s)) for s, w in rack if w > 0])
            if weight_of(rack) > 0:
                held.append(node(f"rack {number}", weight_of(rack), shards))
            number += 1
        if held:
            regions.append(node(f"region {at}", sum(weight_of(rack) for rack in racks), F.array(*held)))

    def chosen(children: Column) -> Column:
        def draw(child: Column) -> Column:
            u = (F.shiftrightunsigned(F.xxhash64(key, child["name"]), 11).cast("double") + 0.5) / float(1 << 53)
            return F.struct((-F.log(u) / child["weight"]).alias("draw"), child["name"], child["below"].alias("below"))

        return F.array_min(F.transform(children, draw))["below"]

    return chosen(chosen(chosen(F.array(*regions))))


def sharded(docs: DataFrame, weights: Sequence[float] = (1.0,) * SHARDS, grown: Sequence[float] | None = None) -> DataFrame:
    """`doc_id`, `size`, `text_crc32`, `law`, `shard`, `slot`, `grown_shard` for every row of `docs` (`doc_id`, `text`).

    `grown` are the weights after a change; by default one more shard of weight 1.
    """
    grown = [*weights, 1.0] if grown is None else grown
    text = F.coalesce("text", F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = pick(docs, "doc_id", "text").select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        tree_shard(key, weights).alias("shard"),
        tree_shard(key, grown).alias("grown_shard"),
    )
    rows = staged(rows, "shard_rows")
    buckets = max(1, rows.count() // (ROWS_PER_BUCKET * len(weights)) + 1)
    # Bucket numbers are in the order of nothing: they only cut a shard into pieces of bounded size.
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.lit(3)), F.lit(buckets)))
    # Equal rows are one row with their number from here on: however many there are, no task sorts them.
    rows = rows.groupBy("shard", "bucket", "doc_id", "text_crc32", "size", "grown_shard").agg(F.count("*").alias("n"))
    rows = staged(rows, "shard_distinct")
    counts = rows.groupBy("shard", "bucket").agg(F.sum("n").alias("n"))
    unbounded = Window.unboundedPreceding
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(unbounded, -1)
    zero = F.lit(0).cast("long")
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), zero).alias("before"))
    place = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size").rowsBetween(unbounded, -1)
    placed = rows.withColumn("place", F.coalesce(F.sum("n").over(place), zero)).join(offsets, ["shard", "bucket"])
    many = rows.agg(F.max("n")).first()[0] or 0
    # Written out in pieces: beyond `EQUALS_PER_TASK` equal rows, other tasks take the rest.
    pieces = placed.withColumn("piece", F.explode(F.sequence(zero, F.expr(f"(n - 1) div {EQUALS_PER_TASK}"))))
    if many > EQUALS_PER_TASK:
        pieces = pieces.repartition("shard", "bucket", "doc_id", "piece")
    first = F.col("piece") * EQUALS_PER_TASK
    last = F.least(F.col("n"), first + EQUALS_PER_TASK) - 1
    return pieces.withColumn("equal", F.explode(F.sequence(first, last))).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("before") + F.col("place") + F.col("equal")).alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"),
    )
