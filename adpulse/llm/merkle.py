"""Operator 12: Merkle manifest of a dataset, with octopus multiproofs.

Every row is a leaf: the sha256 of its fields, each `-` if null, else its UTF-8 byte count, `:`, its value.
The leaves of a source, ascending by doc_id, form a tree: every three consecutive nodes (the last run of a
level may be shorter, even one) become the hash of their hex digests, until one remains. The subroots,
ordered by source (null first, then bytewise), form the top tree the same way, whose root stands for the
dataset.

Building. Leaves are sorted by range partitions and numbered by the partitions' counts, so no task sees a
whole source; a hot source is cut into chunks of 3**`CHUNK_LEVELS` leaves, each reduced in one pass, and the
next pass starts from the chunks' tops. The manifest is two tables: `leaves`, and `nodes` by (tree, level, at).

Proving (octopus multiproof). The leaves to prove are taken in partitions of one chunk each. From their
coordinates alone a partition computes the minimal union of the coordinates it misses: what lies in a run
with something it has or derives, and is neither had nor derived. All partitions' coordinates meet the
manifest in one join; then each partition derives the shared interior nodes once, up to the root, and expands
every leaf's own proof from them: the siblings of its run, level by level, through the subroot to the root.

A row whose doc_id is null sorts first in its source and is never tampered with; rows that repeat a doc_id
are ordered by their digests, equal rows are interchangeable. Empty and very long texts are hashed whole, by
Spark. An empty table has no leaves, no root and no proofs. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import pick, runs, small_batches, staged

ARITY = 3
CHUNK_LEVELS = 7
#: Names of trees: `n` is the null source, `s...` a source, `t` the tree of subroots; bytewise order is the sources' order.
TOP_TREE = "t"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Digest of a row: every field as `-` or `<bytes>:<value>`, in the order of `FIELDS`."""

    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[written(fields[name]) for name in FIELDS]).cast("binary"), 256)


def level_size(size: int, level: int) -> int:
    """Nodes of a tree of `size` leaves at `level`: run after run of three, the last one maybe shorter."""
    for _ in range(level):
        size = -(-size // ARITY)
    return size


def depth(size: int) -> int:
    """Levels above the leaves: 0 for a lone leaf."""
    levels = 0
    while size > 1:
        size, levels = -(-size // ARITY), levels + 1
    return levels


def _placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """`rows` (with `tree`) and their place in their tree by `order`, as `place`, and the tree's `size`.

    Partitions by range, so a tree of any size is sorted by many tasks; rows equal in `order` are told apart by
    where they were read, so that many repeated rows do not meet in one.
    """
    salted = rows.withColumn("salt", F.monotonically_increasing_id())
    in_order = salted.repartitionByRange("tree", *order, "salt").sortWithinPartitions("tree", *order, "salt")
    numbered = in_order.drop("salt").withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id())
    numbered = staged(numbered, name)
    # One row per partition and tree in it.
    counts = numbered.groupBy("tree", "part").agg(F.min("seq").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(Window.partitionBy("tree")).alias("size"),
    )
    joined = numbered.join(starts, ["tree", "part"])
    return joined.select(*rows.columns, (F.col("seq") + F.col("shift")).alias("place"), "size")


NODE_DDL = "tree string, level int, at long, digest string, size long"


def _reduced(chunk_levels: int):
    """Nodes above each chunk of consecutive nodes, up to `chunk_levels` levels or the tree's root."""

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["tree", "chunk"]):
            tree, level, size = (table[c][0].as_py() for c in ("tree", "level", "size"))
            held, at = table["digest"].to_pylist(), table["at"][0].as_py()
            levels, places, digests = [], [], []
            for up in range(1, chunk_levels + 1):
                if level_size(size, level + up - 1) == 1:
                    break
                held = [digest("".join(held[k : k + ARITY])) for k in range(0, len(held), ARITY)]
                at //= ARITY
                levels += [level + up] * len(held)
                places += range(at, at + len(held))
                digests += held
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * len(levels), pa.string()), pa.array(levels, pa.int32()), pa.array(places, pa.int64()),
                 pa.array(digests, pa.string()), pa.array([size] * len(levels), pa.int64())],
                names=["tree", "level", "at", "digest", "size"],
            )

    return reduced


def _nodes(leaves: DataFrame, name: str, chunk_levels: int) -> DataFrame:
    """All nodes of the trees of `leaves` (`tree`, `place`, `leaf`, `size`), leaves as level 0."""
    now = leaves.select("tree", F.lit(0).alias("level"), F.col("place").alias("at"), F.col("leaf").alias("digest"), "size")
    nodes, level = now, 0
    most = leaves.agg(F.max("size")).first()[0] or 0
    while level < depth(most):
        chunked = now.withColumn("chunk", F.expr(f"at div {ARITY**chunk_levels}"))
        dealt = chunked.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "at")
        above = staged(dealt.mapInArrow(_reduced(chunk_levels), NODE_DDL), f"{name}_{level}")
        level += chunk_levels
        nodes, now = nodes.unionAll(above), above.filter(F.col("level") == level)
    return nodes


@dataclass
class Manifest:
    """`leaves`: tree, doc_id, leaf, tampered, place, size, top_place; `nodes`: tree, level, at, digest, size."""

    leaves: DataFrame
    nodes: DataFrame
    n_trees: int
    root: str | None
    chunk_levels: int


def manifest(docs: DataFrame, chunk_levels: int = CHUNK_LEVELS) -> Manifest:
    """The written manifest of `docs`. `tampered` is the leaf of the row with `\\n` deleted from its text, where that is tried."""
    small_batches(docs.sparkSession)
    rows = pick(docs, *FIELDS)
    fields = {name: F.col(name) for name in FIELDS}
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = leaf_digest({**fields, "text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))})
    leaves = rows.select(
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("tree"),
        "doc_id",
        leaf_digest(fields).alias("leaf"),
        F.when(picked & F.contains("text", F.lit("\n")), tampered).alias("tampered"),
    )
    leaves = staged(_placed(staged(leaves, "merkle_rows"), ["doc_id", "leaf"], "merkle_sorted"), "merkle_leaves")
    nodes = _nodes(leaves, "merkle_nodes", chunk_levels)
    subroots = nodes.groupBy("tree").agg(F.max_by("digest", "level").alias("leaf"))
    subroots = subroots.select(F.lit(TOP_TREE).alias("tree"), F.col("tree").alias("member"), "leaf")
    placed = staged(_placed(staged(subroots, "merkle_subroots"), ["member"], "merkle_tops"), "merkle_placed")
    top = _nodes(placed, "merkle_top", chunk_levels)
    n_trees = placed.count()
    last = top.filter((F.col("level") == depth(n_trees)) & (F.col("at") == 0)).first()
    named = placed.select(F.col("member").alias("tree"), F.col("place").alias("top_place"))
    root = last["digest"] if last else None
    return Manifest(leaves.join(named, "tree"), nodes.unionAll(top), n_trees, root, chunk_levels)


def missing(held: list[int], size: int) -> Iterator[tuple[int, int]]:
    """(level, at) of the fewest nodes that, with the leaves at places `held`, give all nodes up to the root."""
    known = sorted(set(held))
    for level in range(depth(size)):
        n = level_size(size, level)
        have = set(known)
        parents = sorted({at // ARITY for at in known})
        for parent in parents:
            for at in range(ARITY * parent, min(ARITY * parent + ARITY, n)):
                if at not in have:
                    yield level, at
        known = parents


WANTED_DDL = "part_tree string, chunk long, tree string, level int, at long"


def _wanted(n_trees: int):
    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["tree", "chunk"]):
            tree, chunk, size, top_place = (table[c][0].as_py() for c in ("tree", "chunk", "size", "top_place"))
            own = [(tree, *c) for c in missing(table["place"].to_pylist(), size)]
            own += [(TOP_TREE, *c) for c in missing([top_place], n_trees)]
            trees, levels, at = (list(x) for x in zip(*own)) if own else ([], [], [])
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * len(own), pa.string()), pa.array([chunk] * len(own), pa.int64()),
                 pa.array(trees, pa.string()), pa.array(levels, pa.int32()), pa.array(at, pa.int64())],
                names=["part_tree", "chunk", "tree", "level", "at"],
            )

    return wanted


class PartialTree:
    """What one partition knows of a tree: its own nodes and the fetched ones, and what follows from them."""

    def __init__(self, size: int, leaves: dict[int, str], fetched: dict[tuple[int, int], str]):
        self.size, self.depth = size, depth(size)
        self.paths: dict[tuple[int, int], list[tuple[str, str]]] = {}
        self.sides: list[dict[int, tuple[str, str]]] = []
        known = leaves
        for level in range(self.depth):
            n, sides, above = level_size(size, level), {}, {}
            for parent in {at // ARITY for at in known}:
                members = range(ARITY * parent, min(ARITY * parent + ARITY, n))
                run = [known[at] if at in known else fetched[level, at] for at in members]
                above[parent] = digest("".join(run))
                for k, at in enumerate(members):
                    if at in known:
                        sides[at] = "".join(run[:k]), "".join(run[k + 1 :])
            self.sides.append(sides)
            known = above
        self.root = known[0]

    def path(self, at: int, level: int = 0) -> list[tuple[str, str]]:
        """(left, right) siblings of the node and of its ancestors; what leaves share is kept, not built again."""
        if level == self.depth:
            return []
        key = level, at
        if key not in self.paths:
            self.paths[key] = [self.sides[level][at], *self.path(at // ARITY, level + 1)]
        return self.paths[key]


def folded(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that follows from a leaf and its siblings."""
    for left, right in path:
        leaf = digest(left + leaf + right)
    return leaf


PROOF_DDL = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proved(root: str, n_trees: int, siblings: bool):
    def proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["part_tree", "chunk"]):
            rows = table.to_pylist()
            own = [r for r in rows if r["level"] is None]
            fetched = {(r["tree"], r["level"], r["at"]): r["leaf"] for r in rows if r["level"] is not None}
            tree, size, top_place = own[0]["tree"], own[0]["size"], own[0]["top_place"]
            below = PartialTree(
                size, {r["at"]: r["leaf"] for r in own}, {k[1:]: d for k, d in fetched.items() if k[0] == tree}
            )
            above = PartialTree(
                n_trees, {top_place: below.root}, {k[1:]: d for k, d in fetched.items() if k[0] == TOP_TREE}
            )
            if above.root != root:
                raise ValueError(f"the manifest's nodes do not lead to its root in {tree!r}")
            top_path, out = above.path(top_place), []
            for r in own:
                path = below.path(r["at"]) + top_path
                proof = [left + right for left, right in path]
                end = folded(r["tampered"] or r["leaf"], path)
                out.append((r["doc_id"], r["leaf"], below.root, root, digest("".join(proof)), end, end == root, proof))
            columns = list(zip(*out, strict=True))
            kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
            arrays = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
            names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
            if siblings:
                lists = [[s[k : k + 64] for s in proof for k in range(0, len(s), 64)] for proof in columns[-1]]
                arrays, names = [*arrays, pa.array(lists, pa.list_(pa.string()))], [*names, "siblings"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return proved


def proofs(of: Manifest, wanted: Callable[[DataFrame], DataFrame] = lambda leaves: leaves, siblings: bool = False) -> DataFrame:
    """Proofs of the leaves that `wanted` leaves of the manifest's table (all of them by default).

    Columns: `doc_id`, `leaf`, `subroot`, `root`, `proof_sha256` (hash of all siblings, level by level, left to
    right), `folded_root` (from the tampered leaf where there is one), `verified`; with `siblings` the siblings too.
    """
    leaves = wanted(of.leaves).withColumn("chunk", F.expr(f"place div {ARITY**of.chunk_levels}"))
    ddl = PROOF_DDL + (", siblings array<string>" if siblings else "")
    if of.root is None:
        return of.leaves.sparkSession.createDataFrame([], ddl)
    dealt = leaves.select("tree", "chunk", "place", "size", "top_place")
    dealt = dealt.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "place")
    asked = staged(dealt.mapInArrow(_wanted(of.n_trees), WANTED_DDL), "merkle_wanted")
    found = asked.join(of.nodes.select("tree", "level", "at", "digest"), ["tree", "level", "at"])
    none = F.lit(None)
    fetched = found.select(
        "part_tree", "chunk", "tree", "level", "at", F.col("digest").alias("leaf"), none.cast("string").alias("tampered"),
        none.cast("long").alias("doc_id"), none.cast("long").alias("size"), none.cast("long").alias("top_place"),
    )
    own = leaves.select(
        F.col("tree").alias("part_tree"), "chunk", "tree", none.cast("int").alias("level"), F.col("place").alias("at"),
        "leaf", "tampered", "doc_id", "size", "top_place",
    )
    met = own.unionAll(fetched).repartition("part_tree", "chunk").sortWithinPartitions("part_tree", "chunk")
    return met.mapInArrow(_proved(of.root, of.n_trees, siblings), ddl)


def proof_report(docs: DataFrame) -> DataFrame:
    """The manifest of `docs` and the proof of every leaf."""
    return proofs(manifest(docs))
