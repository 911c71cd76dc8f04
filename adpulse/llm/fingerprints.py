"""Operator 2: Lempel-Ziv phrase fingerprints.

A text is parsed into Lempel-Ziv (1978) phrases: each is the shortest string from
the current place that is not yet in the text's dictionary. The phrase set, hashed,
is what a compressor would learn of the text, and the `KEEP` smallest phrase hashes
are its fingerprint. The likeness of two fingerprints is the share of common values
among the `KEEP` smallest of both together, an estimate of the Jaccard similarity
of the phrase sets (exact for sets of up to `KEEP` phrases).

The neighbouring document is found without a global sort: documents are dealt to
blocks of ascending doc_id, the first document of a block also goes to the block
that precedes it in descending order, and a block is read as a sorted stream.

Null and empty texts have the empty fingerprint; two empty ones are alike (1.0),
an empty and another one are not (0.0). Rows with a null doc_id come last in the
descending order; rows that repeat a doc_id are ordered by a hash of their text, and first by
block where they fill several. A single document is its own neighbour. Very long texts are parsed whole; empty
tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import U64, mix, pick, powers, small_batches

KEEP = 128
BLOCKS_PER_PARTITION = 4
_NULL_ID = -(1 << 63)


def _phrases(text: str, seen: set[str], phrase: str, low: int, high: int, ends: list[int]) -> str:
    """Goes on parsing text[low:high] with the dictionary `seen` and an open phrase; returns the phrase left open."""
    add, note = seen.add, ends.append
    for at in range(low, high):
        phrase += text[at]
        if phrase not in seen:
            add(phrase)
            note(at + 1)
            phrase = ""
    return phrase


def _hashes(text: str, ends: list[int]) -> np.ndarray:
    """32-bit hashes of the phrases that end at `ends` (the first starts at 0)."""
    if not ends:
        return np.zeros(0, np.uint32)
    points = np.frombuffer(text[: ends[-1]].encode("utf-32-le"), "<u4").astype(np.uint64)
    points = points * U64(0xC2B2AE3D27D4EB4F) + U64(0x165667B19E3779F9)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(points * powers(len(points)))])
    stop = np.array(ends)
    start = np.concatenate([[0], stop[:-1]])
    return (mix((sums[stop] - sums[start]) * powers(len(sums), -1)[start]) >> U64(32)).astype(np.uint32)


def smallest(hashes: np.ndarray, keep: int = KEEP) -> np.ndarray:
    hashes = np.unique(hashes) if len(hashes) <= 4 * keep else np.unique(np.partition(hashes, 2 * keep)[: 2 * keep])
    return hashes[:keep]


def likeness(one: np.ndarray, two: np.ndarray, keep: int = KEEP) -> float:
    if not len(one) or not len(two):
        return float(len(one) == len(two))
    both, count = np.unique(np.concatenate([one, two]), return_counts=True)
    return float((count[:keep] == 2).sum() / len(count[:keep]))


class Parsed:
    """A text with its phrases, kept open at the place where its edited form departs."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.cut = len(text) - len(text) // 2
        self.seen: set[str] = set()
        self.ends: list[int] = []
        self.open = _phrases(text, self.seen, "", 0, self.cut, self.ends)
        seen, ends = self.seen.copy(), self.ends.copy()
        _phrases(text, seen, self.open, self.cut, len(text), ends)
        self.print = smallest(_hashes(text, ends))

    def edited(self, other: str) -> tuple[str, np.ndarray]:
        """The text whose last floor(n/2) code points are replaced by the first as many of `other`, and its fingerprint."""
        text = self.text[: self.cut] + other[: len(self.text) // 2]
        seen, ends = self.seen, self.ends.copy()
        _phrases(text, seen, self.open, self.cut, len(text), ends)
        self.seen = set()
        return text, smallest(_hashes(text, ends))


def _fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a block in descending order, the next block's first as `ahead`; one row per own document."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
         ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
    )
    written = lambda p: p.astype(">u4").tobytes().hex()
    done: list[dict] = []
    last: tuple[object, Parsed] | None = None
    block, over = None, False
    for batch in batches:
        for part, ahead, doc_id, text in zip(
            *(batch.column(k).to_pylist() for k in ("block", "ahead", "doc_id", "text")), strict=True
        ):
            if part != block:
                block, over, last = part, False, None
            if over:
                continue
            now = Parsed(text or "")
            if last is not None:
                before_id, before = last
                edited, edited_print = before.edited(now.text)
                done.append(
                    {
                        "doc_id": before_id,
                        "n_chars": len(before.text),
                        "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
                        "fingerprint": written(before.print),
                        "edited_fingerprint": written(edited_print),
                        "near_edited": likeness(before.print, edited_print),
                        "near_next": likeness(before.print, now.print),
                    }
                )
            last, over = (doc_id, now), bool(ahead)
            if len(done) >= 256:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
    if done:
        yield pa.RecordBatch.from_pylist(done, schema=schema)


def _longs(values: list[int]) -> Column:
    """An array literal, parsed in one call."""
    return F.expr(f"array({', '.join(f'{x}L' if x > _NULL_ID else f'CAST({x} AS LONG)' for x in values)})")


def _block_of(key: Column, borders: list[int]) -> Column:
    """The number of `borders` (ascending) below `key`, looked up in two steps."""
    if not borders:
        return F.lit(0)
    width = max(1, math.isqrt(len(borders)))
    groups = [borders[at : at + width] for at in range(0, len(borders), width)]
    group = F.size(F.filter(_longs([g[-1] for g in groups]), lambda x: x < key))
    within = F.slice(_longs(borders), group * width + 1, F.lit(width))
    inner = F.when(group < len(groups), F.size(F.filter(within, lambda x: x < key))).otherwise(0)
    return F.least(group * width, F.lit(len(borders))) + inner


def _dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """`docs` with `key`, `tie` and `block`, ascending blocks holding ascending keys.

    An id that fills several blocks alone (null ids, say, or one that repeats) gets as many blocks of its own, between
    those of smaller and greater ids; its rows are dealt to them by where they were read.
    """
    key = F.coalesce("doc_id", F.lit(_NULL_ID))
    keyed = docs.select("doc_id", "text", key.alias("key"), F.xxhash64("text").alias("tie"))
    shares = [k / blocks for k in range(1, blocks)]
    # A number per block comes to the driver, however many documents there are.
    found = keyed.agg(F.percentile_approx("key", shares, 10 * blocks)).first()[0] or []
    borders = sorted(set(found))
    hot = {x: n for x, n in Counter(found).items() if n > 1}
    wide = max(hot.values(), default=0) + 1
    block = _block_of(F.col("key"), borders) * wide
    if hot:
        own = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.element_at(_longs(list(hot.values())), F.col("at_hot"))) + 1
        keyed = keyed.withColumn("at_hot", F.array_position(_longs(list(hot)), F.col("key")).cast("int"))
        block = block + F.when(F.col("at_hot") > 0, own).otherwise(0)
    return keyed.select("doc_id", "text", "key", "tie", block.cast("long").alias("block"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (`doc_id`, `text`): its fingerprint, its edited text's, and both likenesses."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = _dealt(docs, BLOCKS_PER_PARTITION * parts)
    # The first row of each block in descending order also goes to the next block above, whose last row it follows. A row
    # per block comes to the driver.
    first = keyed.groupBy("block").agg(F.max(F.struct("key", F.bitwise_not("tie").alias("tie"))).alias("top"))
    tops = sorted((r["block"], r["top"]["key"], ~r["top"]["tie"]) for r in first.toLocalIterator())
    above = {block: tops[(at + 1) % len(tops)][0] for at, (block, _, _) in enumerate(tops)}
    halo = spark.createDataFrame(
        [(block, key, tie, above[block]) for block, key, tie in tops], "block long, top long, top_tie long, target long"
    )
    found = keyed.join(F.broadcast(halo), "block", "left")  # a row per block
    is_first = (F.col("key") == F.col("top")) & (F.col("tie") == F.col("top_tie"))
    own = F.struct("block", F.lit(0).alias("ahead"))
    ahead = F.struct(F.col("target").alias("block"), F.lit(1).alias("ahead"))
    places = F.explode(F.when(is_first, F.array(own, ahead)).otherwise(F.array(own)))
    rows = found.select(places.alias("place"), "key", "tie", "doc_id", "text")
    rows = rows.select("place.block", "place.ahead", "key", "tie", "doc_id", "text")
    order = [F.col("block"), F.col("ahead"), F.col("key").desc(), F.col("tie")]
    return (
        rows.repartition(parts, "block")
        .sortWithinPartitions(*order)
        .select("block", "ahead", "doc_id", "text")
        .mapInArrow(_fingerprinted, FINGERPRINT_DDL)
    )


FINGERPRINT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
