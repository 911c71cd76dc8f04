"""Operator 8: remove bytes covered by a 200-byte string that starts at another place too.

Content-marked hashing, not induced sorting of all suffixes: that moves 8 bytes and more for each byte of
text several times, beyond the disk limit (README.md). As induced sorting sorts only marked suffixes and
derives the others, this aggregates content-marked places and derives the rest from them:

1. *Marked places.* Among the GRAM-byte strings of each 200-byte string the one
   with the smallest hash marks it. Equal strings have equal marks wherever they
   stand, and consecutive starts with the same mark form one run, so one tuple
   (mark, fingerprint of the run's whole extent) stands for up to
   LENGTH - GRAM + 1 starts.
2. *Runs.* Spark's external sort and aggregation bring equal marks together. A mark
   that occurs once settles its run as unique. Runs with equal mark and equal
   extent settle each other as repeated.
3. *Induced starts.* Only runs that share a mark but not the extent (the ends of
   shared passages) are opened, one run of every distinct extent, so that a short
   passage also meets the inside of a longer one. First in blocks of BLOCK starts,
   counted from the mark: the bytes common to a block's strings settle it as unique
   if they occur once. The starts of the others get a fingerprint of their own
   200 bytes each, and those are counted.

Distinct texts are worked on once, with their number of copies; they are bucketed
by text hash, so that the later joins move no text. Marks and fingerprints have 64
bits each.

Null texts are empty. Matches never cross documents. Cuts may split a UTF-8
character: bytes are kept exactly, and `kept_text` leaves out what no longer forms
a character. Repeated rows are documents of their own, so they remove each other
(from 200 bytes on). Very long texts are marked and opened piece by piece. Empty tables
give no rows. Extra columns are ignored by `repeated_spans`, kept by `remove_repeats`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import (
    BYTE_VALUES,
    U64,
    as_long,
    discard,
    mix,
    pick,
    powers,
    small_batches,
    staged,
    staged_in_buckets,
)

LENGTH = 200
GRAM = 80
WINDOW = LENGTH - GRAM + 1
BLOCK = 16
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
#: Starts worked on at once: a long text is read in pieces that overlap by LENGTH - 1 bytes.
PIECE = 1 << 16
PLACE_BITS = U64(17)  # of a place in a piece


def _sums(data: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[data] * powers(len(data)))])


def _extents(sums: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    """Fingerprint of the `size` bytes from each start."""
    return mix((sums[start + size] - sums[start]) * powers(len(sums), -1)[start] + size.astype(np.uint64))


def marked_runs(data: bytes) -> tuple[np.ndarray, ...]:
    """(mark, extent fingerprint, first start, number of starts, place of the mark) of every run of the text."""
    whole = np.frombuffer(data, np.uint8)
    out = []
    for low in range(0, len(whole) - LENGTH + 1, PIECE):
        part = whole[low : low + PIECE + LENGTH - 1]
        sums = _sums(part)
        at = np.arange(len(part) - GRAM + 1)
        grams = _extents(sums, at, np.full(len(at), GRAM))
        # The place in the low bits: of equal strings the leftmost marks, so equal strings are marked alike.
        keyed = (grams >> PLACE_BITS << PLACE_BITS) | at.astype(np.uint64)
        least, width = keyed, 1
        while 2 * width <= WINDOW:
            least, width = np.minimum(least[:-width], least[width:]), 2 * width
        least = np.minimum(least[: len(part) - LENGTH + 1], least[WINDOW - width :][: len(part) - LENGTH + 1])
        first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        count = np.diff(np.concatenate([first, [len(least)]]))
        place = (least[first] & U64((1 << int(PLACE_BITS)) - 1)).astype(np.int64)
        out.append((grams[place], _extents(sums, first, count + LENGTH - 1), first + low, count, place + low))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


MARK_DDL = "text_a long, text_b long, mark long, extent long, start int, starts int, place int, times int"
PRINT_DDL = "text_a long, text_b long, print long, start int, starts int, times int"


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["text_a", "text_b", "mark", "extent", "start", "starts", "place", "times"]
    for batch in batches:
        a, b, times = (batch.column(k).to_pylist() for k in ("text_a", "text_b", "copies"))
        for row, data in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            mark, extent, *places = marked_runs(data)
            n = len(mark)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, a[row], np.int64)),
                    pa.array(np.full(n, b[row], np.int64)),
                    pa.array(as_long(mark)),
                    pa.array(as_long(extent)),
                    *[pa.array(x.astype(np.int32)) for x in places],
                    pa.array(np.full(n, min(times[row], 2), np.int32)),
                ],
                names=names,
            )


def block_cores(first: int, count: int, place: int) -> list[tuple[int, int, int, int]]:
    """(first start, starts, from, to) of the blocks of a run: `from`..`to` are the bytes that the block's strings share.

    Blocks are counted back from the mark's place, so they fall alike wherever the mark stands.
    """
    out = []
    for number in range((place - (first + count - 1)) // BLOCK, (place - first) // BLOCK + 1):
        low, high = place - number * BLOCK - BLOCK + 1, place - number * BLOCK
        start = max(first, low)
        out.append((start, min(first + count - 1, high) - start + 1, high, low + LENGTH))
    return out


def _opened(batches: Iterator[pa.RecordBatch], pieces) -> Iterator[pa.RecordBatch]:
    """For each text and its `todo`: `pieces(todo)` gives starts, numbers of starts, from, to, times; their prints."""
    for batch in batches:
        a, b = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
        texts = batch.column("text").cast(pa.binary())
        for row in range(batch.num_rows):
            start, starts, low, high, times = pieces(batch.column("todo")[row].as_py())
            sums = _sums(np.frombuffer(texts[row].as_buffer(), np.uint8))
            for at in range(0, len(start), PIECE):
                cut = slice(at, at + PIECE)
                n = len(start[cut])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, a[row], np.int64)),
                        pa.array(np.full(n, b[row], np.int64)),
                        pa.array(as_long(_extents(sums, low[cut], high[cut] - low[cut]))),
                        pa.array(start[cut].astype(np.int32)),
                        pa.array(starts[cut].astype(np.int32)),
                        pa.array(times[cut].astype(np.int32)),
                    ],
                    names=["text_a", "text_b", "print", "start", "starts", "times"],
                )


def _open_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces(todo: list[dict]) -> tuple[np.ndarray, ...]:
        rows = [(*core, r["times"]) for r in todo for core in block_cores(r["start"], r["starts"], r["place"])]
        return tuple(np.array(rows, np.int64).T)

    return _opened(batches, pieces)


def _open_starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def pieces(todo: list[dict]) -> tuple[np.ndarray, ...]:
        first, count, times = (np.array([r[k] for r in todo], np.int64) for k in ("start", "starts", "times"))
        start = np.repeat(first, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return start, np.ones(len(start), np.int64), start, start + LENGTH, np.repeat(times, count)

    return _opened(batches, pieces)


def removed_runs(size: int, starts: np.ndarray, counts: np.ndarray) -> list[tuple[int, int]]:
    """Maximal [from, to) byte runs covered by the LENGTH-byte strings of the given runs of starts."""
    if not len(starts):
        return []
    order = np.argsort(starts, kind="stable")
    low, high = starts[order], np.maximum.accumulate((starts + counts + LENGTH - 1)[order])
    new = np.concatenate([[True], low[1:] > high[:-1]])
    ends = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(low) - 1]])
    return [(int(a), min(int(b), size)) for a, b in zip(low[new], high[ends], strict=True)]


def _cut(with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for data, copies, spans in zip(texts, batch.column("copies").to_pylist(), batch.column("spans"), strict=True):
                if copies > 1:
                    cuts = [(0, len(data))]
                else:
                    spans = spans.as_py() or []
                    starts = np.array([x["start"] for x in spans], np.int64)
                    counts = np.array([x["starts"] for x in spans], np.int64)
                    cuts = removed_runs(len(data), starts, counts)
                kept, at = [], 0
                for a, b in cuts:
                    kept.append(data[at:a])
                    at = b
                kept = b"".join([*kept, data[at:]])
                text = kept.decode("utf-8", "ignore") if with_text and cuts else None
                rows.append((sum(b - a for a, b in cuts), len(cuts), hashlib.sha256(kept).hexdigest(), text))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("text_a"),
                    batch.column("text_b"),
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int64()),
                    pa.array(columns[2], pa.string()),
                    pa.array(columns[3], pa.string()),
                ],
                names=["text_a", "text_b", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )

    return cut


def _text_key(text) -> list:
    return [F.xxhash64(text).alias("text_a"), F.xxhash64(F.lit(7), text).alias("text_b")]


def _distinct_texts(docs: DataFrame) -> DataFrame:
    """Texts of LENGTH bytes and more, once each with their number of copies, bucketed by text hash."""
    spark = docs.sparkSession
    long_enough = docs.select("text").filter(F.octet_length("text") >= LENGTH)
    texts = (
        long_enough.select(*_text_key(F.col("text")), "text")
        .groupBy("text_a", "text_b")
        .agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    )
    # As many as shuffle partitions: the grouping's own partitions are the buckets, and joins need no other shuffle.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return staged_in_buckets(texts, "suffix_texts", ["text_a", "text_b"], buckets)


def _spans(texts: DataFrame) -> DataFrame:
    """`text_a`, `text_b`, `spans`: per text the runs of starts (`start`, `starts`) whose LENGTH bytes occur again."""
    text = ["text_a", "text_b"]
    marked = staged(texts.mapInArrow(_mark, MARK_DDL), "suffix_marks")
    extents = marked.groupBy("mark", "extent").agg(F.sum("times").alias("all_times"))
    # Marks that occur once are settled; the extents of the others, with the number of extents of the mark.
    kinds = extents.groupBy("mark").agg(F.sum("all_times").alias("n"), F.count("*").alias("kinds")).filter("n > 1")
    shared = staged(extents.join(kinds, "mark").select("mark", "extent", "all_times", "kinds"), "suffix_extents")
    members = staged(marked.join(shared, ["mark", "extent"]), "suffix_members")
    discard(marked, shared)
    whole = members.filter("all_times > 1 AND times = 1").select(*text, "start", "starts")

    place = F.struct(*text, "start", "starts", "place")
    todo = members.filter("kinds > 1").groupBy("mark", "extent").agg(
        F.min(place).alias("run"), F.least(F.sum("times"), F.lit(2)).alias("times")
    )
    todo = todo.select("run.*", "times").groupBy(*text).agg(
        F.collect_list(F.struct("start", "starts", "place", "times")).alias("todo")
    )
    blocks = texts.select(*text, "text").join(todo, text).mapInArrow(_open_blocks, PRINT_DDL)
    blocks = staged(blocks, "suffix_blocks")
    todo = _again(blocks).groupBy(*text).agg(
        F.collect_list(F.struct("start", "starts", "times")).alias("todo")
    )
    opened = texts.select(*text, "text").join(todo, text).mapInArrow(_open_starts, PRINT_DDL)
    opened = staged(opened, "suffix_starts")
    discard(blocks)
    single = _again(opened, "times = 1").select(*text, "start", "starts")
    spans = whole.unionAll(single).groupBy(*text).agg(F.collect_list(F.struct("start", "starts")).alias("spans"))
    spans = staged(spans, "suffix_spans")
    discard(members, opened)
    return spans


def _again(prints: DataFrame, only: str = "true") -> DataFrame:
    """The rows (those that `only` asks for) whose print occurs more than once among all rows."""
    again = prints.groupBy("print").agg(F.sum("times").alias("n")).filter("n > 1").select("print")
    return prints.filter(only).join(again, "print")


def _cut_texts(docs: DataFrame, with_text: bool) -> DataFrame:
    """Per distinct text of LENGTH bytes and more that loses bytes: its cuts as figures, and the kept text if asked."""
    small_batches(docs.sparkSession)
    texts = _distinct_texts(docs)
    return (
        texts.join(_spans(texts), ["text_a", "text_b"], "left")
        .filter("copies > 1 OR spans IS NOT NULL")
        .select("text_a", "text_b", "text", "copies", "spans")
        .mapInArrow(
            _cut(with_text),
            "text_a long, text_b long, n_removed long, n_spans long, kept_sha256 string, kept_text string",
        )
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256` for every row of `docs` (`doc_id`, `text`)."""
    docs = pick(docs, "doc_id", "text")
    cuts = _cut_texts(docs, with_text=False).drop("kept_text")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("sha"), *_text_key(text)
    )
    zero = F.lit(0).cast("long")
    return rows.join(cuts, ["text_a", "text_b"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with its columns and the repeated bytes taken out of `text` (null stays null)."""
    columns = docs.columns
    names = [f"c{at}" for at in range(len(columns))]
    where = columns.index("text")
    plain = docs.toDF(*names)
    cuts = _cut_texts(pick(docs, "text"), with_text=True).select("text_a", "text_b", "kept_text")
    keyed = plain.select("*", *_text_key(F.coalesce(names[where], F.lit(""))))
    done = keyed.join(cuts, ["text_a", "text_b"], "left")
    text = F.coalesce("kept_text", names[where])
    return done.select(
        *[(text if at == where else F.col(name)).alias(column) for at, (name, column) in enumerate(zip(names, columns, strict=True))]
    )
