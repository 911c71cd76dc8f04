"""Operator 3: pack documents into sequences by Karmarkar-Karp multiway differencing.

A document's ids are its byte-level BPE ids plus one end id. Whole windows of
`CAPACITY` ids are cut off first and are sequences of their own; the remainders of
a group of documents (rows are dealt to groups of bounded size) are packed together:

* the window count starts at the least that can hold the remainders' ids;
* differencing keeps, for every partial solution, the loads of its windows, and
  merges the two solutions of the largest spread, heaviest windows against
  lightest, until one is left; its windows are nearly equal;
* a window above the capacity gives its excess, cut off its last piece, to windows
  with room (`cut=True`), or, where documents must stay whole, the window count
  rises by one and differencing starts anew.

Null texts are empty and consist of the end id alone. Rows that repeat a doc_id are
documents of their own. Very long texts are tokenized whole; empty tables give no rows. Extra columns are ignored. A sequence is a group number and
a number in its group, so no counter is shared; groups are rows, ids travel once.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import pick, runs, small_batches

CAPACITY = 2048
END_ID = 1
VOCABULARY = "byte_bpe_50k"
#: Bytes of text whose remainders are packed together.
GROUP_BYTES = 2 << 20
SEQUENCE_BITS = 32


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Karmarkar-Karp: item numbers of each of `windows` nearly equal windows.

    A partial solution is its non-empty windows only, heaviest first; the others
    count as empty, so a merge costs what the two solutions hold.
    """
    heap = []
    for item, size in enumerate(sizes):
        heapq.heappush(heap, (-size if windows > 1 else 0, item, [(size, [item])]))
    serial = len(sizes)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        # Heaviest of one against lightest of two; only where both are occupied do windows merge.
        over = max(0, len(one) + len(two) - windows)
        both = one[: len(one) - over] + two[: len(two) - over]
        tail, lead = one[len(one) - over :], two[len(two) - over :]
        both += [(a[0] + b[0], a[1] + b[1]) for a, b in zip(tail, reversed(lead), strict=True)]
        both.sort(key=lambda w: -w[0])
        least = both[-1][0] if len(both) == windows else 0
        heapq.heappush(heap, (least - both[0][0], serial, both))
        serial += 1
    return [items for _, items in heap[0][2]] if heap else []


def pack(sizes: list[int], capacity: int = CAPACITY, cut: bool = True) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, from, length) pieces: every id of every item lies in one piece, no window exceeds `capacity`.

    Without `cut` items must fit the capacity.
    """
    total = sum(sizes)
    if not total:
        return []
    windows = -(-total // capacity)
    while True:
        found = differencing(sizes, windows)
        if cut or all(sum(sizes[i] for i in items) <= capacity for items in found):
            break
        windows += 1
    found = [[(i, 0, sizes[i]) for i in items if sizes[i]] for items in found]
    found += [[] for _ in range(windows - len(found))]
    spare = []
    for window in found:
        excess = sum(length for _, _, length in window) - capacity
        while excess > 0:
            item, start, length = window.pop()
            less = max(0, length - excess)
            if less:
                window.append((item, start, less))
            spare.append((item, start + less, length - less))
            excess -= length - less
    room = [(capacity - sum(length for _, _, length in window), at) for at, window in enumerate(found)]
    room = [(free, at) for free, at in sorted(room, reverse=True) if free]
    for item, start, length in spare:
        while length:
            free, at = room.pop(0)
            part = min(free, length)
            found[at].append((item, start, part))
            start, length = start + part, length - part
            if free > part:
                room.insert(0, (free - part, at))
    return [window for window in found if window]


_encoders: dict[str, object] = {}


def encoder(vocabulary: str):
    """text -> ids, as the `tokenizers` file of the vocabulary gives them with add_special_tokens=False.

    The same vocabulary is read by the faster of two libraries. Its own file takes the texts that hold one of its added
    tokens (they have ids of their own), and what the fast one refuses.
    """
    if vocabulary not in _encoders:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(piece): int(number) for piece, number in map(bytes.split, lines)}
        fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        whole = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        added = [token.content for token in whole.get_added_tokens_decoder().values()]

        def encode(text: str) -> np.ndarray:
            if not any(token in text for token in added):
                try:
                    return np.array(fast.encode_ordinary(text), np.uint32)
                except Exception:  # its pattern matcher gives up on some very long runs
                    pass
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.uint32)

        _encoders[vocabulary] = encode
    return _encoders[vocabulary]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4").tobytes())


ROWS_DDL = "group long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, rest binary"


def _tokenized(vocabulary: str, capacity: int):
    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows = []
            for group, doc_id, text in zip(*(batch.column(k).to_pylist() for k in ("group", "doc_id", "text")), strict=True):
                ids = np.append(encode(text or ""), np.uint32(END_ID))
                n = len(ids)
                whole = n - n % capacity
                for start in range(0, whole, capacity):
                    rows.append((group, doc_id, start, capacity, _crc(ids[start : start + capacity]), n, None))
                if whole < n:
                    narrow = ids[whole:].astype("<u2") if ids.max() < 1 << 16 else ids[whole:].astype("<u4")
                    rows.append((group, doc_id, whole, n - whole, None, n, narrow.tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["group", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "rest"],
            )

    return tokenized


PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _packed(capacity: int):
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["group"]):
            rows = table.to_pylist()
            base = rows[0]["group"] << SEQUENCE_BITS
            out, number = [], 0
            rest = [r for r in rows if r["rest"] is not None]
            for r in rows:
                if r["rest"] is None:
                    out.append((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], base + number, 0))
                    number += 1
            for window in pack([r["length"] for r in rest], capacity):
                offset = 0
                for item, start, length in window:
                    r = rest[item]
                    ids = np.frombuffer(r["rest"], "<u2" if len(r["rest"]) == 2 * r["length"] else "<u4")
                    crc = _crc(ids[start : start + length])
                    out.append((r["doc_id"], r["start"] + start, length, crc, r["doc_tokens"], base + number, offset))
                    offset += length
                number += 1
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    return packed


def packed_sequences(docs: DataFrame, vocabulary: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: `doc_id`, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    size = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    # Dealt by where a row was read, not by what it holds: repeated rows spread over the groups like any others.
    group = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    rows = docs.select(group.alias("group"), "doc_id", "text")
    tokenized = rows.mapInArrow(_tokenized(vocabulary, capacity), ROWS_DDL)
    # The order within a group fixes the packing, whatever order the shuffle brings.
    grouped = tokenized.repartition("group").sortWithinPartitions("group", "doc_id", "start", "length", "ids_crc32", "rest")
    return grouped.mapInArrow(_packed(capacity), PIECES_DDL)
