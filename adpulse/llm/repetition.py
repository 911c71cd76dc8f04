"""Operator 11: quality rules on repetition, by suffix arrays.

For each text (as UTF-8 bytes) the suffix array is built, and with it, for every suffix, the depth of the
deepest longest-common-prefix interval that holds it: the longest string that starts there and anywhere else
in the text. Where that string is not just the tail of the one a byte before, it is a maximal repeat. Maximal
repeats of `MIN_REPEAT` bytes or more, cut to whole characters, give the spans; their union is the repeated part
of the text.

Rules: the union may cover at most `MAX_COVERED` of the text, and no repeat may be longer than `MAX_REPEAT`
bytes. They apply beside two base rules: at least `MIN_WORDS` words, and at most half of them in repeated
3-word windows.

How: several texts are handled at once, about `GROUP_BYTES` of them. Suffixes are ordered by 7 bytes first, then by
prefix doubling of those that are still tied. Depths come from the permuted longest-common-prefix array:
only irreducible entries are compared byte by byte (their sum is bounded by 2 n log n), the others follow
from the entry before. A task holds about 60 bytes for each byte of `GROUP_BYTES` or of the longest text.

Null and empty texts have no words: base_failed, not kept, no spans. Very long texts are handled whole. Equal
texts get equal verdicts; rows that repeat a doc_id are judged each on its own, null ids as any. Empty tables
give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import pick, small_batches

MIN_REPEAT = 64
MAX_COVERED = 0.3
MAX_REPEAT = 600
MIN_WORDS = 50
GROUP_BYTES = 1 << 16
#: Bytes that order suffixes at first; the key's eighth byte says how many of them the text still has.
HEAD = 7
FEW = 64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CONTINUED = (np.arange(256) & 0xC0) == 0x80


def suffix_order(data: np.ndarray, text: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, key) of all suffixes, text by text; a key is a suffix's first HEAD bytes and how many of them there are.

    `data` holds the texts one after another, `text` each byte's text, `stop` the end of that text.
    """
    n = len(data)
    at = np.arange(n)
    left = stop - at
    padded = np.concatenate([data, np.zeros(HEAD, np.uint8)])
    key = np.minimum(left, HEAD).astype(np.uint64)
    for k in range(HEAD):
        byte = padded[k : k + n].astype(np.uint64)
        if k:
            byte[left <= k] = 0
        key |= byte << np.uint64(8 * (HEAD - k))
    order = np.argsort(key)
    texts = text[order]
    if text[-1]:
        kind = np.uint16 if text[-1] < 1 << 16 else np.int64
        order = order[np.argsort(texts.astype(kind), kind="stable")]
        texts = text[order]
    held = key[order]
    new = np.concatenate([[True], (held[1:] != held[:-1]) | (texts[1:] != texts[:-1])])
    rank = np.empty(n, np.int64)
    group = np.maximum.accumulate(np.where(new, at, 0))
    rank[order] = group
    # Slots of the order whose group has several suffixes.
    tied = np.flatnonzero(~new | ~np.concatenate([new[1:], [True]]))
    size = HEAD
    while len(tied):
        suffix, first = order[tied], group[tied]
        after = suffix + size
        inside = after < stop[suffix]
        second = np.zeros(len(suffix), np.int64)
        second[inside] = rank[after[inside]] + 1
        by = np.lexsort((second, first))
        suffix, second = suffix[by], second[by]
        new = np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])])
        order[tied] = suffix
        place = np.maximum.accumulate(np.where(new, np.arange(len(tied)), 0))
        group[tied] = tied[place]
        rank[suffix] = group[tied]
        tied = tied[~new | ~np.concatenate([new[1:], [True]])]
        size *= 2
    return order, key


def _common(data: np.ndarray, key: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of data[a:] and data[b:], at most `most`: HEAD bytes at a time."""
    length = np.zeros(len(a), np.int64)
    open_ = np.flatnonzero(most > 0)
    while len(open_) > FEW:
        here = length[open_]
        apart = (key[a[open_] + here] ^ key[b[open_] + here]) >> np.uint64(8)
        same = apart == 0
        length[open_[same]] += HEAD
        rest = apart[~same]
        length[open_[~same]] += sum((rest < np.uint64(1 << (8 * k))).astype(np.int64) for k in range(1, HEAD))
        open_ = open_[same]
        open_ = open_[length[open_] < most[open_]]
    for k in open_.tolist():
        step, x, y, end = 64, int(a[k]), int(b[k]), int(most[k])
        done = int(length[k])
        while done < end:
            to = min(end, done + step)
            differs = np.flatnonzero(data[x + done : x + to] != data[y + done : y + to])
            if len(differs):
                done += int(differs[0])
                break
            done, step = to, 2 * step
        length[k] = done
    return np.minimum(length, most)


def prefix_depths(data: np.ndarray, text: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For every byte: length of the longest string that starts there and elsewhere in its text."""
    n = len(data)
    order, key = suffix_order(data, text, stop)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = np.where(text[order[1:]] == text[order[:-1]], order[:-1], -1)
    # An entry is reducible where the bytes before the two neighbours are equal: then it is the last one less 1.
    at = np.arange(n)
    starts = np.concatenate([[True], text[1:] != text[:-1]])
    irreducible = starts | (before < 0)
    inner = np.flatnonzero(~irreducible)
    other = before[inner]
    irreducible[inner] = starts[other] | (data[inner - 1] != data[other - 1])
    first = np.flatnonzero(irreducible)
    pair = first[before[first] >= 0]
    end = at.copy()
    end[pair] += _common(data, key, pair, before[pair], stop[pair] - np.maximum(pair, before[pair]))
    lcp = np.maximum.accumulate(np.where(irreducible, end, 0)) - at
    # The deepest interval of a suffix is the deeper of those shared with its two neighbours in the order.
    depth = lcp.copy()
    has = before >= 0
    depth[before[has]] = np.maximum(depth[before[has]], lcp[has])  # each suffix comes before one other at most
    return depth


def maximal_repeats(data: np.ndarray, depth: np.ndarray, starts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of the maximal repeats of `least` bytes or more, cut to whole characters, in order."""
    longer = np.concatenate([[True], depth[1:] >= depth[:-1]]) | starts
    low = np.flatnonzero((depth >= least) & longer)
    high = low + depth[low]
    plain = ~_CONTINUED[data]
    # The next character's start from the left end, the last character's end from the right end.
    n = len(data)
    following = np.minimum.accumulate(np.where(plain, np.arange(n), n)[::-1])[::-1]
    boundary = np.concatenate([np.maximum.accumulate(np.where(plain, np.arange(n), 0)), [n]])
    low, high = following[low], np.where((high < n) & ~starts[np.minimum(high, n - 1)], boundary[np.minimum(high, n)], high)
    held = high - low >= least
    return low[held], high[held]


def union(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans' union: disjoint, in order, never touching. `low` ascends."""
    if not len(low):
        return low, high
    reach = np.maximum.accumulate(high)
    new = np.concatenate([[True], low[1:] > reach[:-1]])
    return low[new], reach[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(low) - 1]])]


def repeat_words(words: np.ndarray, text: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text: words in 3-word windows that occur twice or more in it. `words` are numbers, `text` their texts, ascending."""
    if len(words) < 3:
        return np.zeros(n_texts, np.int64)
    whole = text[2:] == text[:-2]
    size = int(words.max()) + 1
    # Each step numbers what it joins, so no key outgrows 64 bits.
    code = np.unique(text * size + words, return_inverse=True)[1]
    for k in (1, 2):
        code = np.unique(code[: len(words) - k] * size + words[k:], return_inverse=True)[1]
    times = np.bincount(code[whole], minlength=int(code.max()) + 1)
    hit = whole & (times[code] > 1)
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(hit)] |= hit
    return np.bincount(text[covered], minlength=n_texts)


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered", "n_bytes", "longest_repeat", "spans"]
DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered long, n_bytes long, longest_repeat long, spans array<struct<start: long, length: long>>"
)


def _measured(texts: list[bytes], least: int) -> list[tuple]:
    """The measures of `NAMES` but the id, for each text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    stops = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)
    numbers: dict[bytes, int] = {}
    words, n_words, n_dup = [], [], []
    for t in texts:
        split = t.split()  # of bytes: at \x20 and \x09-\x0D only
        n_words.append(len(split))
        words += [numbers.setdefault(w, len(numbers)) for w in split]
        lines = [line for line in t.split(b"\n") if line.strip()]
        n_dup.append(len(lines) - len(set(lines)))
    of = np.repeat(np.arange(len(texts)), n_words)
    repeated = repeat_words(np.array(words, np.int64), of, len(texts))
    chars = np.bincount(text[~_CONTINUED[data] & ~_SPACE[data]], minlength=len(texts))
    symbols = np.bincount(text[_SYMBOL[data]], minlength=len(texts))
    low = high = np.zeros(0, np.int64)
    if len(data):
        starts = np.concatenate([[True], text[1:] != text[:-1]])
        depth = prefix_depths(data, text, np.repeat(stops, sizes))
        low, high = maximal_repeats(data, depth, starts, least)
    longest = np.zeros(len(texts), np.int64)
    np.maximum.at(longest, text[low], high - low)
    out = []
    edges = np.searchsorted(low, np.concatenate([[0], stops]))
    for k, size in enumerate(sizes.tolist()):
        a, b = union(low[edges[k] : edges[k + 1]], high[edges[k] : edges[k + 1]])
        spans = [{"start": int(x) - int(stops[k] - size), "length": int(y - x)} for x, y in zip(a, b, strict=True)]
        out.append((n_words[k], int(chars[k]), int(symbols[k]), n_dup[k], int(repeated[k]), int((b - a).sum()), size,
                    int(longest[k]), spans))
    return out


def _measure(least: int):
    kinds = [pa.int64()] * 9 + [pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(t or b"") for t in batch.column("text").cast(pa.binary()).to_pylist()]
            at = 0
            while at < batch.num_rows:
                end, total = at + 1, sizes[at]
                while end < batch.num_rows and total + sizes[end] <= GROUP_BYTES:
                    total, end = total + sizes[end], end + 1
                part = batch.slice(at, end - at)
                texts = [t or b"" for t in part.column("text").cast(pa.binary()).to_pylist()]
                rows = list(zip(*_measured(texts, least), strict=True))
                columns = [part.column("doc_id").to_pylist(), *rows]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=NAMES)
                at = end

    return measure


def repeated_spans(docs: DataFrame, least: int = MIN_REPEAT) -> DataFrame:
    """`doc_id`, the base counts, `covered` (bytes), `n_bytes`, `longest_repeat` and the repeated `spans` (bytes) of every text."""
    small_batches(docs.sparkSession)
    return pick(docs, "doc_id", "text").mapInArrow(_measure(least), DDL)


def judged(docs: DataFrame, most_covered: float = MAX_COVERED, longest: int = MAX_REPEAT, least: int = MIN_REPEAT) -> DataFrame:
    """`repeated_spans` with `base_failed` and `kept`."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    passes = (F.col("covered") <= most_covered * F.col("n_bytes")) & (F.col("longest_repeat") <= longest)
    return repeated_spans(docs, least).withColumn("base_failed", failed).withColumn("kept", ~failed & passes)


def repetition_report(docs: DataFrame) -> DataFrame:
    return judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered", "longest_repeat", F.size("spans").cast("long").alias("n_spans"),
    )
