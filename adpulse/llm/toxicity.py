"""Operator 7: toxicity by compression with two zstandard dictionaries.

Two dictionaries are built from sampled labelled documents, as raw content: they are not
trained by zstandard, which measured worse (README). Word beginnings that far
more toxic than ordinary documents hold are grown to the longest form that nearly
all of them share; these forms make up the toxic part. The ordinary dictionary holds
what the same letters look like in ordinary text: the forms' three-byte pieces, and
their beginnings that are not toxic. The toxic dictionary is the ordinary one with
the forms behind it, so that a window of a text compresses alike with both unless it
holds a toxic form. The gain of every window (bytes with the ordinary dictionary
less bytes with the toxic one) is a feature; a logistic calibration over the gains
of a document's windows, fitted on the same sample, gives its score.

The sample is at most about `PER_CLASS` documents of each label, chosen by a hash of
doc_id and text among documents that are not held out, of at most `SAMPLE_BYTES` bytes each; equal rows count once.
Scores see whole texts, window by window, and nothing else.

A null or empty text has no windows and gets the calibrated score of a text without
gains. Where one label has no example, all scores are 0 (or 1 if all are toxic).
Rows that repeat a doc_id are scored one by one; a doc_id labelled twice is toxic if
one label says so. Very long texts are scored whole, empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import fold, pick, scrambled, small_batches

PER_CLASS = 1000
SAMPLE_BYTES = 1 << 16
WINDOW = 96
STEP = 80
WIDTH = 2
SHORTEST = 3
#: A beginning is toxic if this many times as frequent (plus DOUBT documents) among toxic documents, and in LEAST of them.
TIMES, DOUBT, LEAST = 10, 3, 3
#: A form grows while the longer one occurs in this share of the shorter one's documents.
SAME = 0.8
GAP = b"\x00"
_CODES = scrambled(256, 77).view(np.uint8).reshape(256, 8)[:, :WIDTH]
_WORDS = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def frequent_beginnings(toxic: list[bytes], ordinary: list[bytes]) -> tuple[Counter[bytes], Counter[bytes]]:
    """Word beginnings from SHORTEST bytes on that LEAST toxic documents hold: in how many toxic and ordinary ones.

    Byte by byte, as long as some beginning is that frequent: a longer one can be so only if the shorter one is.
    """
    toxic_words, ordinary_words = ([set(_WORDS.findall(data)) for data in docs] for docs in (toxic, ordinary))
    count: Counter[bytes] = Counter()
    normal: Counter[bytes] = Counter()
    size = SHORTEST
    while toxic_words:
        here = Counter(p for words in toxic_words for p in {w[:size] for w in words if len(w) >= size})
        here = Counter({p: n for p, n in here.items() if n >= LEAST})
        count.update(here)
        toxic_words, ordinary_words = (
            [kept for words in held if (kept := {w for w in words if w[:size] in here})] for held in (toxic_words, ordinary_words)
        )
        normal.update(p for words in ordinary_words for p in {w[:size] for w in words})
        size += 1
    return count, normal


def toxic_forms(toxic: list[bytes], ordinary: list[bytes]) -> tuple[list[bytes], set[bytes]]:
    """Forms, rarest first, and all toxic beginnings. Equal documents count once."""
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    count, normal = frequent_beginnings(toxic, ordinary)
    odds = TIMES * len(toxic) / len(ordinary)
    found = {p for p, n in count.items() if n >= odds * (normal[p] + DOUBT)}
    longer: dict[bytes, list[bytes]] = {}
    for p in found:
        longer.setdefault(p[:-1], []).append(p)
    forms = []
    for form in (p for p in found if p[:-1] not in found):
        n = count[form]
        while more := [p for p in longer.get(form, []) if count[p] >= SAME * count[form]]:
            form = max(more, key=lambda p: (count[p], p))
        forms.append((n, form))
    return [form for _, form in sorted(forms)], found


def recoded(data: bytes) -> bytes:
    return _CODES[np.frombuffer(data, np.uint8)].tobytes()


def ordinary_pieces(forms: list[bytes], found: set[bytes], ordinary: list[bytes]) -> list[bytes]:
    """What ordinary text has of the forms, short pieces first."""
    text = b" ".join(ordinary)
    pieces: set[bytes] = set()
    for form in forms:
        word = b" " + form
        pieces |= {word[at : at + 3] for at in range(len(word) - 2)}
        pieces |= {b" " + form[:n] for n in range(3, len(form)) if form[:n] not in found}
        for at in range(len(word)):
            for end in range(len(word), at + 3, -1):
                if word[at:end].lstrip() not in found and word[at:end] in text:
                    pieces.add(word[at:end])
                    break
    return sorted(pieces, key=lambda p: (len(p), p))


class Scorer:
    """Two dictionaries and a calibration."""

    def __init__(self, toxic: list[bytes], ordinary: list[bytes]) -> None:
        self.constant = None if toxic and ordinary else float(bool(toxic))
        self.compressors = None
        if self.constant is not None:
            return
        forms, found = toxic_forms(toxic, ordinary)
        # Windows overlap by the longest form, so that each form lies whole in one of them.
        self.window = STEP + max(WINDOW - STEP, 1 + max(map(len, forms), default=0))
        pieces = ordinary_pieces(forms, found, ordinary)
        self.ordinary_part = recoded(GAP.join(pieces) + GAP)
        self.toxic_part = recoded(GAP.join(b" " + form for form in forms) + GAP)
        x = np.array([self.gains(data) for data in [*toxic, *ordinary]])
        y = np.array([1.0] * len(toxic) + [0.0] * len(ordinary))
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        x = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        # Labels in equal weight: 0.5 is the point of equal likelihood, however rare toxic documents are.
        weight = np.where(y == 1, 0.5 / len(toxic), 0.5 / len(ordinary)) * len(y)
        beta = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
            curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(beta))
            beta += np.linalg.solve(curve, x.T @ (weight * (y - p)) - 1e-2 * beta)
        self.beta = beta

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "compressors"} | {"compressors": None}

    def _ready(self):
        if self.compressors is None:
            # However many forms there are, the whole dictionary is within reach.
            log = (len(self.toxic_part) + len(self.ordinary_part)).bit_length()
            settings = zstandard.ZstdCompressionParameters(
                window_log=max(15, log + 1), hash_log=max(12, log), chain_log=max(12, log + 1), search_log=6, min_match=6, target_length=64,
                strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=False,
            )
            self.compressors = []
            for content in (self.ordinary_part, self.toxic_part + self.ordinary_part):
                kept = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                kept.precompute_compress(compression_params=settings)
                self.compressors.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=kept).compress)
        return self.compressors

    def gains(self, data: bytes) -> tuple[float, float, float, float]:
        """Mean positive gain, mean gain, share of windows that gain clearly, and the largest gain (its logarithm)."""
        plain, toxic = self._ready()
        data = recoded(b" " + data.lower())
        step, size = STEP * WIDTH, self.window * WIDTH
        windows = (data[at : at + size] for at in range(0, len(data), step))
        found = np.array([len(plain(w)) - len(toxic(w)) for w in windows])
        return found.clip(0).mean(), found.mean(), (found >= 2).mean(), np.log1p(max(found.max(), 0))

    def score(self, data: bytes) -> float:
        if self.constant is not None:
            return self.constant
        x = np.append((np.array(self.gains(data)) - self.mean) / self.scale, 1.0)
        return float(1 / (1 + np.exp(-np.clip(x @ self.beta, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame) -> Scorer:
    """The scorer learned from `docs` (`doc_id`, `text`) and `labels` (`doc_id`, `toxic`)."""
    known = pick(labels, "doc_id", "toxic").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
    known = known.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    texts = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = texts.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") <= SAMPLE_BYTES) & (fold(F.col("doc_id")) != 0))
    per_label = texts.select("doc_id").join(known, "doc_id").groupBy("toxic").agg(F.count("*").alias("n"))
    counts = {r["toxic"]: r["n"] for r in per_label.collect()}  # two rows
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id", "text"), 11).cast("double") / F.lit(float(1 << 53))
    share = F.when(F.col("toxic") == 1, PER_CLASS / max(1, counts.get(1, 0))).otherwise(PER_CLASS / max(1, counts.get(0, 0)))
    most = PER_CLASS / max(1, min(counts.values(), default=1))
    drawn = texts.withColumn("draw", draw).filter(F.col("draw") < most)
    rows = drawn.join(known, "doc_id").filter(F.col("draw") < share).dropDuplicates(["doc_id", "text"])
    rows = rows.select("doc_id", "toxic", "text").collect()  # the bounded sample
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    sample = {k: [r["text"].encode().lower() for r in rows if r["toxic"] == k] for k in (0, 1)}
    return Scorer(sample[1], sample[0])


def _scored(scorer: Scorer):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([scorer.score(t or b"") for t in texts], pa.float64())],
                names=["doc_id", "score"],
            )

    return scored


def toxicity(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` for every row of `docs` (`doc_id`, `text`)."""
    small_batches(docs.sparkSession)
    texts = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = texts.mapInArrow(_scored(scorer), "doc_id long, score double")
    return rows.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
