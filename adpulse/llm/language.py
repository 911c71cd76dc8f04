"""Operator 5: language identification by error-correcting output codes.

Every learned language has a codeword; a binary linear classifier over hashed byte
n-grams predicts each bit. A text's margins are decoded to the codeword of the
least loss, where a bit's exponential loss is weighted by how much better than
chance its classifier did on documents left out of its fit. A text whose two best
codewords are close is flagged ambiguous.

The fit takes a sample of labelled documents of at most about `PER_LANGUAGE` rows
per language and `MOST_ROWS` in all, chosen by a hash of doc_id and text among those that are not
held out (crc32(doc_id) mod 5 is not 0); equal rows count once. The driver holds 32 KB a row, and solves in the
rows or in the `BINS` features, whichever are fewer. Predictions take the whole text and nothing else.

A null text, or one without a letter, is `und` with score 0 (so is every text if
nothing could be learned). Rows that repeat a doc_id are predicted one by one. Rows
with a null doc_id count as the empty id. Very long texts are read whole, piece by piece; empty tables give no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import fold, pick, scrambled, small_batches

PER_LANGUAGE = 400
MOST_ROWS = 16_384
BINS = 1 << 13
RIDGE = 0.02
#: Two codewords are close if their shares of the summed likelihood differ by less.
AMBIGUOUS = 0.2
#: A language is trusted if so many of its left-out documents are named rightly and without a close second
#: (rule of succession: right + 1 of all + 2, so a handful of documents is never enough).
TRUSTED = 0.9
#: The least share with which a prediction overrules the language that a row states.
SURE = 0.99
PIECE = 1 << 20
UNKNOWN = "und"
_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32


def features(data: bytes) -> np.ndarray:
    """Square roots of the shares of the hashed byte pairs and triples, scaled to length 1; zeros without any."""
    counts = np.zeros(BINS)
    whole = np.frombuffer(data, np.uint8)
    for low in range(0, len(whole), PIECE):
        part = _LOWER[whole[low : low + PIECE + 2]]
        pairs = part[:-1] * np.uint32(256) + part[1:]
        triples = pairs[:-1] * np.uint32(256) + part[2:]
        for grams, salt in ((pairs[:PIECE], 0x9E3779B1), (triples[:PIECE], 0x85EBCA6B)):
            counts += np.bincount((grams * np.uint32(salt)) >> np.uint32(19), minlength=BINS)
    roots = np.sqrt(counts)
    norm = np.linalg.norm(roots)
    return roots / norm if norm else roots


def codewords(n: int) -> np.ndarray:
    """A row of +1 and -1 per language: all non-trivial splits for few languages, else scrambled ones."""
    if n <= 6:
        return np.array([[1, *rest] for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]).T.reshape(n, -1)
    bits = int(np.ceil(12 * np.log2(n)))
    code = np.where(scrambled(n * bits, 51).reshape(n, bits) >> np.uint64(63), 1, -1)
    return code[:, np.abs(code.sum(0)) < n]


class Decoder:
    """Binary classifiers, bit weights and codewords."""

    def __init__(self, languages: list[str], x: np.ndarray, labels: np.ndarray) -> None:
        self.languages, self.code = languages, codewords(len(languages))
        n, bits = len(x), self.code.shape[1]
        self.weights, self.bit_weights, self.sharpness = np.zeros((BINS, bits)), np.ones(bits), 1.0
        self.trusted = np.zeros(len(languages), bool)
        if not bits:
            return
        targets = self.code[labels].astype(float)
        share = np.bincount(labels, minlength=len(languages))[labels]
        scale = np.sqrt(n / (len(languages) * share))[:, None]
        x *= scale.astype(x.dtype)  # in place: the sample is the largest thing on the driver
        ridge = RIDGE * n / len(languages) / 10
        # Beside the weights, what each classifier says of a document that it was not fitted on, in closed form.
        if n <= BINS:
            inverse = (x @ x.T).astype(np.float64)
            inverse[np.diag_indices(n)] += ridge
            inverse = np.linalg.inv(inverse)
            duals = inverse @ (targets * scale)
            self.weights = (x.T @ duals.astype(x.dtype)).astype(np.float64)
            missed = duals / np.diag(inverse)[:, None]
        else:
            inverse = (x.T @ x).astype(np.float64)
            inverse[np.diag_indices(BINS)] += ridge
            inverse = np.linalg.inv(inverse).astype(x.dtype)
            self.weights = (inverse @ (x.T @ (targets * scale).astype(x.dtype))).astype(np.float64)
            said = x @ self.weights.astype(x.dtype)
            reach = np.concatenate([((p @ inverse) * p).sum(axis=1) for p in np.array_split(x, -(-n // 1024))])
            missed = (targets * scale - said) / (1 - reach)[:, None]
        left_out = targets - missed / scale
        right = (np.sign(left_out) == targets).mean(axis=0)
        self.bit_weights = np.maximum(2 * right - 1, 0.01)
        self.bit_weights /= self.bit_weights.sum()
        best = -np.inf
        for sharpness in (1, 2, 4, 8, 16, 32):
            shares = self._shares(left_out, sharpness)
            fit = np.log(np.maximum(shares[np.arange(n), labels], 1e-12)).mean()
            if fit > best:
                best, self.sharpness = fit, sharpness
        found, _, close = self._nearest(left_out)
        right = np.bincount(labels[(found == labels) & ~close], minlength=len(languages))
        self.trusted = (right + 1) / (np.bincount(labels, minlength=len(languages)) + 2) >= TRUSTED

    def _shares(self, margins: np.ndarray, sharpness: float) -> np.ndarray:
        loss = np.einsum("nlb,b->nl", np.exp(-margins[:, None, :].clip(-3, 3) * self.code[None]), self.bit_weights)
        likely = np.exp(-sharpness * (loss - loss.min(axis=1, keepdims=True)))
        return likely / likely.sum(axis=1, keepdims=True)

    def _nearest(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shares = self._shares(margins, self.sharpness)
        ordered = np.sort(shares, axis=1)
        return shares.argmax(axis=1), ordered[:, -1], ordered[:, -1] - ordered[:, -2] < AMBIGUOUS

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest codeword, its share, and whether the second is close."""
        if len(self.languages) == 1:
            return np.zeros(len(x), int), np.ones(len(x)), np.zeros(len(x), bool)
        return self._nearest(x @ self.weights)


def _sampled(docs: DataFrame) -> DataFrame:
    """Labelled documents of the learning folds, about PER_LANGUAGE of each language at most."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id")) != 0))
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    # One row per language.
    held = {r["lang"]: r["n"] for r in counts.toLocalIterator()}
    wanted = min(PER_LANGUAGE, max(1, MOST_ROWS // max(1, len(held))))
    shares = {lang: min(1.0, wanted / n) for lang, n in held.items()}
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(5), "doc_id", "text"), 11).cast("double") / F.lit(float(1 << 53))
    if not shares:
        return labelled.filter("false")
    keep = F.element_at(F.create_map(*[F.lit(v) for pair in shares.items() for v in pair]), F.col("lang"))
    return labelled.filter(draw < keep).dropDuplicates(["doc_id", "lang", "text"])


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(t).astype(np.float16).tobytes() for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("lang"), pa.array(rows, pa.binary())], names=["doc_id", "lang", "x"]
        )


def fit(docs: DataFrame) -> Decoder | None:
    """The decoder learned from `docs` (`doc_id`, `text`, `lang`); None without labelled text."""
    small_batches(docs.sparkSession)
    docs = pick(docs, "doc_id", "text", "lang").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = _sampled(docs).mapInArrow(_sample_features, "doc_id long, lang string, x binary").collect()
    rows = sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["lang"], bytes(r["x"])))
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return None
    labels = np.array([languages.index(r["lang"]) for r in rows])
    x = np.empty((len(rows), BINS), np.float32)
    for at in reversed(range(len(rows))):
        x[at] = np.frombuffer(rows.pop()["x"], np.float16)
    return Decoder(languages, x, labels)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _predicted(decoder: Decoder | None):
    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            known = np.array([decoder is not None and has_letter(t) for t in texts], bool)
            language = [UNKNOWN] * len(texts)
            score, close = np.zeros(len(texts)), ~known
            at = np.flatnonzero(known)
            if len(at):
                found, share, near = decoder.decode(np.array([features(texts[i].encode()) for i in at]))
                for i, k in zip(at, found, strict=True):
                    language[i] = decoder.languages[k]
                score[at], close[at] = share, near
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(language), pa.array(score), pa.array(close)],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

    return predicted


def identify(docs: DataFrame, decoder: Decoder | None) -> DataFrame:
    """`doc_id`, `held_out`, `lang_pred`, `score`, `ambiguous` for every row of `docs` (`doc_id`, `text`)."""
    small_batches(docs.sparkSession)
    texts = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = texts.mapInArrow(_predicted(decoder), "doc_id long, lang_pred string, score double, ambiguous boolean")
    return rows.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score", "ambiguous")


def _accepted(decoder: Decoder | None, names: list[str], text: str, lang: str):
    def accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {} if decoder is None else {name: k for k, name in enumerate(decoder.languages)}
        for batch in batches:
            kept = batch.filter(pa.array([has_letter(t) for t in batch.column(text).to_pylist()], pa.bool_()))
            if not kept.num_rows:
                continue
            if decoder is not None:
                found, share, close = decoder.decode(np.array([features(t.encode()) for t in kept.column(text).to_pylist()]))
                stated = kept.column(lang).to_pylist()
                claimed = [k if name is None else number.get(name) for name, k in zip(stated, found, strict=True)]
                stays = [
                    c is None or not decoder.trusted[c] or not (near if name is None else k != c and sure >= SURE)
                    for name, c, k, near, sure in zip(stated, claimed, found, close, share, strict=True)
                ]
                languages = [decoder.languages[k] if name is None else name for name, k in zip(stated, found, strict=True)]
                columns = dict(zip(names, kept.columns, strict=True)) | {lang: pa.array(languages, pa.string())}
                kept = pa.RecordBatch.from_arrays(list(columns.values()), names=names).filter(pa.array(stays, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns, names=names)

    return accepted


def keep_known(docs: DataFrame, decoder: Decoder | None) -> DataFrame:
    """The rows of `docs` whose language can be told, with their columns; a null `lang` becomes the decoder's prediction.

    Null texts and texts without a letter (`und`) go. Every other text is decoded, and goes where the decoder is
    sure (`SURE`) of another language than the row's `lang`, or, where that is null, a second codeword is close. It judges trusted languages only (`TRUSTED`, by documents left out of the fit); a `lang` that was not
    learned, or from too few documents, stands. Where no row is labelled there is no decoder: nothing is predicted, and
    every text with a letter stays.
    """
    small_batches(docs.sparkSession)
    names = [f"c{at}" for at in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text, lang = (names[docs.columns.index(name)] for name in ("text", "lang"))
    return plain.mapInArrow(_accepted(decoder, names, text, lang), plain.schema).toDF(*docs.columns)
