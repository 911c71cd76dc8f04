"""Operator 13: ranked lexical search by dense blocked matrix products.

The items are a stated query set; all documents are ranked for each of them.

1. Items are dealt by a hash of their text to blocks of about `BLOCK_BYTES`; a block's vocabulary, the
   distinct terms of its items, is all that is sent to the tasks.
2. One pass over the texts counts each document's terms and writes its counts of vocabulary terms, a few
   percent of the text. The corpus figures (documents N, terms L, documents per term df) are sums over it.
3. Scores are products of two dense float64 matrices: a tile of items (`ITEM_TILE`) over the compact
   vocabulary of just these items, times a tile of documents (`DOC_TILE`) with their impacts. All entries
   are whole numbers, and a vocabulary tile ends before any item's partial sum could reach 2**53, so that
   BLAS sums exactly in any order; tiles are added as 64-bit integers.
4. Each task keeps an item's `k` best documents. A tile is cut at its k-th score with all ties, then by
   doc_id, so the cut never depends on the order of rows. Tasks' lists are merged by groups of tasks first,
   then by item.

Term: maximal match of `[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`, A-Z lower-cased. With n terms in
the document, m = 75 + (25 * n * N) div L; a term found tf times has the impact
(10**9 * tf) div (1000 * tf + 12 * m) and the weight floor(1000 * ln((2 * N + 2) / (2 * df + 1))).

Null and empty texts have no terms: such a document is not counted in N and never returned, such an item
returns nothing. Long texts are read in pieces that end between terms. Equal scores rank by ascending
doc_id, null ids last; rows that repeat a doc_id are documents of their own. Each row of `items` gets its
own ranks, rows with equal texts the same ones. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import pick, small_batches, staged

TOP = 20
BLOCK_BYTES = 16 << 20
ITEM_TILE = 64
DOC_TILE = 512
PIECE = 1 << 20
MERGE_GROUPS = 64
#: The largest impact: (10**9 * tf) div (1000 * tf + 12 * m) stays below it for any tf and m >= 75.
MOST_IMPACT = 1_000_000
EXACT = 1 << 53

#: Separators become blanks, A-Z becomes a-z; bytes from 0x80 on belong to terms.
_TABLE = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() and b < 0x80 else b if b >= 0x80 else 0x20 for b in range(256)
)


def term_counts(data: bytes) -> Counter:
    """Occurrences of every term of the text; a long text is read piece by piece."""
    plain, found, at = data.translate(_TABLE), Counter(), 0
    while at < len(plain):
        end = plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        found.update(plain[at:end].split())
        at = end
    return found


def weight(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


POSTING_DDL = "doc_id long, n long, ids array<int>, counts array<int>"


def _count(vocabulary: dict[bytes, int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, ns, ids, counts = [], [], [], []
            for doc_id, data in zip(
                batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True
            ):
                found = term_counts(data)
                if found:
                    held = [(vocabulary[t], c) for t, c in found.items() if t in vocabulary]
                    doc_ids.append(doc_id)
                    ns.append(found.total())
                    ids.append([i for i, _ in held])
                    counts.append([c for _, c in held])
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int32()))],
                names=["doc_id", "n", "ids", "counts"],
            )

    return count


def vocabulary_tiles(weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(columns, their weights) of the tiles of an items x terms matrix of whole numbers.

    Within a tile the weights of an item sum to less than 2**53 / `MOST_IMPACT`, so its products with impacts
    are exact in float64. A column that is too heavy alone is split into parts that sum to it.
    """
    limit = (EXACT - 1) // MOST_IMPACT
    columns: list[tuple[int, np.ndarray]] = []
    for c in range(weights.shape[1]):
        left = weights[:, c]
        while left.max(initial=0) > limit:
            part = np.minimum(left, limit)
            columns.append((c, part))
            left = left - part
        columns.append((c, left))
    tiles, held, total = [], [], np.zeros(len(weights), np.int64)
    for c, column in columns:
        if held and (total + column).max(initial=0) > limit:
            tiles.append(held)
            held, total = [], np.zeros(len(weights), np.int64)
        held.append((c, column))
        total = total + column
    if held:
        tiles.append(held)
    return [(np.array([c for c, _ in t]), np.stack([w for _, w in t], axis=1).astype(np.float64)) for t in tiles]


class ItemTile:
    """Some items over the compact vocabulary of their own terms."""

    def __init__(self, first: int, queries: list[dict[int, int]], weights: np.ndarray):
        terms = np.array(sorted(set().union(*queries)), np.int64)
        column = {t: c for c, t in enumerate(terms.tolist())}
        dense = np.zeros((len(queries), len(terms)), np.int64)
        for row, query in enumerate(queries):
            for term, times in query.items():
                dense[row, column[term]] = times * int(weights[term])
        self.rows = slice(first, first + len(queries))
        self.column = np.full(len(weights), -1, np.int64)
        self.column[terms] = np.arange(len(terms))
        self.n_terms = len(terms)
        self.parts = vocabulary_tiles(dense)

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        """Items x documents; exact 64-bit integers."""
        at = self.column[term]
        held = at >= 0
        dense = np.zeros((self.n_terms, n_docs))
        dense[at[held], doc[held]] = impact[held]
        total = np.zeros((self.rows.stop - self.rows.start, n_docs), np.int64)
        for columns, weights in self.parts:
            total += (weights @ dense[columns]).astype(np.int64)
        return total


class Best:
    """The `k` best (score, doc_id) of each item so far; null ids (flag 1) rank last among equal scores."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.score = [np.zeros(0, np.int64)] * n_items
        self.null = [np.zeros(0, bool)] * n_items
        self.doc = [np.zeros(0, np.int64)] * n_items

    def add(self, first: int, scores: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        least = self.least[first : first + len(scores)]
        if scores.shape[1] > self.k:  # below its own k-th score no document of the tile can be among the best
            least = np.maximum(least, np.partition(scores, -self.k, axis=1)[:, -self.k])
        row, at = np.nonzero(scores >= least[:, None])
        edges = np.searchsorted(row, np.arange(len(scores) + 1))
        for r in np.unique(row).tolist():
            item, new = first + r, at[edges[r] : edges[r + 1]]
            score = np.concatenate([self.score[item], scores[r, new]])
            ids, nulls = np.concatenate([self.doc[item], doc[new]]), np.concatenate([self.null[item], null[new]])
            order = np.lexsort((ids, nulls, -score))[: self.k]
            self.score[item], self.doc[item], self.null[item] = score[order], ids[order], nulls[order]
            if len(order) == self.k:
                self.least[item] = score[order[-1]]


def _score(tiles: list[ItemTile], keys: list[str], n_docs: int, n_terms: int, k: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, held, rows = Best(len(keys), k), [], 0

        def run() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            n = table.num_rows
            m = np.array([75 + 25 * x * n_docs // n_terms for x in table["n"].to_pylist()], np.int64)
            ids, counts = (table[c].combine_chunks() for c in ("ids", "counts"))
            doc = np.repeat(np.arange(n), np.diff(ids.offsets.to_numpy()))
            tf = counts.flatten().to_numpy().astype(np.int64)
            impact = (1_000_000_000 * tf // (1000 * tf + 12 * m[doc])).astype(np.float64)
            null = table["doc_id"].is_null().to_numpy()
            doc_id = table["doc_id"].fill_null(0).to_numpy()
            for tile in tiles:
                best.add(tile.rows.start, tile.scores(doc, ids.flatten().to_numpy(), impact, n), doc_id, null)

        for batch in batches:
            for at in range(0, batch.num_rows, DOC_TILE):
                held.append(batch.slice(at, DOC_TILE))
                rows += held[-1].num_rows
                if rows >= DOC_TILE:
                    run()
                    held, rows = [], 0
        if rows:
            run()
        for item, key in enumerate(keys):
            if len(best.score[item]):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([key] * len(best.score[item])),
                        pa.array(best.doc[item], mask=best.null[item]),
                        pa.array(best.score[item]),
                    ],
                    names=["item_key", "doc_id", "score"],
                )

    return score


def _best_of(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _block_ranks(docs: DataFrame, items: list[tuple[str, bytes]], k: int) -> DataFrame | None:
    """`item_key`, `doc_id`, `score`, `rank` for the items of one block; None where no document has a term."""
    counted = [(key, term_counts(text)) for key, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*[c for _, c in counted])))}
    postings = staged(docs.filter("text is not null").mapInArrow(_count(vocabulary), POSTING_DDL), "lexical_postings")
    n_docs, n_terms = postings.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    weights = np.full(len(vocabulary), weight(0, n_docs), np.int64)
    # One row per vocabulary term, which a block bounds.
    for term, df in postings.select(F.explode("ids").alias("term")).groupBy("term").count().collect():
        weights[term] = weight(df, n_docs)
    queries = [{vocabulary[t]: times for t, times in c.items()} for _, c in counted]
    tiles = [ItemTile(at, queries[at : at + ITEM_TILE], weights) for at in range(0, len(queries), ITEM_TILE)]
    scored = postings.mapInArrow(
        _score(tiles, [key for key, _ in items], n_docs, n_terms, k), "item_key string, doc_id long, score long"
    ).withColumn("part", F.spark_partition_id() % MERGE_GROUPS)
    return _best_of(_best_of(scored, k, "item_key", "part").drop("rank"), k, "item_key").drop("part")


def ranked(items: DataFrame, docs: DataFrame, k: int = TOP) -> DataFrame:
    """`item_id`, `rank` (from 1), `doc_id`, `score`: the `k` best documents with a score above 0 of each item."""
    spark = docs.sparkSession
    small_batches(spark)
    items, docs = pick(items, "item_id", "text"), pick(docs, "doc_id", "text")
    keyed = items.filter("text is not null").withColumn("item_key", F.sha2("text", 256))
    texts = keyed.groupBy("item_key").agg(F.first("text").alias("text"))
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = n_bytes // BLOCK_BYTES + 1
    found: DataFrame | None = None
    for block in range(n_blocks):
        held = texts.filter(F.pmod(F.xxhash64("item_key"), F.lit(n_blocks)) == block).collect()
        rows = sorted((r["item_key"], r["text"].encode()) for r in held)
        ranks = _block_ranks(docs, rows, k) if rows else None
        if ranks is not None:
            ranks = staged(ranks, "lexical_ranks")
            found = ranks if found is None else found.unionAll(ranks)
    if found is None:
        found = spark.createDataFrame([], "item_key string, doc_id long, score long, rank int")
    return keyed.select("item_id", "item_key").join(found, "item_key").select("item_id", "rank", "doc_id", "score")
