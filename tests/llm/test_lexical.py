"""Operator 13 against brute force: ranks, ties, exact sums, blocks of items."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from adpulse.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def _terms(text):
    return TERM.findall((text or "").translate(LOWER))


def _brute(items, docs, k=20):
    counted = [(d, Counter(_terms(t))) for d, t in docs if _terms(t)]
    N, L = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in counted:
            m = 75 + 25 * c.total() * N // L
            score = 0
            for t in _terms(text):
                w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def _rows(found):
    return sorted((tuple(r) for r in found.collect()), key=repr)


ITEMS = [
    (1, "Alpha5 alpha7 ALPHA7 one"), (2, None), (3, ""), (4, "---"), (5, "nowhere"), (6, "äöü ÄÖÜ"),
    (1, "Alpha5 alpha7 ALPHA7 one"), (None, "word1x1 word2x2"), (7, "ab " * 2000),
]


def test_edges_equal_brute_force(spark, edge_docs, clashing_docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = _brute(ITEMS, [(r["doc_id"], r["text"]) for r in edge_docs.collect()])
    assert _rows(lexical.ranked(items, edge_docs)) == want and len(want) > 10
    clash = items.selectExpr("*", "1 as TEXT", "2 as rank", "3 as item_key", "4 as doc_id")
    assert _rows(lexical.ranked(clash, clashing_docs)) == want
    assert lexical.ranked(items, no_docs).count() == 0
    empty = lexical.ranked(items.filter("false"), edge_docs)
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_blocks_of_items_give_the_same_ranks(spark, small_docs, monkeypatch):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = _rows(lexical.ranked(items, small_docs))
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(lexical, "ITEM_TILE", 3)
    assert _rows(lexical.ranked(items, small_docs)) == whole
    assert whole == _brute([tuple(r) for r in items.collect()], [(r["doc_id"], r["text"]) for r in small_docs.collect()])


def test_ties_take_the_smallest_ids_however_rows_lie(spark):
    docs = [(k, "same words here") for k in range(1500)] + [(None, "same words here")] + [(k, f"other{k}") for k in range(2000, 5000)]
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    for parts in (1, 7):
        frame = spark.createDataFrame(docs[::-1], "doc_id long, text string").repartition(parts)
        assert [r["doc_id"] for r in lexical.ranked(items, frame).orderBy("rank").collect()] == list(range(20))


def test_partial_sums_stay_exact():
    rng = np.random.default_rng(2)
    weights = rng.integers(0, 1 << 34, (5, 40))
    weights[0, 3] = 1 << 40  # heavier than a tile may be
    weights[:, 5] = (1 << 53) // lexical.MOST_IMPACT
    tiles = lexical.vocabulary_tiles(weights)
    total = np.zeros_like(weights)
    for columns, part in tiles:
        assert part.sum(axis=1).max() * lexical.MOST_IMPACT < 1 << 53 and len(set(columns.tolist())) == len(columns)
        total[:, columns] += part.astype(np.int64)
    assert (total == weights).all() and len(tiles) > 2


@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_terms_of_long_texts(monkeypatch, piece):
    monkeypatch.setattr(lexical, "PIECE", piece)
    text = "Aé9 b--C  " * 5000 + "x" * 100
    assert lexical.term_counts(text.encode()) == Counter(t.encode() for t in _terms(text))
