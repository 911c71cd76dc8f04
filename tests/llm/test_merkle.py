"""Operator 12: the manifest, single and octopus proofs, tampering, hot sources."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from adpulse.llm import merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def H(text):
    return sha256(text.encode()).hexdigest()


def _leaf(row):
    out = ""
    for value in (row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]):
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return H(out)


def _levels(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][k : k + 3])) for k in range(0, len(levels[-1]), 3)])
    return levels


def _sides(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = nodes[at // 3 * 3 : at // 3 * 3 + 3]
        out.append(("".join(run[: at % 3]), "".join(run[at % 3 + 1 :])))
        at //= 3
    return out


def _brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    for held in by_source.values():
        held.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, _leaf(r)))
    trees = {s: _levels([_leaf(r) for r in by_source[s]]) for s in order}
    top = _levels([trees[s][-1][0] for s in order])
    out = []
    for place, s in enumerate(order):
        for at, r in enumerate(by_source[s]):
            path = _sides(trees[s], at) + _sides(top, place)
            changed = dict(r)
            if r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                changed["text"] = r["text"].replace("\n", "")
            end = _leaf(changed)
            for left, right in path:
                end = H(left + end + right)
            proof = H("".join(a + b for a, b in path))
            out.append((r["doc_id"], _leaf(r), trees[s][-1][0], top[-1][0], proof, end, end == top[-1][0]))
    return out


def _rows(found):
    return sorted((tuple(r)[:7] for r in found), key=repr)


def _check(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    assert _rows(merkle.proof_report(docs).collect()) == _rows(_brute([r.asDict() for r in docs.collect()]))


def test_edges_equal_brute_force(edge_docs, clashing_docs, no_docs):
    want = _rows(_brute([r.asDict() for r in edge_docs.collect()]))
    assert _rows(merkle.proof_report(edge_docs).collect()) == want
    assert _rows(merkle.proof_report(clashing_docs).collect()) == want
    empty = merkle.proof_report(no_docs)
    assert empty.count() == 0 and empty.columns == merkle.proof_report(edge_docs).columns


def test_tree_shapes(spark):
    """Sources of 1 to 28 leaves, and top trees of 7, 28 and 1 subroots."""
    sizes = [1, 2, 3, 4, 9, 10, 28]
    _check(spark, [(100 * n + k, f"s{n}", "en", k, f"a\n{k}") for n in sizes for k in range(n)])
    _check(spark, [(k, f"s{k}", "en", k, f"a\n{k}") for k in range(28)])
    _check(spark, [(2, "s", "en", 1, "a\nb")])


def test_several_passes_and_repeated_rows(spark):
    """Small chunks: a hot source of several passes, a third of its rows equal, beside small and null sources."""
    rows = [(7, "hot", "en", 3, "x\ny")] * 60 + [(k, "hot", "en", 1, f"t\n{k}") for k in range(120)]
    rows += [(k, None, None, None, None) for k in range(3)] + [(None, "é", "en", 2, "z\n")] + [(5, "a", "en", 1, "")]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    want = _rows(_brute([r.asDict() for r in docs.collect()]))
    for levels in (1, 2):
        assert _rows(merkle.proofs(merkle.manifest(docs, chunk_levels=levels)).collect()) == want


def test_missing_nodes_are_the_fewest():
    """Dropping any of the missing nodes leaves some node underivable; with all of them the root follows."""
    rng = random.Random(3)
    for _ in range(60):
        size = rng.randint(1, 90)
        levels = _levels([H(str(k)) for k in range(size)])
        held = rng.sample(range(size), rng.randint(1, size))
        asked = list(merkle.missing(held, size))
        fetched = {c: levels[c[0]][c[1]] for c in asked}
        tree = merkle.PartialTree(size, {k: levels[0][k] for k in held}, fetched)
        assert tree.root == levels[-1][0] and len(set(asked)) == len(asked)
        for k in held:
            assert merkle.folded(levels[0][k], tree.path(k)) == tree.root
        for c in asked:
            with pytest.raises(KeyError):
                merkle.PartialTree(size, {k: levels[0][k] for k in held}, {k: v for k, v in fetched.items() if k != c})


def test_proofs_of_some_leaves_are_those_of_all(spark, small_docs):
    made = merkle.manifest(small_docs)
    every = {r["doc_id"]: r for r in merkle.proofs(made).collect()}
    some = merkle.proofs(made, lambda leaves: leaves.filter(F.col("doc_id") % 7 == 0), siblings=True).collect()
    assert {r["doc_id"] for r in some} == {d for d in every if d % 7 == 0}
    for r in some:
        assert tuple(r)[:7] == tuple(every[r["doc_id"]]) and H("".join(r["siblings"])) == r["proof_sha256"]
        assert all(len(s) == 64 for s in r["siblings"])
