"""Null ids, repeated ids and repeated rows: a third of the table and more."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from adpulse.llm import common, fingerprints, language, mixing, near_dedup, packing, suffix_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _text(word, n=60):
    return " ".join(f"{word}{k}" for k in range(n))


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], DOCS).repartition(4)


@pytest.mark.parametrize("kind", ["null ids", "equal rows", "one id"])
def test_a_mix_comes_near_its_target_whatever_the_ids(spark, kind):
    hot = {"null ids": lambda k: (None, _text(f"a{k}x", 100)), "equal rows": lambda k: (7, _text("a", 100)),
           "one id": lambda k: (7, _text(f"a{k}x", 100))}[kind]
    rows = [(*hot(k), "a") for k in range(400)] + [(1000 + k, _text(f"b{k}x", 100), "b") for k in range(400)]
    rows += [(2000 + k, _text(f"c{k}x", 100), "c") for k in range(400)]
    docs = _frame(spark, rows)
    found = docs.sparkSession.createDataFrame(mixing.mix_report(docs, share=1.3).collect())
    by_source = found.groupBy("target").agg(F.sum("taken").alias("taken"), F.max("source_size").alias("size")).collect()
    for r in by_source:
        assert abs(r["taken"] - r["target"]) <= 0.12 * r["size"], kind
    again = mixing.mix_report(docs.repartition(7), share=1.3)
    assert Counter(map(tuple, again.collect())) == Counter(map(tuple, found.collect()))
    mixed = mixing.mixed(docs, share=1.3)
    taken = {t[0]: t[1] for t in mixed.groupBy("source").agg(F.count("*")).collect()}
    assert sum(taken.values()) * 100 == sum(r["taken"] for r in by_source)


def test_a_repeated_id_is_one_node(spark):
    a, b = _text("alpha"), _text("beta")
    rows = [(3, a, "s"), (5, a, "s"), (5, b, "s"), (7, b, "s"), (9, _text("gamma"), "s"), (5, "", "s")]
    found = {(r["doc_id"], r["n_shingles"] > 0): r for r in near_dedup.near_duplicates(_frame(spark, rows)).collect()}
    assert {k: r["component_id"] for k, r in found.items()} == {
        (3, True): 3, (5, True): 3, (7, True): 3, (9, True): 9, (5, False): 5,
    }
    assert not found[5, True]["kept"] and found[3, True]["kept"] and not found[7, True]["kept"]


def test_repeated_rows_are_spread_over_the_groups_of_packing(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_BYTES", 4000)
    rows = [(None, "the same text again", "s")] * 900 + [(k, _text(f"w{k}"), "s") for k in range(100)]
    found = packing.packed_sequences(_frame(spark, rows))
    per_group = found.groupBy(F.shiftright("sequence_id", packing.SEQUENCE_BITS).alias("g")).agg(
        F.sum(F.col("doc_id").isNull().cast("int")).alias("n")
    )
    counts = [r["n"] for r in per_group.collect()]
    assert sum(counts) == 900 and len(counts) > 10 and max(counts) < 90


def test_documents_without_labels_pass_the_language_stage(spark):
    rows = [(1, "some text", None, "a", 9), (2, "123", None, "a", 3), (3, None, None, "a", 0), (4, "mehr Text", None, "a", 9)]
    docs = spark.createDataFrame(rows, DOCS)
    assert language.fit(docs) is None
    kept = language.keep_known(docs, language.fit(docs)).collect()
    assert sorted((r["doc_id"], r["lang"]) for r in kept) == [(1, None), (4, None)]


def test_a_null_language_becomes_the_predicted_one(spark, small_docs):
    decoder = language.fit(small_docs)
    unnamed = small_docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, F.col("lang")))
    kept = {r["doc_id"]: r["lang"] for r in language.keep_known(unnamed, decoder).collect()}
    want = {r["doc_id"]: r["lang_pred"] for r in language.identify(small_docs, decoder).collect()}
    given = {r["doc_id"]: r["lang"] for r in unnamed.collect()}
    assert kept == {d: given[d] or want[d] for d in want if want[d] != language.UNKNOWN}


def test_a_text_whose_language_cannot_be_told_goes(spark):
    words = {"en": "the house and this water with what they think", "de": "das Haus und der Wald auch nicht für",
             "fr": "la maison est où les élèves vont à l'école"}
    texts = [(n, " ".join(w.split()[(k * j + j) % 8] for j in range(30))) for n, w in words.items() for k in range(60)]
    rows = [(at, t, n, "a", len(t)) for at, (n, t) in enumerate(texts)]
    rows += [(900, texts[0][1], "de", "a", 0), (901, texts[70][1], "en", "a", 0), (902, texts[130][1], "zz", "a", 0)]
    rows += [(903, texts[130][1], None, "a", 0), (904, "Xq", "en", "a", 2), (905, "Xq", None, "a", 2), (906, "Xq", "zz", "a", 2)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    decoder = language.fit(docs.filter("doc_id < 900"))
    assert decoder.trusted.all()
    said = {r["doc_id"]: r for r in language.identify(docs, decoder).collect()}
    kept = {r["doc_id"]: r["lang"] for r in language.keep_known(docs, decoder).collect()}
    assert [kept.get(d) for d in (900, 901, 902, 903)] == [None, None, "zz", "fr"]
    assert said[904]["ambiguous"] and 905 not in kept and (kept[904], kept[906]) == ("en", "zz")
    assert {d: n for d, n in kept.items() if d < 900} == {at: n for at, (n, _) in enumerate(texts)}
    # Languages learned from few documents are not trusted: what their rows state stands.
    few = language.fit(docs.filter("doc_id < 900 and doc_id % 60 < 5"))
    assert not few.trusted.any()
    assert language.keep_known(docs, few).count() == len(rows)


def test_intermediate_tables_go_once_their_results_are_written(spark, small_docs):
    before = common.staged_folders()
    near = near_dedup.near_duplicates(small_docs)
    left = common.staged_folders() - before
    assert not {f.rsplit("-", 1)[0] for f in left} & {"near_links", "near_nodes", "near_chunks", "near_several"}
    assert near.count() == small_docs.count()
    before = common.staged_folders()
    cut = suffix_dedup.repeated_spans(small_docs)
    left = {f.rsplit("-", 1)[0] for f in common.staged_folders() - before}
    assert left == {"suffix_texts", "suffix_spans"} and cut.count() == small_docs.count()


@pytest.mark.parametrize("kind", ["null ids", "one id", "equal rows"])
def test_a_hot_id_is_dealt_to_several_blocks_of_fingerprints(spark, kind):
    hot = {"null ids": lambda k: (None, f"hot text number {k}"), "one id": lambda k: (500, f"hot text number {k}"),
           "equal rows": lambda k: (500, "hot text")}[kind]
    rows = [hot(k) for k in range(600)] + [(k, f"other text {k}") for k in range(600) if k != 500]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    dealt = fingerprints._dealt(docs, 32).groupBy("block").agg(F.count("*").alias("n"), F.min("key"), F.max("key")).collect()
    assert sum(r["n"] for r in dealt) == len(rows) and max(r["n"] for r in dealt) < 150
    ends = sorted((r["block"], r[2], r[3]) for r in dealt)
    assert all(a[2] <= b[1] for a, b in zip(ends, ends[1:]))  # blocks ascend with the ids
    found = fingerprints.fingerprints(docs).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(i for i, _ in rows)
    # Every text is the next one of exactly one document: the edited texts are halves of neighbours in one cycle.
    tails = Counter(t for _, t in rows)
    order = defaultdict(Counter)
    for r in found:
        order[r["doc_id"]][r["edited_sha256"]] += 1
    singles = sorted((i for i, _ in rows if i is not None and i != 500), reverse=True)
    text = dict((i, t) for i, t in rows if i is not None and i != 500)
    for a, b in zip(singles, singles[1:]):
        if not (kind != "null ids" and a > 500 > b):
            edited = text[a][: len(text[a]) - len(text[a]) // 2] + text[b][: len(text[a]) // 2]
            assert order[a][hashlib.sha256(edited.encode()).hexdigest()] == 1
    assert sum(tails.values()) == len(found)
