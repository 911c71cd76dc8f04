"""The pipeline's stages on rows whose ids are null, repeated or shared by different texts."""

import numpy as np

import corpus_pipeline
from adpulse.llm import near_dedup

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def _text(word, n=60):
    return " ".join(f"{word}{k}" for k in range(n))


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOCS).repartition(3)


def test_one_row_of_each_group_of_near_duplicates_stays(spark):
    alpha, beta, gamma = _text("alpha"), _text("beta"), _text("gamma")
    rows = [(1, alpha), (None, alpha), (2, beta), (2, beta), (2, beta), (None, gamma), (None, gamma)]
    rows += [(3, _text("delta")), (4, _text("delta")), (4, _text("only"))]
    kept = corpus_pipeline.stage_near_dedup(spark, _docs(spark, rows), "").collect()
    want = [(1, alpha), (2, beta), (3, _text("delta")), (4, _text("only")), (None, gamma)]
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=repr) == sorted(want, key=repr)


def test_one_copy_reaches_the_pack_stage(spark):
    alpha, beta = _text("alpha"), _text("beta")
    docs = _docs(spark, [(1, alpha), (None, alpha), (2, beta), (2, beta)])
    for _, stage in corpus_pipeline.STAGES[1:3]:
        docs = stage(spark, docs, "")
    assert sorted((r["doc_id"], r["text"]) for r in docs.collect()) == [(1, alpha), (2, beta)]
    packed = corpus_pipeline.stage_pack(spark, docs, "").collect()
    assert {r["doc_id"] for r in packed if r["doc_tokens"] > 1} == {1, 2}


def test_near_duplicates_link_from_80_percent_on(spark):
    words = [f"w{k}" for k in range(50)]  # 46 shingles; one changed word leaves 41 of 51 (0.804)
    changed = [*words[:25], "other", *words[26:]]
    short = [f"v{k}" for k in range(46)]  # 42 shingles; one changed word leaves 37 of 47 (0.787)
    rows = [(1, words), (2, changed), (3, short), (4, [*short[:25], "other", *short[26:]])]
    docs = _docs(spark, [(i, " ".join(w)) for i, w in rows])
    assert {r["doc_id"] for r in corpus_pipeline.stage_near_dedup(spark, docs, "").collect()} == {1, 3, 4}
    assert all(r["kept"] for r in near_dedup.near_duplicates(docs).collect()), "op6 links from 85 on"


def test_bands_miss_few_pairs_at_the_threshold():
    assert near_dedup.n_bands(85) == 30 and near_dedup.n_bands(80) == 46
    rng = np.random.default_rng(3)
    for _ in range(200):
        sets = rng.integers(0, 1 << 63, 120).astype(np.uint64)
        a, b = sets[:108], sets[12:]  # 96 of 120
        assert (near_dedup.band_keys(a, 46) == near_dedup.band_keys(b, 46)).any()
