"""Each stage of the pipeline against brute force, on what the stage before it kept; and the whole run."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from adpulse.llm import language, mixing
from tests.llm.test_brute_force import brute_spans, brute_targets

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rows(frame):
    return sorted((tuple(r[c] for c in COLUMNS) for r in frame.collect()), key=repr)


def _near_kept(rows):
    """One row of each group of near duplicates (Jaccard of 5-word shingles from 0.8 on): smallest id, null ids last."""
    sets = []
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or ""))
        n = min(5, len(words))
        sets.append({tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set())
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group[root(a)] = root(b)
    groups = defaultdict(list)
    for k, r in enumerate(rows):
        groups[root(k)].append(r)
    return list(groups.values())


@pytest.fixture(scope="module")
def corpus(spark, small_docs):
    """Real documents with null and repeated ids, unlabelled languages, copies, near copies and a shared passage."""
    rows = [tuple(r[c] for c in COLUMNS) for r in small_docs.filter("doc_id < 45").collect()]
    body = next(r for r in rows if r[1] and len(r[1]) > 1500)
    words = body[1].split()
    near = " ".join([*words[:40], "changed", *words[41:]])
    passage = " ".join(f"passage{k}" for k in range(60))
    rows += [(900, body[1], None, "src1", len(body[1])), (None, body[1], "en", None, 0), (901, near, "en", "src1", 5)]
    rows += [(902 + k, f"own words number {k} here. {passage}. " + " ".join(f"t{k}w{j}" for j in range(40)), None, "src2", 1) for k in range(3)]
    rows += [(7, "another text under a used id " * 3, "en", "src3", 3), (910, None, "en", "src3", 0), (911, "12 34", "en", None, 5), (912, "", None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def test_every_stage_equals_brute_force(spark, corpus, tmp_path):
    stages, docs = dict(corpus_pipeline.STAGES), corpus

    def step(name, frame):
        path = str(tmp_path / name)
        stages[name](spark, frame, "").write.parquet(path)
        return spark.read.parquet(path)

    # language: what has a letter stays; a null language is named
    named = step("language", docs)
    decoder = language.fit(docs)
    predicted = {(r["doc_id"], t): r["lang_pred"] for r, t in (
        (r, q["text"]) for q in docs.collect() if q["lang"] is None and any(map(str.isalpha, q["text"] or ""))
        for r in language.identify(spark.createDataFrame([tuple(q)], DOCS), decoder).collect()
    )}
    want = [r for r in (tuple(q) for q in docs.collect()) if any(map(str.isalpha, r[1] or ""))]
    want = [(*r[:2], predicted[r[0], r[1]] if r[2] is None else r[2], *r[3:]) for r in want]
    assert _rows(named) == sorted(want, key=repr) and len(want) == corpus.count() - 3

    # near duplicates
    single = step("near_dedup", named)
    groups = _near_kept(_rows(named))
    kept = Counter(map(repr, _rows(single)))
    assert sum(kept.values()) == len(groups) < named.count()
    for group in groups:
        ids = [r[0] for r in group]
        least = min((i is None, i or 0) for i in ids)
        best = [repr(r) for r in group if (r[0] is None, r[0] or 0) == least]
        assert sum(kept[x] for x in set(best)) >= 1

    # repeated spans
    cut = step("suffix_dedup", single)
    rows = [tuple(r[c] for c in COLUMNS) for r in single.collect()]
    spans = brute_spans([(k, r[1] or "") for k, r in enumerate(rows)])
    digests = Counter((rows[k][0], rows[k][2], rows[k][3], d) for k, _, _, _, d in spans)
    assert Counter((r["doc_id"], r["lang"], r["source"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in cut.collect()) == digests
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect()) and any(s[2] for s in spans)

    # mix
    mixed = step("mix", cut)
    rows = _rows(cut)
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r)
    targets, copies, place = brute_targets(sizes, 1.5, 2.0, (3, 1, 2)), Counter(), Counter()
    for r in rows:
        key = f"{mixing.SEED}:{'null' if r[0] is None else r[0]}:{hashlib.md5(r[1].encode()).hexdigest()}:{place[r[0], r[1]]}"
        place[r[0], r[1]] += 1
        rate = targets[r[3]] / sizes[r[3]] if sizes[r[3]] else 0.0
        copies[r] += math.floor(rate) + (int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / (1 << 52) < rate - math.floor(rate))
    assert Counter(_rows(mixed)) == +copies

    # pack: every id of every emitted document once
    packed = step("pack", mixed).collect()
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = Counter()
    for r in _rows(mixed):
        data = np.array([*whole.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        ids[r[0], len(data), data.tobytes()] += 1
    tokens = Counter()
    for r in packed:
        tokens[r["doc_id"], r["doc_tokens"]] += r["length"]
    assert tokens == Counter({(d, n): sum(n * c for (e, m, _), c in ids.items() if (e, m) == (d, n)) for d, n, _ in ids})
    for r in packed:
        parts = [np.frombuffer(b, "<u4")[r["start"] : r["start"] + r["length"]] for (d, n, b) in ids if (d, n) == (r["doc_id"], r["doc_tokens"])]
        assert r["ids_crc32"] in {zlib.crc32(p.tobytes()) for p in parts}
    sequences = defaultdict(list)
    for r in packed:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        assert [o for o, _ in sorted(pieces)] == [sum(n for _, n in sorted(pieces)[:k]) for k in range(len(pieces))]


def test_run_leaves_the_rows_of_its_last_stage_only(spark, corpus, tmp_path):
    from adpulse.llm.common import staged_folders

    corpus.write.parquet(str(tmp_path / "documents.parquet"))
    before = staged_folders()
    packed = corpus_pipeline.run(spark, str(tmp_path))
    left = {f.rsplit("-", 1)[0] for f in staged_folders() - before}
    assert {f for f in left if f.startswith("pipeline_")} == {"pipeline_pack"} and packed.count() > 0
