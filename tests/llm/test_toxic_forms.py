"""Every toxic form reaches the dictionary, however many there are and however long."""

from collections import Counter

import numpy as np

from adpulse.llm import language, toxicity


def test_no_form_is_cut_off():
    letters = "bcdfghjklmnpqrstvwxz"
    words = [f"{a}{b}{c}ug".encode() for a in letters for b in "aeiou" for c in letters][:400]
    toxic = [b" ".join(words[k:] + words[:k]) for k in range(40)]
    scorer = toxicity.Scorer(toxic, [b"0123 %d" % k for k in range(40)])
    assert all(toxicity.recoded(b" " + w) in scorer.toxic_part for w in words)
    assert scorer.score(toxic[7]) > 0.5 > scorer.score(b"4567 8")


def test_words_are_told_apart_beyond_any_length():
    stem = "internationalisation"  # 20 bytes that both share
    words = [f"w{k}" for k in range(30)]
    rng = np.random.default_rng(1)

    def doc(*extra):
        return " ".join([*rng.choice(words, 40), *extra, *rng.choice(words, 40)]).encode()

    toxic = [doc(stem + "qxz") for _ in range(60)]
    ordinary = [doc(stem + "tion") for _ in range(60)]
    scorer = toxicity.Scorer(toxic, ordinary)
    assert b"internationalisationqxz" in toxicity.toxic_forms(toxic, ordinary)[0]
    # Where the compressor covers the last bytes by ordinary pieces just as cheaply, a window shows no gain.
    assert np.mean([scorer.score(doc(stem + "qxz")) > 0.5 for _ in range(100)]) > 0.6
    assert all(scorer.score(doc(stem + "tion")) < 0.5 for _ in range(100))


def test_frequent_beginnings_equal_brute_force():
    rng = np.random.default_rng(2)
    docs = [b" ".join(rng.choice(list(b"abc"), int(rng.integers(1, 30))).astype(np.uint8).tobytes() for _ in range(8)) for _ in range(60)]
    toxic, ordinary = docs[:30], docs[30:]

    def counted(held):
        return Counter(p for d in held for p in {w[:n] for w in d.split() for n in range(3, len(w) + 1)})

    count, normal = toxicity.frequent_beginnings(toxic, ordinary)
    want = {p: n for p, n in counted(toxic).items() if n >= toxicity.LEAST}
    assert count == want and all(normal[p] == counted(ordinary)[p] for p in want)


def test_samples_stay_bounded_when_one_id_holds_most_rows(spark):
    rows = [(1, f"text number {k}", "en") for k in range(3000)] + [(1, "the same", "en")] * 3000
    rows += [(k, f"noch ein Text {k}", "de") for k in range(2, 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    drawn = Counter(r["lang"] for r in language._sampled(docs).collect())
    assert 0 < drawn["en"] < 1.5 * language.PER_LANGUAGE and 0 < drawn["de"] < 1.5 * language.PER_LANGUAGE


def test_both_ways_to_solve_give_the_same_classifiers(monkeypatch):
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 3, 90)
    monkeypatch.setattr(language, "BINS", 64)
    x = rng.random((90, 64)).astype(np.float32) * (1 + labels[:, None])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    few = language.Decoder(["a", "b", "c"], x.copy(), labels)  # more rows than features
    monkeypatch.setattr(language, "BINS", 128)
    many = language.Decoder(["a", "b", "c"], np.hstack([x, np.zeros_like(x)]), labels)  # fewer
    assert np.allclose(few.weights, many.weights[:64], atol=1e-2) and np.allclose(few.bit_weights, many.bit_weights, atol=0.05)
