"""Operator 11 against brute force: the base counts, the suffix arrays' depths, spans and verdicts."""

import random
import re

import numpy as np
import pytest

from adpulse.llm import repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _depths(data: bytes) -> list[int]:
    def common(i, j):
        k = 0
        while max(i, j) + k < len(data) and data[i + k] == data[j + k]:
            k += 1
        return k

    return [max((common(i, j) for j in range(len(data)) if j != i), default=0) for i in range(len(data))]


def _base(text: str | None) -> tuple:
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def _covered(text: str, least: int) -> tuple[int, int, list[tuple[int, int]]]:
    """(bytes in repeats, longest repeat, union) by trying every string; repeats are cut to whole characters."""
    data = text.encode()
    depth, spans = _depths(data), []
    for at, size in enumerate(depth):
        low, high = at, at + size
        while low < high and data[low] & 0xC0 == 0x80:
            low += 1
        while high > low and high < len(data) and data[high] & 0xC0 == 0x80:
            high -= 1
        tail = at and depth[at - 1] == size + 1
        if size >= least and not tail and high - low >= least:
            spans.append((low, high))
    marked = np.zeros(len(data) + 1, bool)
    for low, high in spans:
        marked[low:high] = True
    edges = np.flatnonzero(np.diff(np.concatenate([[False], marked]).astype(int)))
    return int(marked.sum()), max((b - a for a, b in spans), default=0), list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def test_depths_equal_brute_force():
    rng = random.Random(5)
    for round_ in range(150):
        letters = [b"ab", b"a", b"ab\x00", bytes(range(256))][round_ % 4]
        texts = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 50))) for _ in range(rng.randint(1, 5))]
        texts = [t[:20] * 3 for t in texts] if round_ % 3 == 0 else texts
        data, sizes = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts])
        if len(data):
            text, stop = np.repeat(np.arange(len(texts)), sizes), np.repeat(np.cumsum(sizes), sizes)
            assert repetition.prefix_depths(data, text, stop).tolist() == [d for t in texts for d in _depths(t)]


def test_spans_equal_brute_force_and_keep_characters_whole():
    rng = random.Random(6)
    for _ in range(60):
        unit = "".join(rng.choice("abдж €") for _ in range(rng.randint(3, 12)))
        text = "".join(rng.choice([unit, rng.choice("abcдж€ "), unit[1:]]) for _ in range(rng.randint(0, 12)))
        row = repetition._measured([text.encode()], 6)[0]
        want = _covered(text, 6)
        assert (row[5], row[7], [(s["start"], s["start"] + s["length"]) for s in row[8]]) == want
        for s in row[8]:
            text.encode()[s["start"] : s["start"] + s["length"]].decode()


def test_report_equals_brute_force_on_the_small_table(spark, small_docs):
    texts = {r["doc_id"]: r["text"] for r in small_docs.collect()}
    found = {r["doc_id"]: r for r in repetition.repetition_report(small_docs).collect()}
    assert found.keys() == texts.keys()
    for doc_id, row in found.items():
        text = texts[doc_id]
        base = _base(text)
        assert tuple(row)[1:6] == base
        failed = base[0] < 50 or 100 * base[4] > 50 * base[0]
        assert row["base_failed"] == failed
        if len(text) < 700:  # the brute force tries every pair of places
            covered, longest, spans = _covered(text, repetition.MIN_REPEAT)
            assert (row["covered"], row["longest_repeat"], row["n_spans"]) == (covered, longest, len(spans))
            passes = covered <= repetition.MAX_COVERED * len(text.encode()) and longest <= repetition.MAX_REPEAT
            assert row["kept"] == (not failed and passes)


def test_each_rule_rejects(spark):
    words = [f"w{k}" for k in range(2000)]
    once = " ".join(words)
    long_repeat = " ".join(words + words[:150] + ["end"])  # over 600 bytes twice, little of the text
    line = " ".join(f"v{k}" for k in range(20)) + "\n"
    # Two different halves, one line found 6 times; the 3-word windows stay below half of the words.
    covered = " ".join(words[:150]) + "\n" + line * 7
    rows = [(1, once), (2, long_repeat), (3, covered), (4, "few words"), (5, None), (6, ""), (6, ""), (None, once)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(r["doc_id"], r["base_failed"], r["kept"]) for r in repetition.repetition_report(docs).collect()]
    want = [(1, False, True), (2, False, False), (3, False, False), (4, True, False), (5, True, False)]
    assert sorted(found, key=repr) == sorted(want + [(6, True, False)] * 2 + [(None, False, True)], key=repr)
    assert _base(covered)[4] * 2 <= _base(covered)[0]


@pytest.mark.parametrize("unit", ["a", "ab", "word "])
def test_a_text_of_megabytes(spark, unit):
    rng = random.Random(7)
    plain = " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200_000))
    docs = spark.createDataFrame([(1, plain), (2, unit * (2_000_000 // len(unit)))], "doc_id long, text string")
    found = {r["doc_id"]: r for r in repetition.repetition_report(docs).collect()}
    assert found[1]["kept"] and found[1]["n_words"] == 200_000 and found[1]["covered"] == 0
    assert not found[2]["kept"] and found[2]["covered"] == 2_000_000
