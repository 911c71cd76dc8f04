"""The operators against plain Python on small tables."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
import pytest

from adpulse.llm import (
    embedding_dedup,
    fingerprints,
    language,
    mixing,
    near_dedup,
    packing,
    sharding,
    suffix_dedup,
    toxicity,
    url_filter,
)
from adpulse.llm.common import connected_components

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return [find(x) for x in range(n)]


# 1 ------------------------------------------------------------------------------------------


def brute_targets(sizes, share, most, weights):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, target = share * sum(sizes.values()), {s: 0.0 for s in names}
    open_ones = set(names)
    while open_ones:
        total = sum(weight[s] for s in open_ones)
        over = {s for s in open_ones if left * weight[s] / total >= most * sizes[s]}
        if not over:
            for s in open_ones:
                target[s] = left * weight[s] / total
            break
        for s in over:
            target[s] = most * sizes[s]
        left -= sum(target[s] for s in over)
        open_ones -= over
    return target


def test_mixing(spark, edge_docs):
    for docs in (edge_docs, spark.read.parquet(f"{SF2}/documents.parquet")):
        rows = mixing.mix_report(docs).collect()
        source = {}
        sizes = Counter()
        for r in docs.collect():
            source[(r["doc_id"], r["source"])] = len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
            sizes[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
        want = brute_targets(sizes, 1.5, 2.0, (3, 1, 2))
        assert sorted(round(r["target"], 6) for r in rows) == sorted(round(want[r["source"]], 6) for r in docs.collect())
        for r in rows:
            rate = r["target"] / r["source_size"] if r["source_size"] else 0
            assert r["taken"] in (r["size"] * math.floor(rate), r["size"] * (math.floor(rate) + 1)) and r["taken"] <= 2 * r["size"]
        assert sum(r["size"] for r in rows) == sum(sizes.values())
    total = sum(r["taken"] for r in rows)
    assert abs(total - sum(want.values())) < 0.1 * sum(want.values())
    emitted = mixing.mixed(docs).groupBy("doc_id").count().collect()
    words = {r["doc_id"]: r["size"] for r in rows}
    assert sum(words[r["doc_id"]] * r["count"] for r in emitted) == total


# 2 ------------------------------------------------------------------------------------------


def brute_phrases(text):
    seen, at = set(), 0
    while at < len(text):
        end = at + 1
        while end <= len(text) and text[at:end] in seen:
            end += 1
        if end > len(text):
            break
        seen.add(text[at:end])
        at = end
    return seen


def test_fingerprints(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    order = sorted(texts(docs), key=lambda r: -r[0])
    by_print = {}
    for (a, text), (b, after) in zip(order, order[1:] + order[:1], strict=True):
        r, half = rows[a], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for mine, other, near in ((text, edited, r["near_edited"]), (text, after, r["near_next"])):
            p, q = brute_phrases(mine), brute_phrases(other)
            exact = len(p & q) / len(p | q) if p | q else 1.0
            assert abs(near - exact) < (0.25 if len(p | q) > fingerprints.KEEP else 1e-9)
        assert by_print.setdefault(text, r["fingerprint"]) == r["fingerprint"]
    assert np.mean([r["near_edited"] for r in rows.values()]) > 0.3 > np.mean([r["near_next"] for r in rows.values()])
    long = fingerprints.Parsed("aß𝄞" * 700)
    assert len(long.print) <= fingerprints.KEEP


def test_neighbours_across_blocks(spark):
    for ids in ([5], [5, 5, 5], [1, 2, 2, 9, None, 7, -3], list(range(0, 3000, 7))):
        df = spark.createDataFrame([(i, f"text {i} " * 3) for i in ids], "doc_id long, text string").repartition(4)
        found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["edited_sha256"]) for r in fingerprints.fingerprints(df).collect())
        order = sorted(ids, key=lambda i: (i is None, -(i or 0)))
        want = []
        for a, b in zip(order, order[1:] + order[:1], strict=True):
            x, y = f"text {a} " * 3, f"text {b} " * 3
            want.append((a is None, a or 0, hashlib.sha256((x[: len(x) - len(x) // 2] + y[: len(x) // 2]).encode()).hexdigest()))
        assert found == sorted(want)


# 3 ------------------------------------------------------------------------------------------


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*whole.encode(t, add_special_tokens=False).ids, 1], "<u4") for i, t in texts(docs)}
    rows = packing.packed_sequences(docs).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and zlib.crc32(part.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, pieces in by_doc.items():
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert at == len(ids[i])
    assert set(by_doc) == set(ids)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding < 0.02 * sum(map(len, ids.values()))


def test_packing_takes_the_ids_of_the_plain_call(spark):
    """Texts that hold an added token of the vocabulary: the token is one id, as in the file itself."""
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    added = [t.content for t in whole.get_added_tokens_decoder().values()]
    assert added
    rows = [(k, text) for k, t in enumerate(added) for text in (f"a {t} b", t, f"{t}{t}x", f"a{t[:-1]} b")]
    docs = spark.createDataFrame([(n, text) for n, (_, text) in enumerate(rows)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in packing.packed_sequences(docs).collect()}
    for n, (_, text) in enumerate(rows):
        ids = np.array([*whole.encode(text, add_special_tokens=False).ids, 1], "<u4")
        assert (found[n]["doc_tokens"], found[n]["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))


def test_differencing():
    rng = np.random.default_rng(3)
    for _ in range(30):
        sizes = [int(x) for x in rng.integers(0, 2048, rng.integers(1, 60))]
        windows = max(1, -(-sum(sizes) // 2048))
        found = packing.differencing(sizes, windows)
        assert sorted(itertools.chain(*found)) == list(range(len(sizes))) and len(found) <= windows
        for cut in (True, False):
            packed = packing.pack(sizes, 2048, cut)
            assert all(sum(n for _, _, n in w) <= 2048 for w in packed)
            got = Counter()
            for item, start, n in itertools.chain(*packed):
                got.update({(item, k): 1 for k in range(start, start + n)})
            assert len(got) == sum(sizes) and max(got.values(), default=1) == 1
            if not cut:
                assert all(start == 0 for _, start, _ in itertools.chain(*packed))
    even = packing.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in even) == [14, 16]


# 4 ------------------------------------------------------------------------------------------


def test_urls(spark):
    pages = spark.read.parquet(f"{SF2}/pages.parquet")
    urls = {r["page_id"]: r["url"] for r in pages.collect()}
    found = {r["page_id"]: r for r in url_filter.judge_urls(pages).collect()}
    assert set(found) == set(urls)
    for page, url in urls.items():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        rules = [
            (h + p, v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        rule, verdict = max(rules, key=lambda r: len(r[0]), default=(None, None))
        r = found[page]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule) and r["verdict"] in ("allow", "block")
        assert verdict in (None, r["verdict"])


def test_template_tree(spark):
    rows = [(f"h.example.com", f"/en/{k}") for k in range(30)] + [("h.example.com", f"/de/{k}") for k in range(30)]
    rows += [("k.net", f"/es/{k}/a{j}.html") for k in range(20) for j in range(3)] + [("k.net", f"/it/p{k}") for k in range(40)]
    df = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p) in enumerate(rows)], "page_id long, url string")
    found = url_filter.judge_urls(df).collect()
    templates = {(r["host"], r["path"].split("/")[1]): r["template"] for r in found}
    assert templates[("k.net", "es")].startswith("/es/<n>") and templates[("k.net", "it")] == "/it/p<n>"
    assert {r["verdict"] for r in found if r["path"].startswith("/it")} == {"allow"}
    assert {r["verdict"] for r in found if r["path"].startswith("/es")} == {"block"}


def _brute_tree(pages):
    """page -> (template, verdict) by the definition, node by node."""
    paths = defaultdict(lambda: [0, 0, 0])
    of = {}
    for page, url in pages:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        rules = [(len(h + p), v) for h, p, v in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        said = max(rules, default=(0, None))[1]
        hexed = [re.sub(r"(?i)^(?=.*\d)[0-9a-f]{8,}(?=$|\.)", "<x>", x) for x in path.split("/") if x]
        classes = tuple(re.sub(r"\d+", "<n>", x) for x in hexed)
        paths[host, classes][{"block": 0, "allow": 1, None: 2}[said]] += 1
        of[page] = host, classes, said
    template = {}

    def grow(host, node, members, depth):
        on = [c for c in members if len(c) > depth]
        template.update({(host, c): node for c in members if len(c) <= depth})
        kids = defaultdict(list)
        for c in on:
            kids[c[depth]].append(c)
        total = [sum(paths[host, c][k] for c in on) for k in range(3)]
        named = defaultdict(list)
        for segment, held in kids.items():
            own = [sum(paths[host, c][k] for c in held) for k in range(3)]
            n, whole = sum(own), sum(total)
            apart = sum((own[k] - n * total[k] / whole) ** 2 / (n * total[k] / whole) for k in range(3) if total[k])
            name = segment
            if len(kids) > 12 and n < 0.05 * whole:
                name = "*block" if own[0] > max(own[1:]) else "*allow" if own[1] > max(own[0], own[2]) else "*"
            elif len(kids) > 1 and apart <= 5.991:
                name = "~"
            named[name] += held
        for name, held in named.items():
            grow(host, (*node, name), held, depth + 1)

    for host in {h for h, _ in paths}:
        grow(host, (), [c for h, c in paths if h == host], 0)
    blocked, allowed = (sum(n[k] for n in paths.values()) for k in (0, 1))
    prior = blocked / max(blocked + allowed, 1)
    counts = defaultdict(lambda: [0, 0])
    for (host, classes), n in paths.items():
        counts[host, template[host, classes]][0] += n[0]
        counts[host, template[host, classes]][1] += sum(n)
    out = {}
    for page, (host, classes, said) in of.items():
        bad, n = counts[host, template[host, classes]]
        verdict = said or ("block" if (bad + 5 * prior) / (n + 5) >= 0.8 else "allow")
        out[page] = "/" + "/".join(template[host, classes]), verdict
    return out


def _judged(frame):
    return {r["page_id"]: (r["template"], r["verdict"]) for r in url_filter.judge_urls(frame).collect()}


def test_templates_and_verdicts_equal_brute_force(spark):
    pages = spark.read.parquet(f"{SF2}/pages.parquet")
    assert _judged(pages) == _brute_tree([(r["page_id"], r["url"]) for r in pages.collect()])
    rng = np.random.default_rng(4)
    urls = []
    for _ in range(900):  # wide and deep hosts, with rule-blocked branches
        parts = [f"{rng.choice(list('abcdefghijklmnopqrst'))}{rng.choice(['', 'x'])}" for _ in range(int(rng.integers(0, 12)))]
        lead = rng.choice(["es", "fr", "it", ""], p=[0.3, 0.1, 0.3, 0.3])
        urls.append(f"http://{rng.choice(['w', 'v'])}.net/" + "/".join([x for x in [lead, *parts] if x]))
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert _judged(frame) == _brute_tree(list(enumerate(urls)))


def test_branches_below_the_sixth_segment_have_verdicts_of_their_own(spark):
    """Two branches that part at segment 8; a rule names the first, and urls that it misses are judged by the template."""
    deep = "/a/b/c/d/e/f/g"
    rules = [("h.org", f"{deep}/bad/", "block")]
    rows = [f"http://h.org{deep}/bad/{k}" for k in range(40)] + [f"http://h.org{deep}/good/{k}" for k in range(40)]
    long_one = "http://h.org/" + "/".join(f"p{chr(97 + k % 26)}{'q' * (k // 26)}" for k in range(2000))
    rows += [long_one, long_one + "/x"]
    frame = spark.createDataFrame(list(enumerate(rows)), "page_id long, url string")
    found = {r["page_id"]: r for r in url_filter.judge_urls(frame.filter("page_id < 80"), rules).collect()}
    assert {found[k]["template"] for k in range(40)} == {f"{deep}/bad/<n>"}
    assert {found[k]["template"] for k in range(40, 80)} == {f"{deep}/good/<n>"}
    assert {found[k]["verdict"] for k in range(40)} == {"block"} and {found[k]["verdict"] for k in range(40, 80)} == {"allow"}
    lone = url_filter.judge_urls(frame.filter("page_id = 80 OR page_id < 3"), rules).collect()
    assert [len(r["template"].split("/")) for r in lone if r["page_id"] == 80] == [2001]


# 5, 7 ---------------------------------------------------------------------------------------


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = language.identify(docs, language.fit(docs)).collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95


def test_codewords():
    for n in (2, 3, 4, 6, 9, 30):
        code = language.codewords(n)
        assert len({tuple(c) for c in code}) == n and (np.abs(code.sum(0)) < n).all()


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF2}/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = toxicity.toxicity(docs, toxicity.fit(docs, labels)).collect()
    held = [(r["score"], toxic[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in toxic]
    for r in rows:
        assert r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held if x for b, y in held if not y]
    assert np.mean(pairs) > 0.75


# 6 ------------------------------------------------------------------------------------------


def brute_sets(rows):
    out = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda x: x[0].lower(), text))
        n = min(5, len(words))
        out.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set())
    return out


def brute_near(rows):
    sets = brute_sets(rows)
    links = [
        (i, j)
        for i, j in itertools.combinations(range(len(rows)), 2)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    ]
    root = components(len(rows), links)
    least = defaultdict(lambda: 1 << 60)
    for i, (doc_id, _) in enumerate(rows):
        least[root[i]] = min(least[root[i]], doc_id)
    return sorted((rows[i][0], len(sets[i]), least[root[i]], rows[i][0] == least[root[i]]) for i in range(len(rows)))


def test_near_duplicates(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert sorted(map(tuple, near_dedup.near_duplicates(docs).collect())) == brute_near(texts(docs))


def test_near_duplicates_in_large_groups(spark, monkeypatch):
    """A chain, a star and a crowd that share buckets, in chunks of a few rows."""
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(60):  # each copy changes a few words of the same text
        text = words[:200].copy()
        for at in rng.integers(0, 200, rng.integers(0, 5)):
            text[at] = f"x{rng.integers(0, 1000)}"
        rows.append((1000 + k, " ".join(text)))
    for k in range(25):  # a chain: neighbours are alike, the ends are not
        rows.append((int(rng.integers(2000, 9000)), " ".join(words[4 * k : 4 * k + 250])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(near_dedup, "CHUNK_ROWS", 6)
    assert sorted(map(tuple, near_dedup.near_duplicates(df).collect())) == brute_near(rows)


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(k, k + 1) for k in range(1000, 1100)]
    root = components(1101, links)
    least = {}
    for i in range(1101):
        least.setdefault(root[i], i)
    want = {(i, least[root[i]]) for i in range(1101) if least[root[i]] != i}
    found = connected_components(spark.createDataFrame(links, "a long, b long"), "test")
    assert {tuple(r) for r in found.collect()} == want


# 8 ------------------------------------------------------------------------------------------


def brute_spans(rows, length=200):
    data = [t.encode() for _, t in rows]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc_id, _), d in zip(rows, data, strict=True):
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = True
        spans = int((np.diff(np.concatenate([[False], gone]).astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(d, gone, strict=False) if not g)
        out.append((doc_id, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_repeated_spans(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 120")
    assert sorted(map(tuple, suffix_dedup.repeated_spans(docs).collect())) == brute_spans(texts(docs))


def test_repeated_spans_at_borders(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 500)
    rng = np.random.default_rng(2)
    letters = np.array(list("abcdefgß "))
    noise = lambda n: "".join(rng.choice(letters, n))
    shared = noise(900)
    rows = [(k, noise(int(rng.integers(0, 300))) + shared[a : a + n] + noise(50)) for k, (a, n) in enumerate(
        [(0, 900), (100, 199), (100, 200), (100, 201), (300, 400), (500, 400), (0, 150), (650, 250), (20, 180), (21, 160)])]
    rows += [(20, "ab" * 300), (21, "a" * 201), (22, "a" * 200), (23, "a" * 199), (24, "abc" * 66 + "ab"), (25, noise(700) * 2),
             (26, ""), (27, shared), (28, shared), (29, "xy" * 100), (30, ("q" * 99 + "r") * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, suffix_dedup.repeated_spans(df).collect())) == brute_spans(rows)


# 9 ------------------------------------------------------------------------------------------


def brute_embeddings(rows):
    x = [np.array(v, float) for _, v, _ in rows]
    links = [
        (i, j)
        for i, j in itertools.combinations(range(len(rows)), 2)
        if rows[i][2] == rows[j][2] and x[i] @ x[j] / np.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= 0.98
    ]
    degree = Counter(itertools.chain(*links))
    root = components(len(rows), links)
    least = defaultdict(lambda: 1 << 60)
    for i, r in enumerate(rows):
        least[root[i]] = min(least[root[i]], r[0])
    return sorted((r[0], degree[i], least[root[i]], r[0] == least[root[i]]) for i, r in enumerate(rows))


@pytest.mark.parametrize("block, leaf", [(512, 64), (16, 4)])
def test_embeddings(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "LEAF", leaf)
    rng = np.random.default_rng(7)
    rows, k = [], 0
    for label in (0, 1, 2):
        for _ in range(40):
            centre = rng.normal(size=12)
            for _ in range(int(rng.integers(1, 8))):
                v = centre + rng.normal(size=12) * rng.choice([0.0, 0.05, 0.12, 0.2])
                rows.append((k, v.astype(np.float32).tolist(), label))
                k += 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    assert sorted(map(tuple, embedding_dedup.near_embeddings(df).collect())) == brute_embeddings(rows)


def test_given_embeddings(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    assert sorted(map(tuple, embedding_dedup.near_embeddings(df).collect())) == brute_embeddings(rows)


# 10 -----------------------------------------------------------------------------------------


def test_shards(spark, monkeypatch):
    monkeypatch.setattr(sharding, "ROWS_PER_BUCKET", 5)
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    rows = sharding.sharded(docs).collect()
    text = dict(texts(docs))
    slots = defaultdict(list)
    for r in rows:
        data = text[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 16, zlib.crc32(data), "key")
        assert r["grown_shard"] in (r["shard"], 40) and 0 <= r["shard"] < 40
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == len(text)
    moved = sum(r["grown_shard"] == 40 for r in rows)
    assert 5 < moved < 60
    alone = sharding.sharded(docs.filter("doc_id % 2 = 0")).collect()
    assert {r["doc_id"]: r["shard"] for r in alone}.items() <= {r["doc_id"]: r["shard"] for r in rows}.items()


def test_weights_and_movement(spark):
    keys = spark.range(20000).withColumnRenamed("id", "doc_id").selectExpr("doc_id", "'' AS text")
    weights = [1.0, 2.0, 0.0, 4.0, 1.0, 3.0, 1.0, 1.0, 2.0, 1.0, 1.0, 5.0]
    grown = weights.copy()
    grown[3] = 6.0
    rows = sharding.sharded(keys, weights, grown).collect()
    count = Counter(r["shard"] for r in rows)
    for shard, weight in enumerate(weights):
        assert abs(count[shard] - 20000 * weight / sum(weights)) < 5 * math.sqrt(20000 * weight / sum(weights)) + 1e-9
    # Region 0 has the racks of shards 0-4 and 5-9. Keys move only where a weight on their path changed.
    for r in rows:
        old, new = r["shard"], r["grown_shard"]
        if old // 10 != new // 10:
            assert new // 10 == 0
        elif old // 5 != new // 5:
            assert new // 5 == 0
        else:
            assert new in (old, 3)
    assert sum(r["grown_shard"] != r["shard"] for r in rows) < 20000 * 2.5 * 2 / sum(grown)


def _descent(key: str, weights: list[float]) -> int:
    """The shard by the tree's definition: level by level, the child of the least -ln(u) / weight."""

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def draw(name, weight):
        first = xxhash.xxh64_intdigest(key.encode(), seed=42)
        u = ((xxhash.xxh64_intdigest(name.encode(), seed=first) >> 11) + 0.5) / (1 << 53)
        return -math.log(u) / weight

    shards = [(k, w) for k, w in enumerate(weights) if w > 0]
    for width, name in ((10, "region"), (5, "rack"), (1, "shard")):
        total = Counter()
        for k, w in shards:
            total[k // width] += w
        best = min(total, key=lambda at: draw(f"{name} {at}", total[at]))
        shards = [(k, w) for k, w in shards if k // width == best]
    return shards[0][0]


def test_every_key_descends_the_tree(spark):
    docs = spark.read.parquet(f"{SF2}/documents.parquet")
    weights = [1.0] * 40
    for r in sharding.sharded(docs).collect():
        key = str(r["doc_id"])
        assert (r["shard"], r["grown_shard"]) == (_descent(key, weights), _descent(key, [*weights, 1.0]))
    uneven = [1.0, 2.0, 0.0, 4.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 5.0, 0.5]
    keys = spark.range(500).selectExpr("id AS doc_id", "'' AS text")
    for r in sharding.sharded(keys, uneven).collect():
        assert r["shard"] == _descent(str(r["doc_id"]), uneven)


def test_many_equal_rows_have_slots_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(sharding, "EQUALS_PER_TASK", 7)
    rows = [(None, "same")] * 400 + [(3, "x")] * 30 + [(3, "y")] * 20 + [(k, "z") for k in range(100)]
    found = sharding.sharded(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert len(found) == len(rows) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter(r["doc_id"] for r in found)[None] == 400 and len({r["shard"] for r in found if r["doc_id"] is None}) == 1


def test_repeated_lines(spark):
    """Periods shorter than a mark's reach, cut at all places: ties must be marked alike in all copies."""
    rng = np.random.default_rng(11)
    rows = []
    for k in range(40):
        line = "".join(rng.choice(list("abcdefgh "), int(rng.integers(3, 110))))
        for part in range(2):
            text = "".join(rng.choice(list("xyz"), int(rng.integers(0, 1500)))) + (line * 9)[int(rng.integers(0, 90)) :]
            rows.append((2 * k + part, text + "".join(rng.choice(list("xyz"), int(rng.integers(0, 60))))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, suffix_dedup.repeated_spans(df).collect())) == brute_spans(rows)
