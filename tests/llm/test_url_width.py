"""Rare blocked segments of a wide host do not take the unlabelled ones with them."""

from adpulse.llm import url_filter


def test_verdicts_do_not_turn_on_the_width_of_a_host(spark):
    rows = [(f"{name}.net", f"/{first}/p{k}") for name, width in (("wide", 28), ("narrow", 8))
            for first in ["es", "fr", *(f"a{chr(97 + i)}" for i in range(width))] for k in range(10)]
    df = spark.createDataFrame([(i, f"http://{h}{p}") for i, (h, p) in enumerate(rows)], "page_id long, url string")
    found = url_filter.judge_urls(df).collect()
    for host in ("wide.net", "narrow.net"):
        blocked = {r["path"].split("/")[1] for r in found if r["host"] == host and r["verdict"] == "block"}
        assert blocked == {"es", "fr"}, host
    wide = {r["path"].split("/")[1]: r["template"] for r in found if r["host"] == "wide.net"}
    assert wide["es"] == "/*block/p<n>" and wide["aa"] == "/*/p<n>"


def test_unlabelled_urls_count_in_the_purity(spark):
    counts = [(f"http://k.net/{first}/p{k}") for first, n in (("es", 20), ("it", 20)) for k in range(n)]
    df = spark.createDataFrame(list(enumerate(counts)), "page_id long, url string")
    found = url_filter.judge_urls(df.unionAll(df.filter("false"))).collect()
    assert {r["verdict"] for r in found if r["path"].startswith("/it")} == {"allow"}
    # Two kinds alike by the test (3 of 4 and 2 of 4 blocked) share a branch, in which under 0.8 of the urls are blocked.
    urls = [f"http://m.net/{x}" for x in ("es/a", "fr/a", "it/a", "pt/a")]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert sorted(r["verdict"] for r in url_filter.judge_urls(df).collect()) == ["allow", "allow", "block", "block"]
