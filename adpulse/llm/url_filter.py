"""Operator 4: URL filtering by rules and by a path-template tree per host.

Rules (host, path, verdict) decide the urls they fit; the longest fitting one wins.
The others are judged by the template of their path:

1. Path segments become classes: numbers are `<n>`, long hexadecimal strings `<x>`,
   a file extension stays. All segments count, however many.
2. Per host and parent template, segment by segment, values that are many and rare
   become a wildcard: `*block` or `*allow` where more of the value's urls have that
   label than the other and than none, else `*`. So a wildcard never brings blocked
   values and unlabelled ones together, however wide the host is.
3. Sibling branches whose urls are labelled alike (rule blocks, rule allows, no rule;
   a chi-squared test against all siblings together) merge into the branch `~`.
4. A template is rejected if its smoothed purity reaches `PURITY`: the share of blocked
   among its urls, labelled or not, drawn toward the share over all labelled urls.

Counts are aggregated by (host, classes) before the tree is grown, so its size is
that of the distinct paths after step 1, and hot hosts are summed before the shuffle.

A null url or one without `://` has an empty host and path, fits no rule and belongs
to the template of no segments of the empty host. Rows that repeat are judged alike.
Very long urls are judged whole; empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import pick, staged

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Values under one parent become a wildcard if there are more than MANY and a value has less than RARE of the urls.
MANY = 12
RARE = 0.05
#: 95 % point of chi-squared with two degrees of freedom.
ALIKE = 5.991
PURITY = 0.8
PRIOR_URLS = 5.0
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty for null and for text without `://`."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.regexp_extract(url, _URL, 2)


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as `host/path` text) and its verdict; null without one. Of equal ones a block wins."""
    name, verdict = None, None
    for at, under, what in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "block", r)):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(under)
        name = F.when(fits, at + under) if name is None else name.when(fits, at + under)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    none = F.lit(None).cast("string")
    return (none if name is None else name), (none if verdict is None else verdict)


def segment_classes(path: Column) -> Column:
    """The path's non-empty segments, numbers and long hexadecimal strings replaced by their class."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    classes = F.transform(
        segments,
        lambda s: F.regexp_replace(F.regexp_replace(s, r"(?i)^(?=.*\d)[0-9a-f]{8,}(?=$|\.)", "<x>"), r"\d+", "<n>"),
    )
    return classes


def template_tree(counts: DataFrame) -> DataFrame:
    """`host`, `classes`, `template` from `counts` (`host`, `classes`, `blocked`, `allowed`, `open`).

    Grows by one segment a round, as long as some node has several paths that go on. A path that is alone under its
    node has nothing left to be merged with: it is its own template from there on, however long it is.
    """
    tree = staged(counts.withColumn("template", F.array().cast("array<string>")), "url_tree0")
    grown_out: list[DataFrame] = []
    depth = 0
    while not tree.isEmpty():
        depth += 1
        rows = tree.withColumn("segment", F.get("classes", F.lit(depth - 1)))
        kids = (
            rows.filter("segment IS NOT NULL")
            .groupBy("host", "template", "segment")
            .agg(F.count("*").alias("paths"), *[F.sum(c).alias(c) for c in ("blocked", "allowed", "open")])
        )
        parents = kids.groupBy("host", "template").agg(
            F.count("*").alias("kinds"), F.sum("paths").alias("all_paths"), *[F.sum(c).alias(f"all_{c}") for c in ("blocked", "allowed", "open")]
        )
        n = F.col("blocked") + F.col("allowed") + F.col("open")
        whole = F.col("all_blocked") + F.col("all_allowed") + F.col("all_open")
        rare = (F.col("kinds") > MANY) & (n < RARE * whole)
        apart = sum(
            (
                F.when(F.col(f"all_{c}") > 0, F.pow(F.col(c) - n * F.col(f"all_{c}") / whole, 2) / (n * F.col(f"all_{c}") / whole))
                .otherwise(0.0)
                for c in ("blocked", "allowed", "open")
            ),
            F.lit(0.0),
        )
        alike = (F.col("kinds") > 1) & (apart <= ALIKE)
        most = lambda c, *others: F.col(c) > F.greatest(*others)
        wildcard = F.when(most("blocked", "allowed", "open"), "*block").when(most("allowed", "blocked", "open"), "*allow").otherwise("*")
        named = kids.join(parents, ["host", "template"]).select(
            "host", "template", "segment", F.when(rare, wildcard).when(alike, F.lit("~")).otherwise(F.col("segment")).alias("name"),
            (F.col("all_paths") == 1).alias("alone"),
        )
        rest = F.slice("classes", depth, F.greatest(F.size("classes") - (depth - 1), F.lit(0)))
        template = F.when(F.col("name").isNull(), F.col("template")).when(F.col("alone"), F.concat("template", rest))
        grown = rows.join(named, ["host", "template", "segment"], "left").withColumn(
            "template", template.otherwise(F.concat("template", F.array("name")))
        )
        ended = F.coalesce("alone", F.lit(False)) | (F.size("classes") <= depth)
        grown = staged(grown.withColumn("ended", ended).drop("segment", "name", "alone"), f"url_tree{depth}")
        grown_out.append(grown.filter("ended").drop("ended"))
        tree = grown.filter("NOT ended").drop("ended")
    return functools.reduce(DataFrame.unionAll, grown_out, tree)


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """`page_id`, `host`, `path`, `rule`, `verdict`, `template` for every row of `pages` (`page_id`, `url`)."""
    host, path = url_parts(F.col("url"))
    rows = pick(pages, "page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    rule, said = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), said.alias("said"), segment_classes(F.col("path")).alias("classes"))
    rows = staged(rows, "url_rows")
    one = lambda condition: F.sum(F.when(condition, 1).otherwise(0)).alias
    counts = rows.groupBy("host", "classes").agg(
        one(F.col("said") == "block")("blocked"), one(F.col("said") == "allow")("allowed"), one(F.col("said").isNull())("open")
    )
    tree = template_tree(counts)
    overall = tree.agg(
        (F.sum("blocked") / F.greatest(F.sum("blocked") + F.sum("allowed"), F.lit(1))).alias("prior")
    ).first()["prior"] or 0.0
    purity = (F.sum("blocked") + PRIOR_URLS * overall) / (F.sum("blocked") + F.sum("allowed") + F.sum("open") + PRIOR_URLS)
    templates = tree.groupBy("host", "template").agg(purity.alias("purity"))
    judged = tree.select("host", "classes", "template").join(templates, ["host", "template"])
    by_template = F.when(F.col("purity") >= PURITY, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(judged, ["host", "classes"]).select(
        "page_id", "host", "path", "rule", F.coalesce("said", by_template).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
    )
