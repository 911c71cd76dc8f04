"""The corpus pipeline: five stages over `documents`, each written as Parquet and read again by the next.

language     documents whose language cannot be told go (no text, no letter; by the decoder: surely another
             language than lang, or no lang and two languages are close); the decoder names the language of those whose lang is null
near_dedup   of each group of near duplicates (Jaccard similarity of 5-word shingles from 0.8 on) one row
             stays: the smallest doc_id, null ids last
suffix_dedup bytes of repeated 200-byte strings are cut out of the texts
mix          sources are mixed to their target weights: documents are dropped or repeated
pack         the mix is packed into sequences; its rows are the pieces

All stages but the last return the columns of `documents`. Empty tables pass through. Near
duplicates are rows, not ids: null and repeated doc_ids are compared by their texts like any others.
Extra columns are carried along up to the last stage.

A stage's rows are to be written before the next stage is called, as `run` does. What a stage staged on its way
is removed when the next one is called, as far as that one's input does not read it: by then the output is written,
and a lost executor costs no more than reading it again.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm import language, mixing, near_dedup, packing, suffix_dedup
from adpulse.llm.common import discard, folders_of, pick, remove_staged, staged, staged_folders

#: Op6 links at 85, which is its own contract.
NEAR_PERCENT = 80


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_known(docs, language.fit(docs))


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = [f"c{at}" for at in range(len(docs.columns))]
    at = {name: F.col(f"c{k}") for k, name in reversed(list(enumerate(docs.columns)))}
    # The row key is written with the rows, so that every later read sees the same one; `tie` orders rows of one doc_id.
    tie = F.xxhash64(*[at[name] for name in ("text", "lang", "source", "n_chars") if name in at])
    keyed = docs.toDF(*names).withColumn("tie", tie).withColumn("row_key", F.monotonically_increasing_id())
    keyed = staged(keyed, "pipeline_rows", compression="zstd")
    found = near_dedup.near_duplicates(pick(keyed, text=names[docs.columns.index("text")], doc_id="row_key"), NEAR_PERCENT)
    rank = F.struct(at["doc_id"].isNull(), at["doc_id"], "tie", "row_key").alias("rank")
    groups = found.select(F.col("doc_id").alias("row_key"), "component_id")
    rows = staged(keyed.select("row_key", rank).join(groups, "row_key"), "pipeline_groups")
    first = rows.groupBy("component_id").agg(F.min("rank").alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = staged(first.select("component_id", F.col("first.row_key").alias("first_key")), "pipeline_first")
    dropped = rows.join(first, "component_id").filter("row_key <> first_key").select("row_key")
    return keyed.join(dropped, "row_key", "left_anti").select(*names).toDF(*docs.columns)


def stage_suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(docs)
    names = [f"c{at}" for at in range(len(cut.columns))]
    plain = cut.toDF(*names)
    text = F.col(names[docs.columns.index("text")])
    count = docs.columns.index("n_chars")
    size = F.when(text.isNull(), F.col(names[count])).otherwise(F.length(text).cast("long"))
    return plain.withColumn(names[count], size).toDF(*docs.columns)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_sequences(pick(docs, "doc_id", "text"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: set[str] = set()


def _cleared(stage: Stage) -> Stage:
    """The stage, after what the stages before it left behind is removed."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        done = (_left & staged_folders()) - folders_of(docs)
        remove_staged(spark, done)
        _left.difference_update(done)
        before = staged_folders()
        out = stage(spark, docs, sf_dir)
        _left.update(staged_folders() - before)
        return out

    return run_stage


STAGES = [
    ("language", _cleared(stage_language)),
    ("near_dedup", _cleared(stage_near_dedup)),
    ("suffix_dedup", _cleared(stage_suffix_dedup)),
    ("mix", _cleared(stage_mix)),
    ("pack", _cleared(stage_pack)),
]

#: SQL cannot express the language model, the tokenizer or the packing; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
        discard(before)
    return docs
