"""Operator 1: mix sources to target weights.

Sizes are summed per source, targets are shared out by weight, and a document of a
source with rate r = target / size is emitted floor(r) times plus one more time
with probability r - floor(r), drawn from a hash of the seed, its doc_id, its text and
its place among the rows that are equal in both: no two rows share a draw.

Targets: sources in order of code point, null last, weigh `weights` in turn. All
targets share `share` times the summed sizes; a target stops at `most` times its
source's size, and what is cut off is shared out again by weight. The final level
is found in closed form: with sources sorted by cap / weight, the capped ones come
first, and the others get the rest by weight.

Null and empty texts have size 0: they are emitted as their source's rate says, and
add no words. Sources of size 0 get rate 0. Rows that repeat
a doc_id, or have none, draw each on its own. Very long texts are counted whole; empty tables give no rows. Extra columns are kept by `mixed` (a copy number joins as `copy_name`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import pick, staged

SHARE = 1.5
MOST = 2.0
WEIGHTS = (3, 1, 2)
SEED = 20250
WORD_GAP = r"[\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Number of words `[^\\x20\\x09-\\x0D]+`; 0 for null. The gaps cut a text into words, and maybe an empty end or two."""
    pieces = F.split(text, WORD_GAP, -1)
    ends = (pieces[0] == "").cast("int") + ((F.size(pieces) > 1) & (F.element_at(pieces, -1) == "")).cast("int")
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(pieces) - ends).cast("long")


def source_targets(
    sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: Sequence[float] = WEIGHTS
) -> DataFrame:
    """`source`, `source_size`, `target` from `sizes` (`source`, `source_size`, one row per source).

    One row per source and no document goes through the ordered windows.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    weighed = sizes.withColumn("weight", turn).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    ordered = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    everything = Window.partitionBy()
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    from_here = ordered.rowsBetween(0, Window.unboundedFollowing)
    budget = F.least(F.sum("source_size").over(everything) * F.lit(float(share)), F.sum("cap").over(everything))
    levels = weighed.withColumn(
        "level",
        (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(from_here),
    )
    # A source is capped if the level that it would get reaches cap / weight; the first that is not fixes the level.
    uncapped = F.when(F.col("level") * F.col("weight") < F.col("cap"), F.col("level"))
    in_order = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    open_level = F.first(uncapped, ignorenulls=True).over(in_order)
    return levels.withColumn("open_level", open_level).select(
        "source",
        "source_size",
        F.when(F.col("open_level").isNull(), F.col("cap"))
        .otherwise(F.least(F.col("cap"), F.col("open_level") * F.col("weight")))
        .alias("target"),
    )


def _draw(doc_id: Column, text: Column, place: Column, seed: int) -> Column:
    """A number from 0 to 1 by the first 52 bits of md5 of `seed:doc_id:md5 of the text:place`."""
    named = [F.coalesce(c.cast("string"), F.lit("null")) for c in (doc_id, text, place)]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *named))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


KEY = ["id_known", "text_known", "key_id", "key_text"]


def _keyed(rows: DataFrame) -> DataFrame:
    """`rows` (`doc_id`, `text_md5` and more) with both as null-free join keys."""
    return rows.select(
        "*", F.col("doc_id").isNotNull().alias("id_known"), F.col("text_md5").isNotNull().alias("text_known"),
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("key_id"), F.coalesce("text_md5", F.lit("")).alias("key_text"),
    )


def _equals(sized: DataFrame) -> DataFrame:
    """The (doc_id, text) that several rows share: normally few."""
    return staged(_keyed(sized).groupBy(*KEY).agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "mix_equals")


def _drawn(rows: DataFrame, equals: DataFrame, seed: int) -> DataFrame:
    """`rows` (`doc_id`, `text_md5` and more) with `draw`.

    Only rows that have an equal are numbered, and written for it: within each written partition, whose counts give
    the offsets, so a group of equal rows of any size is shared by as many tasks as wrote it. The others stay where
    they are wherever `equals` is small enough to be broadcast.
    """
    keyed = _keyed(rows)
    drawn = keyed.join(equals, KEY, "left_anti").withColumn("place", F.lit(0).cast("long")).select(*rows.columns, "place")
    if not equals.isEmpty():
        several = keyed.join(equals, KEY, "left_semi")
        several = several.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
        several = staged(several, "mix_repeated", compression="zstd")
        per_part = several.groupBy(*KEY, "part").agg(F.count("*").alias("n"))
        before = Window.partitionBy(*KEY).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        offsets = per_part.select(*KEY, "part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("before"))
        number = F.row_number().over(Window.partitionBy(*KEY, "part").orderBy("at")) - 1
        places = several.select(*KEY, "part", "at", number.alias("number")).join(offsets, [*KEY, "part"])
        places = places.select("at", (F.col("before") + F.col("number")).alias("place"))
        drawn = drawn.unionAll(several.join(places, "at").select(*rows.columns, "place"))
    return drawn.withColumn("draw", _draw(F.col("doc_id"), F.col("text_md5"), F.col("place"), seed)).drop("place")


def _counted(rows: DataFrame, sizes: DataFrame, share: float, most: float, weights: Sequence[float]) -> DataFrame:
    """`rows` (`source`, `draw` and more) with `source_size`, `target` and `copies`."""
    # One row per source, written so that Spark knows its size: small, it is broadcast; large, AQE splits hot sources.
    targets = staged(source_targets(sizes, share, most, weights), "mix_targets")
    named = targets.withColumn("known", F.col("source").isNotNull()).withColumn("source", F.coalesce("source", F.lit("")))
    keyed = rows.withColumn("known", F.col("source").isNotNull()).withColumn("source", F.coalesce("source", F.lit("")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    copies = F.floor(rate) + F.when(F.col("draw") < rate - F.floor(rate), 1).otherwise(0)
    return keyed.join(named, ["known", "source"]).withColumn("copies", copies.cast("long"))


def mixed(
    docs: DataFrame,
    copy_name: str | None = None,
    share: float = SHARE,
    most: float = MOST,
    weights: Sequence[float] = WEIGHTS,
    seed: int = SEED,
) -> DataFrame:
    """The mix itself: every row of `docs` as many times as it is taken, numbered from 0 in `copy_name` if given."""
    names = docs.columns
    row = docs.toDF(*[f"c{at}" for at in range(len(names))])
    at = {name: F.col(f"c{k}") for k, name in reversed(list(enumerate(names)))}
    key = [at["doc_id"].cast("long").alias("doc_id"), at["source"].alias("source"), F.md5(at["text"]).alias("text_md5")]
    sized = staged(row.select(*key, n_words(at["text"]).alias("size")), "mix_rows")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = _drawn(row.select(F.struct(*row.columns).alias("row"), *key), _equals(sized), seed)
    taken = _counted(rows, sizes, share, most, weights).filter("copies > 0")
    emitted = taken.select("row", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    columns = [F.col(f"row.c{k}").alias(name) for k, name in enumerate(names)]
    return emitted.select(*columns, *([F.col("copy").alias(copy_name)] if copy_name else []))


def mix_report(
    docs: DataFrame,
    share: float = SHARE,
    most: float = MOST,
    weights: Sequence[float] = WEIGHTS,
    seed: int = SEED,
) -> DataFrame:
    """`doc_id`, `size`, `source_size`, `target`, `taken` (words that the mix takes) for every row of `docs`."""
    rows = pick(docs, "doc_id", "text", "source").withColumn("doc_id", F.col("doc_id").cast("long"))
    sized = rows.select("doc_id", "source", F.md5("text").alias("text_md5"), n_words(F.col("text")).alias("size"))
    rows = staged(sized, "mix_rows")
    placed = _drawn(rows, _equals(rows), seed)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    counted = _counted(placed, sizes, share, most, weights)
    return counted.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
