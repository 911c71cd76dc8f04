"""Reports kept in Spark's streaming state, for streams that need no blacklist feedback.

Both write per micro-batch, replacing the batch's folder as a whole, so a replay leaves what one run would:

* `start_daily_city_counts` (A4): a stateful aggregation in update mode. Each batch stores the new totals of the
  groups that it changed; a reader takes the latest one of each group.
* `start_trend_state` (T7): per ad, the open buckets of the sliding trend, bounded by a watermark. A bucket that the
  watermark has passed leaves the state; clicks that come later still are not dropped but counted in a
  correction table. Totals plus corrections are exact, whatever arrives late.

Clicks of blacklisted users are dropped against a stored list (`read_blacklist`), fixed for a run.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from adpulse.functions.parse import parse_clicks
from adpulse.operators.blacklist import filter_blacklisted
from adpulse.operators.reports import (
    CITY_KEYS,
    DEFAULT_SLIDE,
    DEFAULT_WINDOW,
    bucketable,
    daily_city_ad_clicks,
    interval_seconds,
    spread_buckets,
)
from adpulse.schema import DEFAULT_TRIGGER
from adpulse.sinks.writers import ensure_table, read_batches, write_batch

TOTALS_SCHEMA = T.StructType(
    [
        T.StructField("click_day", T.DateType()),
        T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("adv_id", T.StringType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# How long a bucket stays open for late clicks.
DEFAULT_DELAY = "2 hours"
# A hot ad's state is spread over this many keys, by a hash of the user.
STATE_SHARDS = 4


def _clean(messages: DataFrame, blacklist: DataFrame | None) -> DataFrame:
    clicks = parse_clicks(messages)
    return clicks if blacklist is None else filter_blacklisted(clicks, blacklist)


def _trigger(trigger: dict | None) -> dict:
    return trigger or {"processingTime": DEFAULT_TRIGGER}


# ---- daily counts, update mode -------------------------------------------------


def start_daily_city_counts(
    spark: SparkSession, messages: DataFrame, root: str, blacklist: DataFrame | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the clicks per (day, province, city, ad) in streaming state, and upsert the groups that a batch changed.

    The state holds a row per group; it has no watermark, so a late click of any day counts. Read with
    `daily_city_totals`.
    """
    totals = f"{root}/totals"
    ensure_table(spark, totals, TOTALS_SCHEMA)
    counts = daily_city_ad_clicks(_clean(messages, blacklist))
    writer = counts.writeStream.outputMode("update").option("checkpointLocation", f"{root}/_checkpoint")
    return writer.foreachBatch(lambda rows, k: write_batch(rows, totals, k)).trigger(**_trigger(trigger)).start()


def daily_city_totals(spark: SparkSession, root: str) -> DataFrame:
    """The latest total of each group. A total only grows, so its latest is its largest."""
    return read_batches(spark, f"{root}/totals", TOTALS_SCHEMA).groupBy(*CITY_KEYS).agg(F.max("clicks").alias("clicks"))


# ---- sliding trend, watermark and corrections ------------------------------------


@dataclass(frozen=True)
class TrendState:
    """Where a trend stream keeps its buckets, and how they are cut."""

    root: str
    length: str = DEFAULT_WINDOW
    slide: str = DEFAULT_SLIDE
    delay: str = DEFAULT_DELAY
    shards: int = STATE_SHARDS

    @property
    def buckets(self) -> str:
        return f"{self.root}/buckets"

    def open_buckets(self) -> int:
        """The most buckets that one key holds open: those that the delay reaches back over, and the newest."""
        return -(-interval_seconds(self.delay) // interval_seconds(self.slide)) + 1


# `late`: an addition behind the watermark; otherwise the bucket's total so far.
BUCKET_OUT = T.StructType(
    [
        T.StructField("adv_id", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("late", T.BooleanType()),
    ]
)
BUCKET_SCHEMA = T.StructType([*BUCKET_OUT.fields, T.StructField("batch_id", T.LongType())])
_STATE = T.StructType(
    [
        T.StructField("watermark", T.LongType()),
        T.StructField("bucket", T.ArrayType(T.LongType())),
        T.StructField("clicks", T.ArrayType(T.LongType())),
    ]
)
_EVER = -(1 << 62)


def _advance(step: int, delay: int):
    """Per key: add a batch's clicks to the open buckets, and put those behind the watermark aside as late."""

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark, bucket, clicks = state.get if state.exists else (_EVER, [], [])
        held = dict(zip(bucket, clicks))
        came: dict[int, int] = {}
        newest = _EVER
        for rows in batches:  # a hot key comes in several
            newest = max(newest, int(rows["second"].max()))
            for at, n in (rows["second"] // step * step).value_counts().items():
                came[int(at)] = came.get(int(at), 0) + int(n)
        late = {at: n for at, n in came.items() if at + step <= watermark}
        for at in came.keys() - late.keys():
            held[at] = held.get(at, 0) + came[at]
        out = [(key[0], key[1], at, n, True) for at, n in sorted(late.items())]
        out += [(key[0], key[1], at, held[at], False) for at in sorted(came.keys() - late.keys())]
        watermark = max(watermark, newest - delay)
        still = sorted(at for at in held if at + step > watermark)
        state.update((watermark, still, [held[at] for at in still]))
        yield pd.DataFrame(out, columns=BUCKET_OUT.fieldNames())

    return advance


def start_trend_state(
    spark: SparkSession, messages: DataFrame, tables: TrendState, blacklist: DataFrame | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the sliding trend's open buckets in streaming state (see module doc); read with `trend_from_state`.

    A key is an ad and a hash of the user, so a hot ad is spread over `tables.shards` tasks; a null ad is a key like
    any other. Each key has its own watermark, `delay` behind its newest click, and holds at most
    `tables.open_buckets()` buckets.
    """
    step, delay = interval_seconds(tables.slide), interval_seconds(tables.delay)
    if not bucketable(tables.length, tables.slide) or delay is None:
        raise ValueError(f"windows of {tables.length!r} every {tables.slide!r} cannot be built from buckets")
    ensure_table(spark, tables.buckets, BUCKET_SCHEMA)
    timed = _clean(messages, blacklist).where(F.col("ts").isNotNull())
    rows = timed.select(
        "adv_id",
        F.pmod(F.xxhash64("user_id"), F.lit(tables.shards)).cast("int").alias("shard"),
        F.floor(F.unix_micros("ts") / 1_000_000).alias("second"),
    )
    changed = rows.groupBy("adv_id", "shard").applyInPandasWithState(
        _advance(step, delay), BUCKET_OUT, _STATE, "update", GroupStateTimeout.NoTimeout
    )
    writer = changed.writeStream.outputMode("update").option("checkpointLocation", f"{tables.root}/_checkpoint")
    return writer.foreachBatch(lambda out, k: write_batch(out, tables.buckets, k)).trigger(**_trigger(trigger)).start()


def trend_from_state(spark: SparkSession, tables: TrendState, by: Sequence[str] = ("click_day", "adv_id")) -> DataFrame:
    """`hourly_trend` of all clicks so far: the buckets' latest totals and all corrections, spread over the windows."""
    rows = read_batches(spark, tables.buckets, BUCKET_SCHEMA)
    key = ["adv_id", "shard", "bucket"]
    # A total only grows while its bucket is open: the latest is the largest.
    kept = rows.where(~F.col("late")).groupBy(*key).agg(F.max("clicks").alias("clicks"))
    added = rows.where("late").select(*key, "clicks")
    buckets = kept.unionByName(added).select("adv_id", F.timestamp_seconds("bucket").alias("bucket"), "clicks")
    buckets = buckets.withColumn("click_day", F.to_date("bucket"))
    return spread_buckets(buckets, tables.length, tables.slide, by, aligned=True)

