"""Click reports: daily city counts, top ads per region, hourly trend, preview.

All are `DataFrame -> DataFrame` over parsed clicks (or over stored partial
counts, for the ones marked so) and serve batch and stream alike where Spark
allows it (`top_ads` needs a batch: ranking windows are not allowed on a stream,
so the stream runs it inside `foreachBatch` over accumulated counts).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CITY_KEYS = ("click_day", "province", "city", "adv_id")

# Defaults for the open points of the stated requirements.
DEFAULT_TOP_N = 3
DEFAULT_WINDOW = "1 hour"
DEFAULT_SLIDE = "10 minutes"


def _count(counted: bool):
    return F.sum("clicks").cast("bigint").alias("clicks") if counted else F.count(F.lit(1)).alias("clicks")


def daily_city_ad_clicks(clicks: DataFrame, counted: bool = False) -> DataFrame:
    """Clicks per (day, province, city, ad): `click_day, province, city, adv_id, clicks`.

    `counted=True` takes partial counts (a `clicks` column, any finer grouping)
    instead of clicks.
    """
    return clicks.groupBy(*CITY_KEYS).agg(_count(counted))


def top_ads(
    clicks: DataFrame,
    by: Sequence[str] = ("province",),
    n: int = DEFAULT_TOP_N,
    counted: bool = False,
) -> DataFrame:
    """The `n` most clicked ads per group `by`; ties go to the smaller `adv_id`.

    `counted=True` takes partial counts (`by..., adv_id, clicks`, several rows
    per group allowed) instead of clicks. Output: `by..., adv_id, clicks, rank`.

    The filter on `row_number() <= n` lets Spark insert a partial
    `WindowGroupLimit` before the shuffle, so each map task sends at most `n`
    rows per group and no group is ever fully sorted in one task.
    """
    counts = clicks.groupBy(*by, "adv_id").agg(_count(counted))
    order = Window.partitionBy(*by).orderBy(F.col("clicks").desc(), F.col("adv_id").asc_nulls_last())
    return (
        counts.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
        .withColumn("rank", F.col("rank").cast("bigint"))
    )


# Seconds per interval unit accepted by `interval_seconds`.
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def interval_seconds(text: str) -> int | None:
    """Seconds in an interval text such as "10 minutes" or "1 hour 30 minutes"; None if not understood."""
    words = text.lower().replace("interval", "").split()
    if not words or len(words) % 2:
        return None
    total = 0
    for count, unit in zip(words[::2], words[1::2]):
        seconds = UNIT_SECONDS.get(unit.rstrip("s"))
        if seconds is None or not count.isdigit():
            return None
        total += int(count) * seconds
    return total


def hourly_trend(
    clicks: DataFrame,
    length: str = DEFAULT_WINDOW,
    slide: str = DEFAULT_SLIDE,
    by: Sequence[str] = ("click_day", "adv_id"),
    pre_aggregate: bool = True,
) -> DataFrame:
    """Clicks per ad and day in sliding windows of `length` every `slide`.

    Output: `by..., window_start, window_end, clicks`. Clicks with only a day
    (no time) have no place in a window and are left out.

    A sliding window copies every click into `length / slide` windows before
    counting. When `length` is a whole number of slides (1 hour / 10 minutes),
    all clicks of one `slide`-long bucket fall into the same windows, so the
    clicks are first counted per bucket (a tumbling window, no copies) and only
    the bucket counts are spread over the sliding windows. Same result, and the
    raw clicks are read once and never multiplied. `pre_aggregate=False` keeps
    the one-step form (one aggregation, as a stream with a watermark needs it).
    """
    timed = clicks.where(F.col("ts").isNotNull())
    if pre_aggregate and bucketable(length, slide):
        return spread_buckets(trend_buckets(timed, slide, by), length, slide, by, aligned=True)
    windows = timed.groupBy(*by, F.window("ts", length, slide).alias("w")).agg(F.count(F.lit(1)).alias("clicks"))
    return windows.select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "clicks")


def bucketable(length: str, slide: str) -> bool:
    """Whether sliding windows of `length` every `slide` can be built from `slide`-long buckets."""
    step, span = interval_seconds(slide), interval_seconds(length)
    return bool(step and span and span % step == 0)


def trend_buckets(clicks: DataFrame, slide: str = DEFAULT_SLIDE, by: Sequence[str] = ("click_day", "adv_id")) -> DataFrame:
    """Clicks per `by` and `slide`-long bucket (a tumbling window): `by..., bucket, clicks`."""
    timed = clicks.where(F.col("ts").isNotNull())
    return timed.groupBy(*by, F.window("ts", slide).start.alias("bucket")).agg(F.count(F.lit(1)).alias("clicks"))


def spread_buckets(
    buckets: DataFrame,
    length: str = DEFAULT_WINDOW,
    slide: str = DEFAULT_SLIDE,
    by: Sequence[str] = ("click_day", "adv_id"),
    aligned: bool = False,
) -> DataFrame:
    """Sliding-window counts from bucket counts (any finer grouping allowed): `by..., window_start, window_end, clicks`.

    `aligned=True` is for buckets that are starts of `slide`-long ones (`trend_buckets`): their windows follow by
    subtraction, without the filters that `window` puts on its input, so that what stands below keeps a plan
    that Spark can reuse.
    """
    if not aligned:
        windows = buckets.groupBy(*by, F.window("bucket", length, slide).alias("w")).agg(
            F.sum("clicks").cast("bigint").alias("clicks")
        )
        return windows.select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "clicks")
    step, span = interval_seconds(slide), interval_seconds(length)
    starts = F.array(*[F.col("bucket") - F.expr(f"INTERVAL {at} SECONDS") for at in range(0, span, step)])
    spread = buckets.select(*by, F.explode(starts).alias("window_start"), "clicks")
    windows = spread.groupBy(*by, "window_start").agg(F.sum("clicks").cast("bigint").alias("clicks"))
    return windows.select(*by, "window_start", (F.col("window_start") + F.expr(f"INTERVAL {span} SECONDS")).alias("window_end"), "clicks")


def _time_literal(clicks: DataFrame, column: str, value: str) -> Column:
    """`value` typed like `column` (TIMESTAMP or TIMESTAMP_NTZ), so the predicate reaches the scan."""
    kind = clicks.schema[column].dataType
    return F.lit(value).cast("timestamp_ntz" if isinstance(kind, T.TimestampNTZType) else "timestamp")


def trend_last_hour(clicks: DataFrame, as_of: str, span: str = "1 hour", unit: str = "minute") -> DataFrame:
    """Per-`unit` clicks per ad in the `span` up to `as_of`: ts in (as_of - span, as_of].

    Output: `minute, adv_id, clicks` (the bucket column keeps the name `minute`
    whatever `unit` is).
    """
    end = _time_literal(clicks, "ts", as_of)
    start = end - F.expr(f"INTERVAL {span}")
    return (
        clicks.where((F.col("ts") > start) & (F.col("ts") <= end))
        .groupBy(F.date_trunc(unit, "ts").alias("minute"), "adv_id")
        .agg(F.count(F.lit(1)).alias("clicks"))
    )


def preview(df: DataFrame, n: int = 10, order: Sequence[str] = ("topic", "partition", "offset")) -> DataFrame:
    """The first `n` rows in a stated order (a top-k: each task keeps `n`, the driver merges)."""
    return df.orderBy(*order).limit(n)
