"""The registered queries: each `(spark, sf_dir) -> DataFrame` over the driver's tables.

Operators come from `adpulse.operators` etc.; this module only wires them to
the fixture mapping (FIXTURES.md) and presents days and times as text
(`yyyy-MM-dd`, `yyyy-MM-dd HH:mm:ss`) so results compare across engines
without type quirks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adpulse.functions.parse import parse_clicks
from adpulse.operators.blacklist import (
    BLACKLIST_SQL,
    blacklist_rows,
    blacklist_sql,
    derive_blacklist,
    drop_flagged_users,
    filter_blacklisted,
    filter_by_bitmap,
)
from adpulse.operators.counts import click_counts, total_click_counts, typed_click_counts
from adpulse.operators.offsets import (
    batch_offset_ranges,
    committed_offsets,
    latest_offsets,
    resume_read,
    start_positions,
)
from adpulse.operators.reports import (
    daily_city_ad_clicks,
    preview,
    spread_buckets,
    top_ads,
    trend_buckets,
    trend_last_hour,
)
from adpulse.schema import DEFAULT_THRESHOLD
from adpulse.session import fresh_dir
from adpulse.sinks.writers import append_click_counts, archive_messages, register_views
from adpulse.sources.fixtures import (
    LEDGER_GROUP,
    TOPIC,
    clicks_from_events,
    ledger_from_messages,
    message_positions,
    messages_from_events,
    read_fixture,
    with_geography,
)
from adpulse.sources.tables import read_table

# Fixed parameters of the registered queries (FIXTURES.md): at the default
# threshold of 100 no (day, user, ad) group of `events` qualifies, so the
# blacklist queries over `events` use 1; `lineitem` covers the default.
TEST_THRESHOLD = 1
BATCH_EVENTS = 1000  # events per made batch: batch_id = event_id div 1000
TREND_AS_OF = "2024-01-15 12:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Days as `yyyy-MM-dd` text, times as `yyyy-MM-dd HH:mm:ss` text; other columns unchanged."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(field.name))
    return df.select(*out)


CLICK_OUT = ("topic", "partition", "offset", "user_id", "access_time", "province", "city", "adv_id", "click_day")


def clean_clicks(spark: SparkSession, sf_dir: str, threshold: int = TEST_THRESHOLD) -> DataFrame:
    """Clicks left after dropping the users blacklisted at `threshold` (input of the trend reports)."""
    clicks = clicks_from_events(spark, sf_dir, geography=False)
    return filter_blacklisted(clicks, derive_blacklist(click_counts(clicks), threshold, distinct=False))


def clean_city_counts(spark: SparkSession, sf_dir: str, threshold: int = TEST_THRESHOLD) -> DataFrame:
    """Counts per (day, user, ad) of the users not blacklisted at `threshold`, with province and city.

    Blacklisting and the place of a click are both properties of the user, so
    they apply to per-user counts exactly as to clicks: `events` is read once,
    the blacklist is applied to the counts by `drop_flagged_users` (the
    offenders joined back, over one shuffle of the counts), and the geography
    join moves counts, not clicks.
    """
    counts = click_counts(clicks_from_events(spark, sf_dir, geography=False))
    return with_geography(spark, sf_dir, drop_flagged_users(counts, threshold))


def with_batch(df: DataFrame) -> DataFrame:
    return df.withColumn("batch_id", F.expr(f"event_id div {BATCH_EVENTS}"))


# ---- clicks, counts, blacklist -------------------------------------------------


def q_parse_click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = parse_clicks(messages_from_events(spark, sf_dir), mode="FAILFAST")
    return present(
        clicks.select(*CLICK_OUT, F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))
    )


def q_click_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(click_counts(clicks_from_events(spark, sf_dir, geography=False)))


def q_blacklist_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = click_counts(with_batch(clicks_from_events(spark, sf_dir, geography=False)), batch_col="batch_id")
    return present(blacklist_rows(partials, TEST_THRESHOLD))


def q_blacklist_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_blacklist(click_counts(clicks_from_events(spark, sf_dir, geography=False)), TEST_THRESHOLD)


def q_blacklist_rows_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blacklist rule as SQL text over partial counts per made batch (one row per offending group)."""
    partials = click_counts(with_batch(clicks_from_events(spark, sf_dir, geography=False)), batch_col="batch_id")
    return blacklist_sql(partials, TEST_THRESHOLD)


LINE_KEYS = ("l_suppkey", "l_returnflag", "l_linestatus")


def q_blacklist_default_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_fixture(spark, sf_dir, "lineitem")
    return blacklist_rows(click_counts(lines, keys=LINE_KEYS), DEFAULT_THRESHOLD, keys=LINE_KEYS)


def q_filter_blacklisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks of users not blacklisted at threshold 1; province and city added after the filter."""
    clicks = clicks_from_events(spark, sf_dir, geography=False)
    left = filter_blacklisted(clicks, derive_blacklist(click_counts(clicks), TEST_THRESHOLD, distinct=False))
    return present(with_geography(spark, sf_dir, left).select(*CLICK_OUT))


def q_filter_by_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as `filter_blacklisted`, by the form for blacklists that cannot be broadcast."""
    clicks = clicks_from_events(spark, sf_dir)
    counts = click_counts(clicks_from_events(spark, sf_dir, geography=False))
    return present(filter_by_bitmap(clicks, derive_blacklist(counts, TEST_THRESHOLD, distinct=False)).select(*CLICK_OUT))


# ---- reports -------------------------------------------------------------------


def q_daily_city_ad_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(daily_city_ad_clicks(clean_city_counts(spark, sf_dir), counted=True))


def q_top_ads_by_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_ads(clean_city_counts(spark, sf_dir), by=("province",), n=3, counted=True)


def q_top_ads_by_day_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(top_ads(clean_city_counts(spark, sf_dir), by=("click_day", "province"), n=3, counted=True))


def q_hourly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 h / 10 min trend of the clicks of users not blacklisted at 1, in one read of `events`.

    Clicks are counted per (day, user, ad, 10-minute bucket); the blacklist is
    applied to those counts (`drop_flagged_users` totals them per (day, user,
    ad)); the buckets of the remaining users are spread over the sliding windows.
    """
    clicks = clicks_from_events(spark, sf_dir, geography=False)
    buckets = trend_buckets(clicks, "10 minutes", by=("click_day", "user_id", "adv_id"))
    clean = drop_flagged_users(buckets, TEST_THRESHOLD)
    return present(spread_buckets(clean, "1 hour", "10 minutes", by=("click_day", "adv_id"), aligned=True))


def q_trend_last_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(trend_last_hour(clean_clicks(spark, sf_dir), TREND_AS_OF))


def q_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 10 clicks by `event_id`; the 10 rows are enriched after the top-k, not the log before it."""
    first = preview(clicks_from_events(spark, sf_dir, geography=False), 10, order=("event_id",))
    return present(with_geography(spark, sf_dir, first, few_rows=True).select("event_id", *CLICK_OUT))


# ---- offsets -------------------------------------------------------------------


def q_latest_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_offsets(message_positions(spark, sf_dir))


def _starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = message_positions(spark, sf_dir)
    committed = committed_offsets(ledger_from_messages(messages), LEDGER_GROUP, TOPIC)
    return start_positions(latest_offsets(messages), committed)


def q_start_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _starts(spark, sf_dir)


def q_resume_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume_read(messages_from_events(spark, sf_dir), _starts(spark, sf_dir))


def q_earliest_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return start_positions(latest_offsets(message_positions(spark, sf_dir)), mode="earliest")


def q_batch_offset_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_offset_ranges(with_batch(message_positions(spark, sf_dir)), "batch_id")


# ---- sinks and read-back -------------------------------------------------------


def q_partial_then_final_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial counts per made batch are stored (one partition per batch), read back and summed."""
    table = fresh_dir(spark, "clickcount")
    partials = click_counts(with_batch(clicks_from_events(spark, sf_dir, geography=False)), batch_col="batch_id")
    append_click_counts(partials, table)
    return present(total_click_counts(read_table(spark, "clickcount", path=table)))


def q_typed_click_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts stored as text (as a database binds them), read back as typed records."""
    table = fresh_dir(spark, "clickcount_text")
    counts = click_counts(clicks_from_events(spark, sf_dir, geography=False))
    counts.select(
        "user_id", "adv_id", F.date_format("click_day", "yyyy-MM-dd").alias("click_day"), F.col("clicks").cast("string")
    ).write.parquet(table)
    return present(typed_click_counts(read_table(spark, "clickcount", path=table)))


def q_archive_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "archive")
    archive_messages(messages_from_events(spark, sf_dir), path, format="text")
    return spark.read.text(path)


def q_archive_messages_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw message appended to a one-column table, then read back."""
    path = fresh_dir(spark, "archive_table")
    archive_messages(messages_from_events(spark, sf_dir), path, format="table")
    return read_table(spark, "messages", path=path)


def q_blacklist_view_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blacklist rule in SQL over a registered view of the stored partial counts."""
    table = fresh_dir(spark, "clickcount_view")
    partials = click_counts(with_batch(clicks_from_events(spark, sf_dir, geography=False)), batch_col="batch_id")
    append_click_counts(partials, table)
    register_views(spark, clickcount=read_table(spark, "clickcount", path=table))
    return spark.sql(BLACKLIST_SQL.format(counts="clickcount"), args={"threshold": TEST_THRESHOLD})


def batch_queries() -> dict[str, Query]:
    return {
        "parse_click_log": q_parse_click_log,
        "click_counts": q_click_counts,
        "blacklist_rows": q_blacklist_rows,
        "blacklist_users": q_blacklist_users,
        "blacklist_rows_sql": q_blacklist_rows_sql,
        "blacklist_default_threshold": q_blacklist_default_threshold,
        "filter_blacklisted": q_filter_blacklisted,
        "filter_by_bitmap": q_filter_by_bitmap,
        "daily_city_ad_clicks": q_daily_city_ad_clicks,
        "top_ads_by_province": q_top_ads_by_province,
        "top_ads_by_day_province": q_top_ads_by_day_province,
        "hourly_trend": q_hourly_trend,
        "trend_last_hour": q_trend_last_hour,
        "latest_offsets": q_latest_offsets,
        "start_positions": q_start_positions,
        "resume_read": q_resume_read,
        "earliest_positions": q_earliest_positions,
        "batch_offset_ranges": q_batch_offset_ranges,
        "partial_then_final_counts": q_partial_then_final_counts,
        "typed_click_counts": q_typed_click_counts,
        "preview": q_preview,
        "archive_messages": q_archive_messages,
        "archive_messages_table": q_archive_messages_table,
        "blacklist_view_sql": q_blacklist_view_sql,
    }
