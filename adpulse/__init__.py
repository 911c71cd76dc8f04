"""adpulse: ad-click stream analytics on Spark DataFrames and Structured Streaming."""

from adpulse.functions.parse import parse_clicks
from adpulse.operators.blacklist import (
    blacklist_rows,
    blacklist_sql,
    derive_blacklist,
    drop_flagged_users,
    filter_blacklisted,
)
from adpulse.operators.counts import click_counts, total_click_counts, typed_click_counts
from adpulse.operators.offsets import (
    advance_ledger,
    batch_offset_ranges,
    committed_offsets,
    latest_offsets,
    resume_read,
    start_positions,
)
from adpulse.operators.reports import daily_city_ad_clicks, hourly_trend, preview, top_ads, trend_last_hour
from adpulse.sinks.writers import append_click_counts, archive_messages, publish_blacklist, register_views
from adpulse.sources.stream import read_click_stream, starting_offsets_json
from adpulse.sources.tables import load_blacklist, read_table
from adpulse.streaming.feedback import ClickTables, hourly_trend_so_far, process_batch, run_click_stream
from adpulse.streaming.maintenance import compact_tables

__all__ = [
    "ClickTables",
    "advance_ledger",
    "append_click_counts",
    "archive_messages",
    "batch_offset_ranges",
    "blacklist_rows",
    "blacklist_sql",
    "click_counts",
    "committed_offsets",
    "compact_tables",
    "daily_city_ad_clicks",
    "derive_blacklist",
    "drop_flagged_users",
    "filter_blacklisted",
    "hourly_trend",
    "hourly_trend_so_far",
    "latest_offsets",
    "load_blacklist",
    "parse_clicks",
    "preview",
    "process_batch",
    "publish_blacklist",
    "read_click_stream",
    "read_table",
    "register_views",
    "resume_read",
    "run_click_stream",
    "start_positions",
    "starting_offsets_json",
    "top_ads",
    "total_click_counts",
    "trend_last_hour",
    "typed_click_counts",
]
