"""Write the physical plan of every batch query (formatted explain, tree part) to PLANS.md.

    python -m tools.plan_report [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import sys

NOTES = {
    "click_counts": "One scan (3 columns), partial + final aggregate: the shuffle carries one row per group per task.",
    "blacklist_users": "Aggregate, filter over the aggregate (HAVING), distinct: all partial-aggregated before shuffles.",
    "filter_blacklisted": "Anti join of the clicks with the derived blacklist, broadcast while the blacklist is small; "
    "beyond the broadcast threshold a shuffle join with AQE skew splitting.",
    "filter_by_bitmap": "A bitmap of the hashed blacklisted users (16 MB at most) is broadcast; clicks that miss it pass without a "
    "shuffle, those that hit it go through the exact anti join. The log is read once for each part.",
    "daily_city_ad_clicks": "One read of events: per-user counts, the offenders (HAVING) joined back to the "
    "same counts (one shared shuffle once it runs), then the geography join on counts, never on clicks.",
    "top_ads_by_province": "WindowGroupLimit before and after the shuffle: at most n rows per province per task move.",
    "hourly_trend": "One read of events: counts per (day, user, ad, 10-minute bucket), the offenders "
    "joined back to them (one shared scan and exchange once it runs), then the bucket counts spread over the six sliding windows.",
    "trend_last_hour": "The time range reaches the Parquet scan (PushedFilters on ts): only row groups of that hour are read.",
    "resume_read": "Start positions (one row per topic partition) are literal predicates; the log is neither joined with them nor shuffled.",
    "parse_click_log": "Narrow: JSON encode and decode stay in one codegen stage per task; the geography join has no "
    "hint: AQE broadcasts customer while its runtime size allows it, else a shuffle join with skew splitting.",
    "blacklist_rows": "Partial counts per batch, then their sum: two aggregations, both combined map-side.",
    "blacklist_rows_sql": "The same rule as SQL text: Catalyst gives the same aggregate-then-filter plan.",
    "blacklist_default_threshold": "One scan of three lineitem columns, partial + final aggregate, filter.",
    "top_ads_by_day_province": "As top_ads_by_province with the day in the window partition.",
    "latest_offsets": "One column-pruned scan (event_id only) and a partial aggregate per topic partition.",
    "start_positions": "Two aggregates of a few rows each (one per topic partition) and a full outer join of them.",
    "earliest_positions": "The partitions of the log, each starting at 0.",
    "batch_offset_ranges": "One partial aggregate per (batch, topic partition).",
    "partial_then_final_counts": "Partials written per batch (rebalanced by batch, so files number about as the batches and "
    "AQE splits a large one), read back and summed.",
    "typed_click_counts": "A stored count table read back with casts: narrow.",
    "preview": "Top-k by event_id (each task keeps 10), then only those users' geography rows are joined: the customer "
    "table is cut by a broadcast of at most 10 ids, never shuffled whole.",
    "archive_messages": "Narrow write of the message text, read back.",
    "archive_messages_table": "The same as a one-column table.",
    "blacklist_view_sql": "The rule as SQL over a registered view of stored partials: the same plan as `blacklist_rows_sql`.",
}

STREAMS = """## Stream queries

`explain` shows one micro-batch at a time; per batch of the click stream (`adpulse.streaming.feedback`):

- parse (narrow), anti join with the blacklist snapshot (`flagged` of earlier batches plus the seed), and one GROUPING SETS
  aggregation per (day, user, ad), (day, province, city, ad) and (minute, ad): one pass over the messages, one write
  into the batch's own folder of `counts` (by day and kind); the offset ranges are observed in the same pass;
- flagged users: stored totals of the groups that this batch touched. The semi join is an equality on the day, so the
  scan of the batches since the last compaction is pruned to the batch's days, and of the merged rows only these days'
  folders and the users' buckets are opened (`dynamicpruning` on `click_day` and `user_bucket`);
- published blacklist: the users new to it; ledger: one row per topic partition, from the observed ranges.

`compact_tables` bounds the number of folders. The trends are read from the minute counts. `adpulse.streaming.stateful` keeps
daily counts (update mode) and the trend's open buckets (watermark, corrections) in Spark's state instead.
"""


def main(argv: list[str]) -> None:
    sys.path.insert(0, ".")
    from adpulse.plans.catalog import batch_queries
    from adpulse.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans", "", f"`python -m tools.plan_report {sf_dir}` (formatted explain, tree part, before AQE re-planning).", ""]
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name, query in batch_queries().items():
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            query(spark, sf_dir).explain(mode="formatted")
        tree = buf.getvalue().split("\n\n")[0].replace("== Physical Plan ==\n", "")
        out += [f"## {name}", ""]
        if name in NOTES:
            out += [NOTES[name], ""]
        out += ["```", tree.rstrip(), "```", ""]
    with open("PLANS.md", "w") as fh:
        fh.write("\n".join(out) + "\n" + STREAMS)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
