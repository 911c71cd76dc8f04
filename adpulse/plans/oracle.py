"""DuckDB SQL equal to each registered query, over the driver's pre-registered views.

Each statement is `WITH <the views it needs> <final select>`; the views restate
the fixture mapping of FIXTURES.md in SQL.
"""

from __future__ import annotations

DAY = "'%Y-%m-%d'"
TIME = "'%Y-%m-%d %H:%M:%S'"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "clicks": (
        (),
        """SELECT e.event_id,
       'clicks' AS topic,
       CAST(e.event_id % 4 AS INTEGER) AS "partition",
       CAST(e.event_id // 4 AS BIGINT) AS "offset",
       CAST(e.user_id AS VARCHAR) AS user_id,
       strftime(e.ts, '%Y-%m-%d %H:%M:%S.%f') AS access_time,
       r.r_name AS province,
       n.n_name AS city,
       json_extract_string(e.props, '$.k') AS adv_id,
       e.ts AS ts,
       CAST(e.ts AS DATE) AS click_day
FROM events e
LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""",
    ),
    "counts": (
        ("clicks",),
        "SELECT click_day, user_id, adv_id, count(*) AS clicks FROM clicks GROUP BY click_day, user_id, adv_id",
    ),
    "bl1": (("counts",), "SELECT DISTINCT user_id FROM counts WHERE clicks > 1 AND user_id IS NOT NULL"),
    "clean": (
        ("clicks", "bl1"),
        "SELECT * FROM clicks k WHERE NOT EXISTS (SELECT 1 FROM bl1 b WHERE b.user_id = k.user_id)",
    ),
    # The streams read the log in 5 slices of event_id: a group above 1 click at the end of slice s (the slice of its
    # second click) drops its user from slice s + 1 on.
    "sliced": (
        ("clicks",),
        """SELECT k.*, (event_id - lo) // ((hi - lo) // 5 + 1) AS slice
FROM clicks k, (SELECT min(event_id) AS lo, max(event_id) AS hi FROM clicks) b""",
    ),
    "crossed": (
        ("sliced",),
        """SELECT user_id, min(slice) AS last_slice FROM (
  SELECT user_id, slice, row_number() OVER (PARTITION BY click_day, user_id, adv_id ORDER BY slice) AS nth FROM sliced
) WHERE nth = 2 AND user_id IS NOT NULL GROUP BY user_id""",
    ),
    "stream_clean": (
        ("sliced", "crossed"),
        """SELECT s.* FROM sliced s LEFT JOIN crossed c ON c.user_id = s.user_id
WHERE c.last_slice IS NULL OR s.slice <= c.last_slice""",
    ),
    # The outside blacklist drops its users from the first slice on.
    "seeded_clean": (
        ("stream_clean",),
        """SELECT * FROM stream_clean s
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey % 7 = 0 AND CAST(c.c_custkey AS VARCHAR) = s.user_id)""",
    ),
    "messages": (
        ("clicks",),
        """SELECT event_id, topic, "partition", "offset",
       CAST(to_json(struct_pack(userId := user_id, accessTime := access_time, province := province,
                                city := city, advId := adv_id)) AS VARCHAR) AS value
FROM clicks""",
    ),
    "latest": (
        ("messages",),
        'SELECT topic, "partition", CAST(max("offset") + 1 AS BIGINT) AS latest_offset FROM messages GROUP BY topic, "partition"',
    ),
    "ledger": (
        ("messages",),
        """SELECT 'ad-clicks' AS group_id, topic, "partition", (max("offset") + 1) // 2 AS "offset"
FROM messages WHERE "partition" < 3 GROUP BY topic, "partition\"""",
    ),
    "committed": (
        ("ledger",),
        """SELECT topic, "partition", CAST(max("offset") AS BIGINT) AS committed_offset
FROM ledger WHERE group_id = 'ad-clicks' AND topic = 'clicks' GROUP BY topic, "partition\"""",
    ),
    "starts": (
        ("latest", "committed"),
        """SELECT coalesce(l.topic, c.topic) AS topic,
       coalesce(l."partition", c."partition") AS "partition",
       l.latest_offset,
       c.committed_offset,
       coalesce(c.committed_offset, l.latest_offset) AS start_offset,
       coalesce(c.committed_offset > l.latest_offset, false) AS committed_above_latest
FROM latest l FULL OUTER JOIN committed c ON l.topic = c.topic AND l."partition" = c."partition\"""",
    ),
}


def with_views(final: str, *needed: str) -> str:
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in VIEWS[name][0]:
            visit(dep)
        order.append(name)

    for name in needed:
        visit(name)
    ctes = ",\n".join(f"{name} AS (\n{VIEWS[name][1]}\n)" for name in order)
    return f"WITH {ctes}\n{final}"


CLICK_OUT = (
    f'topic, "partition", "offset", user_id, access_time, province, city, adv_id, strftime(click_day, {DAY}) AS click_day'
)

COUNTS_OUT = f"SELECT strftime(click_day, {DAY}) AS click_day, user_id, adv_id, clicks FROM counts"


def _top_ads(by: str, by_out: str, clean: str = "clean") -> str:
    return with_views(
        f"""SELECT {by_out}, adv_id, clicks, "rank" FROM (
  SELECT {by}, adv_id, count(*) AS clicks,
         row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, adv_id ASC) AS "rank"
  FROM {clean} GROUP BY {by}, adv_id
) WHERE "rank" <= 3""",
        clean,
    )


def _daily_city_ad_clicks(clean: str = "clean") -> str:
    return with_views(
        f"""SELECT strftime(click_day, {DAY}) AS click_day, province, city, adv_id, count(*) AS clicks
FROM {clean} GROUP BY click_day, province, city, adv_id""",
        clean,
    )


def _hourly_trend(clean: str = "clean") -> str:
    return with_views(
        f"""SELECT strftime(click_day, {DAY}) AS click_day, adv_id,
       strftime(ws, {TIME}) AS window_start,
       strftime(ws + INTERVAL 1 HOUR, {TIME}) AS window_end,
       count(*) AS clicks
FROM (SELECT click_day, adv_id,
             time_bucket(INTERVAL 10 MINUTES, ts) - unnest(generate_series(0, 5)) * INTERVAL 10 MINUTES AS ws
      FROM {clean} WHERE ts IS NOT NULL) w
GROUP BY click_day, adv_id, ws""",
        clean,
    )


def _trend_last_hour(clean: str = "clean") -> str:
    return with_views(
        f"""SELECT strftime(date_trunc('minute', ts), {TIME}) AS minute, adv_id, count(*) AS clicks
FROM {clean}
WHERE ts > TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 1 HOUR AND ts <= TIMESTAMP '2024-01-15 12:00:00'
GROUP BY date_trunc('minute', ts), adv_id""",
        clean,
    )


STATEMENTS: dict[str, str] = {
    "parse_click_log": with_views(
        f"SELECT {CLICK_OUT}, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM clicks", "clicks"
    ),
    "click_counts": with_views(COUNTS_OUT, "counts"),
    "blacklist_rows": with_views(
        f"""SELECT strftime(click_day, {DAY}) AS click_day, user_id, adv_id, CAST(sum(clicks) AS BIGINT) AS clicks
FROM (SELECT event_id // 1000 AS batch_id, click_day, user_id, adv_id, count(*) AS clicks
      FROM clicks GROUP BY batch_id, click_day, user_id, adv_id) partials
GROUP BY click_day, user_id, adv_id HAVING sum(clicks) > 1""",
        "clicks",
    ),
    "blacklist_users": with_views("SELECT user_id FROM bl1", "bl1"),
    "blacklist_rows_sql": with_views("SELECT user_id FROM counts WHERE clicks > 1 AND user_id IS NOT NULL", "counts"),
    "blacklist_default_threshold": """SELECT l_suppkey, l_returnflag, l_linestatus, count(*) AS clicks
FROM lineitem GROUP BY l_suppkey, l_returnflag, l_linestatus HAVING count(*) > 100""",
    "filter_blacklisted": with_views(
        f"SELECT {CLICK_OUT} FROM clicks k WHERE NOT EXISTS (SELECT 1 FROM bl1 b WHERE b.user_id = k.user_id)",
        "clicks",
        "bl1",
    ),
    "daily_city_ad_clicks": _daily_city_ad_clicks(),
    "top_ads_by_province": _top_ads("province", "province"),
    "top_ads_by_day_province": _top_ads("click_day, province", f"strftime(click_day, {DAY}) AS click_day, province"),
    "hourly_trend": _hourly_trend(),
    "trend_last_hour": _trend_last_hour(),
    "latest_offsets": with_views("SELECT * FROM latest", "latest"),
    "start_positions": with_views("SELECT * FROM starts", "starts"),
    "resume_read": with_views(
        """SELECT m.topic, m."partition", m."offset", m.value
FROM messages m JOIN starts s ON m.topic = s.topic AND m."partition" = s."partition"
WHERE m."offset" >= s.start_offset""",
        "messages",
        "starts",
    ),
    "earliest_positions": with_views(
        'SELECT topic, "partition", CAST(0 AS BIGINT) AS start_offset FROM latest', "latest"
    ),
    "batch_offset_ranges": with_views(
        """SELECT event_id // 1000 AS batch_id, topic, "partition",
       CAST(min("offset") AS BIGINT) AS from_offset, CAST(max("offset") + 1 AS BIGINT) AS until_offset
FROM messages GROUP BY batch_id, topic, "partition\"""",
        "messages",
    ),
    "partial_then_final_counts": with_views(COUNTS_OUT, "counts"),
    "typed_click_counts": with_views(
        f"SELECT user_id, adv_id, strftime(click_day, {DAY}) AS click_day, CAST(clicks AS INTEGER) AS clicks FROM counts",
        "counts",
    ),
    "preview": with_views(f"SELECT event_id, {CLICK_OUT} FROM clicks ORDER BY event_id LIMIT 10", "clicks"),
    "archive_messages": with_views("SELECT value FROM messages", "messages"),
    "archive_messages_table": with_views("SELECT value FROM messages", "messages"),
    "blacklist_view_sql": with_views("SELECT user_id FROM counts WHERE clicks > 1 AND user_id IS NOT NULL", "counts"),
}

STATEMENTS.update(
    {
        "filter_by_bitmap": STATEMENTS["filter_blacklisted"],
        "stream_capped_blacklist": STATEMENTS["blacklist_users"],
        "stream_running_top_ads": _top_ads("province", "province", "stream_clean"),
        "stream_daily_city_ad_clicks": _daily_city_ad_clicks("stream_clean"),
        "stream_blacklist_users": STATEMENTS["blacklist_users"],
        "stream_top_ads_by_province": _top_ads("province", "province", "stream_clean"),
        "stream_trend_last_hour": _trend_last_hour("stream_clean"),
        "stream_committed_offsets": with_views(
            'SELECT topic, "partition", latest_offset AS committed_offset FROM latest', "latest"
        ),
        "stream_offset_ranges": with_views(
            """SELECT slice AS batch_id, topic, "partition",
       CAST(min("offset") AS BIGINT) AS from_offset, CAST(max("offset") + 1 AS BIGINT) AS until_offset
FROM sliced GROUP BY slice, topic, "partition\"""",
            "sliced",
        ),
        "stream_interval": _daily_city_ad_clicks("clicks"),
        "stream_daily_totals": _daily_city_ad_clicks(),
        "stream_trend_state": _hourly_trend(),
        "stream_hourly_trend": _hourly_trend("stream_clean"),
        "stream_clean_clicks": with_views(f"SELECT {CLICK_OUT} FROM stream_clean", "stream_clean"),
        "stream_seeded_blacklist": _daily_city_ad_clicks("seeded_clean"),
        "stream_resume": with_views(
            f"""SELECT {CLICK_OUT} FROM (
  SELECT k.* FROM clicks k JOIN starts s ON k.topic = s.topic AND k."partition" = s."partition"
  WHERE k."offset" >= s.start_offset
)""",
            "clicks",
            "starts",
        ),
    }
)
