"""Blacklist derivation and filtering.

A user is blacklisted when one (day, ad) group of theirs holds more than
`threshold` clicks (strictly greater). The blacklist is per user and permanent:
it removes that user's clicks on every day and every ad.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.operators.counts import COUNT_KEYS, total_click_counts
from adpulse.schema import DEFAULT_THRESHOLD


def blacklist_rows(
    counts: DataFrame,
    threshold: int = DEFAULT_THRESHOLD,
    keys: Sequence[str] = COUNT_KEYS,
    count_col: str = "clicks",
) -> DataFrame:
    """Offending groups: one row per (day, user, ad) whose total is above `threshold`.

    `counts` may hold several partial rows per group (one per batch); they are
    summed per group first, then the predicate runs over the aggregate (a
    HAVING).
    """
    return total_click_counts(counts, keys, count_col).where(F.col("clicks") > F.lit(threshold))


def derive_blacklist(
    counts: DataFrame,
    threshold: int = DEFAULT_THRESHOLD,
    keys: Sequence[str] = COUNT_KEYS,
    user_col: str = "user_id",
    count_col: str = "clicks",
    distinct: bool = True,
) -> DataFrame:
    """User ids of the offending groups, as `user_id`.

    `distinct=False` keeps one row per offending group (the form to join
    against: see `filter_blacklisted`); `distinct=True` gives each user once. A group without a user id names no user,
    so it adds no entry (it still shows in `blacklist_rows`).
    """
    users = (
        blacklist_rows(counts, threshold, keys, count_col)
        .select(F.col(user_col).alias("user_id"))
        .where(F.col("user_id").isNotNull())
    )
    return users.distinct() if distinct else users


def filter_blacklisted(
    clicks: DataFrame, blacklist: DataFrame, broadcast: bool | None = None, method: str = "anti"
) -> DataFrame:
    """Drop the rows of blacklisted users (equality on `user_id` only): clicks, or counts per user.

    Rows with a null `user_id` are kept and null or repeated blacklist entries
    are harmless (a `NOT IN` would empty the result on one null entry).

    method="anti": a left anti join. Over an aggregate Catalyst pushes it below
    the aggregation, onto the raw rows: ideal while the blacklist is broadcast,
    a shuffle of the raw rows when it is not.
    method="mark": a left join against the distinct blacklist that marks
    blacklisted rows, which are then dropped. Catalyst keeps it where it is
    written, so over counts the join moves counts, whatever the blacklist's size.

    broadcast=None leaves the strategy to the planner and AQE: the blacklist is
    broadcast while its (runtime) size is under the broadcast threshold, and
    beyond it the join is a shuffle join whose skewed partitions AQE splits
    (a user with a third of all clicks is read by many tasks). AQE splits only
    when both sides arrive through their own shuffle, so pass a blacklist that
    is not already partitioned by user, e.g. `derive_blacklist(...,
    distinct=False)` rather than a `distinct()` one: repeated entries are
    harmless here. broadcast=True is for a caller that has bounded the
    blacklist's size.
    """
    side = blacklist.select(F.col("user_id").cast("string").alias("_bl_user")).where(F.col("_bl_user").isNotNull())
    if method == "mark":
        side = side.distinct().withColumn("_bl_mark", F.lit(True))
    elif method != "anti":
        raise ValueError(f"unknown method {method!r}; use anti or mark")
    if broadcast:
        side = F.broadcast(side)
    if method == "anti":
        return clicks.join(side, F.col("user_id") == F.col("_bl_user"), "left_anti")
    marked = clicks.join(side, F.col("user_id") == F.col("_bl_user"), "left")
    return marked.where(F.col("_bl_mark").isNull()).drop("_bl_user", "_bl_mark")


def drop_flagged_users(
    counts: DataFrame,
    threshold: int = DEFAULT_THRESHOLD,
    groups: Sequence[str] = COUNT_KEYS,
    user_col: str = "user_id",
    count_col: str = "clicks",
) -> DataFrame:
    """Rows of `counts` whose user has no group above `threshold` in these same counts.

    Equal to `filter_blacklisted(counts, derive_blacklist(counts, threshold))`:
    the groups are totalled, the offenders (a HAVING) are joined back to the
    counts, and the marked rows are dropped. Both sides carry the same null-free
    key pair, so their plans up to the counts' shuffle are equal and Spark reads
    and shuffles the input once (a reused exchange). There is no partition by
    user: rows of one user, or of null users, stay spread over the counts'
    groups, the few offenders are broadcast by the planner, and a large set of
    them gives a shuffle join that AQE can split. `counts` may hold several rows
    per group (partials, or finer buckets such as time slices); users with a null
    id are never blacklisted.
    """
    keyed = counts.withColumn("_user", F.coalesce(F.col(user_col).cast("string"), F.lit("")))
    keyed = keyed.withColumn("_no_user", F.col(user_col).isNull())
    others = [g for g in groups if g != user_col]
    totals = keyed.groupBy(*others, "_user", "_no_user").agg(F.sum(count_col).alias("_total"))
    offenders = totals.where(F.col("_total") > F.lit(threshold)).select("_user", "_no_user").distinct()
    marked = keyed.join(offenders.withColumn("_flagged", F.lit(True)), ["_user", "_no_user"], "left")
    return marked.where(F.col("_flagged").isNull() | F.col("_no_user")).select(*counts.columns)


# Bits of the bitmap that `filter_by_bitmap` broadcasts: 16 MB at most, whatever the blacklist's size.
BITMAP_BITS = 1 << 27


def _hashed(user: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(user), F.lit(bits)) + 1


def blacklist_bitmap(blacklist: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """`_bucket`, `_bitmap`: the hashed users of a blacklist as bitmaps of 4 KB, one row per bucket of hashes in use."""
    users = blacklist.select(_hashed(F.col("user_id").cast("string"), bits).alias("_hash"), "user_id")
    users = users.where(F.col("user_id").isNotNull())
    buckets = users.groupBy(F.bitmap_bucket_number("_hash").alias("_bucket"))
    return buckets.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_hash")).alias("_bitmap"))


def filter_by_bitmap(clicks: DataFrame, blacklist: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """`filter_blacklisted` for a blacklist that is too large to broadcast, over a log that is not to be shuffled.

    A bitmap of the hashed blacklisted users, bounded by `bits`, is broadcast. Clicks whose bit is not set belong
    to no blacklisted user and pass as they are; only those that hit it, the blacklisted ones and a share of
    about `blacklisted users / bits` of the others, enter the exact anti join, whose shuffle so moves the hits
    and not the log. The log is read twice, once for each part. Null users pass, as in `filter_blacklisted`.
    """
    user = F.col("user_id").cast("string")
    hashed = clicks.withColumn("_hash", _hashed(user, bits))
    hashed = hashed.withColumn("_bucket", F.bitmap_bucket_number("_hash")).withColumn("_at", F.bitmap_bit_position("_hash"))
    held = hashed.join(F.broadcast(blacklist_bitmap(blacklist, bits)), "_bucket", "left")
    byte = F.conv(F.hex(F.substring("_bitmap", F.expr("CAST(_at div 8 AS INT) + 1"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1
    hit = F.coalesce(F.col("user_id").isNotNull() & is_set, F.lit(False))
    passed = held.where(~hit).select(*clicks.columns)
    return passed.unionByName(filter_blacklisted(held.where(hit).select(*clicks.columns), blacklist))


# The blacklist rule as SQL text over a table of partial counts.
BLACKLIST_SQL = """
SELECT user_id
FROM {counts}
WHERE user_id IS NOT NULL
GROUP BY click_day, user_id, adv_id
HAVING sum(clicks) > :threshold
"""


def blacklist_sql(counts: DataFrame, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """`derive_blacklist(counts, threshold, distinct=False)` written as SQL text.

    The DataFrame is bound into the statement (Spark registers it as a view for
    the statement only, so concurrent callers cannot clash on a view name) and
    the threshold is a named parameter. Catalyst plans it exactly like the
    DataFrame form: partial and final aggregate, then the filter.
    """
    return counts.sparkSession.sql(BLACKLIST_SQL, args={"threshold": threshold}, counts=counts)
