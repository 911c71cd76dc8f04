"""Click counting: partial counts per micro-batch, totals over partials, typed read-back.

Counts are grouped on three real columns, never on a joined text key, so an id
containing the separator or an empty ad id cannot shift columns. Every count
is a `groupBy().agg()`: Spark combines map-side (partial `HashAggregate`)
before the shuffle, so a hot (day, user, ad) group costs one row per map task
in the shuffle, not one row per click.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNT_KEYS = ("click_day", "user_id", "adv_id")


def click_counts(clicks: DataFrame, keys: Sequence[str] = COUNT_KEYS, batch_col: str | None = None) -> DataFrame:
    """Clicks per (day, user, ad), optionally per batch: `keys..., [batch], clicks BIGINT`."""
    group = list(keys) + ([batch_col] if batch_col else [])
    return clicks.groupBy(*group).agg(F.count(F.lit(1)).alias("clicks"))


def total_click_counts(partials: DataFrame, keys: Sequence[str] = COUNT_KEYS, count_col: str = "clicks") -> DataFrame:
    """Sum of partial counts over all batches: `keys..., clicks BIGINT`."""
    return partials.groupBy(*keys).agg(F.sum(count_col).cast("bigint").alias("clicks"))


def typed_click_counts(table: DataFrame) -> DataFrame:
    """A stored count table as typed records: user_id, adv_id text; click_day DATE; clicks INT.

    The count is stored as text or number by the writer; the day as text or a date.
    """
    return table.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("adv_id").cast("string").alias("adv_id"),
        F.col("click_day").cast("date").alias("click_day"),
        F.col("clicks").cast("int").alias("clicks"),
    )
