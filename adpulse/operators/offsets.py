"""Offset bookkeeping over message logs and a committed-offset ledger.

The message log is any DataFrame with `topic, partition, offset` (a Kafka read
or a stored copy of one); the ledger is `group_id, topic, partition, offset`
(the next offset to read), optionally with `batch_id` when it is kept as one
partition per micro-batch. Everything here is bounded by the number of topic
partitions except the scans of the log itself, which are partial aggregates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

PARTITION_KEYS = ("topic", "partition")

# Ranges are observed for up to this many topic partitions; beyond it two expressions a partition would be
# evaluated for every message, and the ranges are aggregated instead.
OBSERVED_PARTITIONS = 64


def latest_offsets(messages: DataFrame) -> DataFrame:
    """Next offset to be written per partition: `topic, partition, latest_offset`."""
    return messages.groupBy(*PARTITION_KEYS).agg((F.max("offset") + 1).cast("bigint").alias("latest_offset"))


def committed_offsets(ledger: DataFrame, group_id: str, topic: str | None = None) -> DataFrame:
    """Committed offset of `group_id` per partition: `topic, partition, committed_offset`.

    Empty for a group never seen. When the ledger keeps one entry per batch,
    the entry of the latest batch wins.
    """
    rows = ledger.where(F.col("group_id") == group_id)
    if topic is not None:
        rows = rows.where(F.col("topic") == topic)
    pick = F.max_by("offset", "batch_id") if "batch_id" in ledger.columns else F.max("offset")
    return rows.groupBy(*PARTITION_KEYS).agg(pick.cast("bigint").alias("committed_offset"))


def start_positions(latest: DataFrame, committed: DataFrame | None = None, mode: str = "resume") -> DataFrame:
    """Where a reader starts, per partition.

    mode="resume": the committed offset where there is one, else the latest
    (the committed map is laid over the latest one). A partition known only to
    the ledger starts at its committed offset; `committed_above_latest` flags a
    committed offset beyond the end of the log. mode="earliest": every
    partition starts at 0.

    Output: `topic, partition, latest_offset, committed_offset, start_offset,
    committed_above_latest`.
    """
    if mode == "earliest":
        return latest.select(*PARTITION_KEYS, F.lit(0).cast("bigint").alias("start_offset"))
    if mode != "resume":
        raise ValueError(f"unknown mode {mode!r}; use resume or earliest")
    if committed is None:
        committed = latest.select(*PARTITION_KEYS, F.lit(None).cast("bigint").alias("committed_offset")).where(F.lit(False))
    joined = latest.join(committed, list(PARTITION_KEYS), "full_outer")
    return joined.select(
        *PARTITION_KEYS,
        "latest_offset",
        "committed_offset",
        F.coalesce("committed_offset", "latest_offset").alias("start_offset"),
        F.coalesce(F.col("committed_offset") > F.col("latest_offset"), F.lit(False)).alias("committed_above_latest"),
    )


def _any_of(conditions: list[Column]) -> Column:
    """The conditions joined by OR as a balanced tree, so that many topic partitions give no deep expression."""
    if len(conditions) == 1:
        return conditions[0]
    half = len(conditions) // 2
    return _any_of(conditions[:half]) | _any_of(conditions[half:])


def _unlisted(listed: dict[str, list[int]]) -> Column:
    """Rows of partitions that are not listed, as ranges: statistics of a file can refute it."""
    conditions = [F.col("topic").isNull(), F.col("partition").isNull(), ~F.col("topic").isin(*listed)]
    for topic, partitions in listed.items():
        low, high = min(partitions), max(partitions)
        outside = (F.col("partition") < low) | (F.col("partition") > high)
        gaps = sorted(set(range(low, high)) - set(partitions)) if high - low < 2 * len(partitions) + 100 else None
        if gaps is None:  # far apart: no list of what lies between
            outside = ~F.col("partition").isin(*partitions)
        elif gaps:
            outside = outside | F.col("partition").isin(*gaps)
        conditions.append((F.col("topic") == topic) & outside)
    return _any_of(conditions)


def resume_read(messages: DataFrame, starts: DataFrame) -> DataFrame:
    """Messages at or after each partition's start offset; `messages` may be a stream.

    Only rows of a listed partition below its start are left out. A partition without a start position (one
    that came after the positions were taken, or whose position is null) is read from its beginning, so a
    log that was empty then is read whole.

    `starts` holds one row per topic partition: its size is bounded by the
    topic's partition count, not by the data. Its rows are read when the query is
    built and become literal predicates on `topic`, `partition` and `offset`, so
    a stored log skips the files and row groups below the start, and the log is
    neither joined nor shuffled.
    """
    rows = starts.select(*PARTITION_KEYS, "start_offset").na.drop().collect()
    if not rows:
        return messages
    listed: dict[str, list[int]] = {}
    for row in rows:
        listed.setdefault(row["topic"], []).append(row["partition"])
    within = [
        (F.col("topic") == row["topic"]) & (F.col("partition") == row["partition"]) & (F.col("offset") >= row["start_offset"])
        for row in rows
    ]
    return messages.where(_any_of(within) | _unlisted(listed))


def batch_offset_ranges(messages: DataFrame, batch_col: str | None = None) -> DataFrame:
    """Offset range of each partition in a batch: `[batch], topic, partition, from_offset, until_offset`.

    Taken from the batch's own rows, so a range can never belong to another
    batch. `until_offset` is exclusive, the next offset to read.
    """
    keys = ([batch_col] if batch_col else []) + list(PARTITION_KEYS)
    return messages.groupBy(*keys).agg(
        F.min("offset").cast("bigint").alias("from_offset"),
        (F.max("offset") + 1).cast("bigint").alias("until_offset"),
    )


Ranges = list[tuple[str, int, int, int]]


def observe_ranges(
    messages: DataFrame, partitions: Iterable[tuple[str, int]]
) -> tuple[DataFrame, Callable[[], Ranges | None]]:
    """`messages`, observed, and a function that gives the ranges after an action has read them all.

    The offset ranges of the listed topic partitions (`topic`, `partition`, from, until) come out of whatever
    action reads the messages: no job of their own. The function returns None where observing cannot tell
    them: more than `OBSERVED_PARTITIONS` partitions, messages of a partition that is not listed, or a plan from which
    Spark dropped the observation because a join was found empty. Then `batch_offset_ranges` tells them.
    Minimum and maximum stay right when a lost task is run again.
    """
    listed = sorted(set(partitions))
    if not listed or len(listed) > OBSERVED_PARTITIONS:
        return messages, lambda: None
    here = [(F.col("topic") == t) & (F.col("partition") == p) for t, p in listed]
    metrics = [F.count(F.when(F.coalesce(_any_of(here), F.lit(False)), None).otherwise(1)).alias("others")]
    for at, is_here in enumerate(here):
        metrics.append(F.min(F.when(is_here, F.col("offset"))).alias(f"from_{at}"))
        metrics.append(F.max(F.when(is_here, F.col("offset"))).alias(f"last_{at}"))
    observation = Observation()

    def ranges() -> Ranges | None:
        try:
            seen = observation.get
        except Py4JJavaError as error:
            # A plan that lost its observation leaves a row without a schema, which PySpark asserts against.
            if error.java_exception.getClass().getName() != "java.lang.AssertionError":
                raise
            return None
        if seen.get("others") != 0:
            return None
        return [
            (t, p, seen[f"from_{at}"], seen[f"last_{at}"] + 1)
            for at, (t, p) in enumerate(listed)
            if seen[f"last_{at}"] is not None
        ]

    return messages.observe(observation, *metrics), ranges


def advance_ledger(ranges: DataFrame, group_id: str) -> DataFrame:
    """Ledger rows that commit the `until_offset` of each range: `group_id, topic, partition, offset`."""
    return ranges.select(
        F.lit(group_id).alias("group_id"), *PARTITION_KEYS, F.col("until_offset").cast("bigint").alias("offset")
    )
