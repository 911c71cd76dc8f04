"""Click streams: Kafka, or a stored message log read as a file stream.

Both give `topic, partition, offset, value` (value as text, the key dropped),
so every downstream operator is the same for either source.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.operators.offsets import resume_read
from adpulse.schema import MESSAGE_SCHEMA


def starting_offsets_json(starts: DataFrame) -> str:
    """Kafka `startingOffsets` JSON (`{"topic": {"0": 42}}`) from `start_positions` output.

    Collects one row per topic partition: bounded by the topic's partition
    count, not by the data.
    """
    spec: dict[str, dict[str, int]] = {}
    for row in starts.select("topic", "partition", "start_offset").collect():
        spec.setdefault(row["topic"], {})[str(row["partition"])] = int(row["start_offset"])
    return json.dumps(spec, sort_keys=True)


def read_click_stream(
    spark: SparkSession,
    *,
    bootstrap_servers: str | None = None,
    topic: str | None = None,
    starting_offsets: str | DataFrame | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    path: str | None = None,
    file_format: str = "parquet",
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A streaming DataFrame of click messages: `topic, partition, offset, value`.

    Kafka (`bootstrap_servers`, `topic`): `starting_offsets` is "earliest",
    "latest", a JSON map or a `start_positions` DataFrame; it applies on the
    first start only, afterwards the query's checkpoint decides.
    `max_offsets_per_trigger` is the admission cap per micro-batch (a total
    over partitions: 10 messages/s/partition at a 5 s trigger is 50 x partitions).
    `min_partitions` lets Spark split the offset range of a busy topic partition
    over several tasks, so one hot partition (a third of all clicks, say) is not
    read and parsed by a single task.

    Files (`path`): a stored message log with the same columns;
    `max_files_per_trigger` or `max_bytes_per_trigger` is the cap (one of the two;
    a single file is never split). `starting_offsets` is "earliest" or a
    `start_positions` DataFrame, read now: messages below it are skipped by
    `resume_read`. A file log keeps no start in its checkpoint, so a query must get the
    same start positions each time it is restarted: `ClickTables.started` keeps them
    with the stream's tables. Options that only the other source has raise.
    """
    if bootstrap_servers is not None:
        if path is not None or max_files_per_trigger is not None or max_bytes_per_trigger is not None:
            raise ValueError("path, max_files_per_trigger and max_bytes_per_trigger belong to a message log, not to Kafka")
        if topic is None:
            raise ValueError("give the topic to read from Kafka")
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers)
            .option("subscribe", topic)
        )
        if isinstance(starting_offsets, DataFrame):
            starting_offsets = starting_offsets_json(starting_offsets)
        if starting_offsets is not None:
            reader = reader.option("startingOffsets", starting_offsets)
        if max_offsets_per_trigger is not None:
            reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        if min_partitions is not None:
            reader = reader.option("minPartitions", min_partitions)
        for k, v in (options or {}).items():
            reader = reader.option(k, v)
        return reader.load().select(
            "topic", "partition", "offset", F.col("value").cast("string").alias("value")
        )
    if path is None:
        raise ValueError("give bootstrap_servers and topic (Kafka) or path (message log)")
    if topic is not None or max_offsets_per_trigger is not None or min_partitions is not None:
        raise ValueError("topic, max_offsets_per_trigger and min_partitions belong to Kafka, not to a message log")
    if isinstance(starting_offsets, str) and starting_offsets != "earliest":
        raise ValueError("a message log starts at 'earliest' or at the rows of a start_positions DataFrame")
    reader = spark.readStream.schema(MESSAGE_SCHEMA).format(file_format)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        if max_files_per_trigger is not None:
            raise ValueError("give max_files_per_trigger or max_bytes_per_trigger, not both")
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    log = reader.load(path)
    return resume_read(log, starting_offsets) if isinstance(starting_offsets, DataFrame) else log


def message_slices(messages: DataFrame, slices: int, order: str = "event_id") -> list[DataFrame]:
    """Cut a message log into `slices` consecutive ranges of `order`, each as `topic, partition, offset, value`.

    Appending the slices one after the other (and letting the stream drain
    after each) replays the log in order, as a Kafka partition would deliver it.
    One small aggregate (min and max of `order`) fixes the cut points.
    """
    lo, hi = messages.agg(F.min(order), F.max(order)).first()
    cols = MESSAGE_SCHEMA.fieldNames()
    if lo is None:
        return [messages.select(*cols)]
    width = (hi - lo) // slices + 1
    # A range predicate on the stored column itself, so each slice's read is pushed into the scan.
    ranges = [(F.col(order) >= lo + i * width) & (F.col(order) < lo + (i + 1) * width) for i in range(slices)]
    ranges[-1] = ranges[-1] | F.col(order).isNull()  # messages without a place come last
    return [messages.where(within).select(*cols) for within in ranges]
