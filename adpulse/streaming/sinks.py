"""Streaming sinks for a click stream: console previews, the clean clicks as a table, a raw-message archive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adpulse.schema import CLEAN_CLICK_SCHEMA
from adpulse.sinks.writers import batch_path, read_live, replace_folder


def clean_click_table(path: str) -> Callable[[DataFrame, int], None]:
    """For `run_click_stream(clean_to=...)`: keep the filtered clicks, one folder per batch, replaced whole by a replay."""

    def write(clean: DataFrame, batch_id: int) -> None:
        columns = [f for f in CLEAN_CLICK_SCHEMA.fieldNames() if f != "batch_id"]
        replace_folder(clean.select(*columns), batch_path(path, batch_id))

    return write


def clean_clicks_so_far(spark: SparkSession, path: str) -> DataFrame:
    """The clicks that a `clean_click_table` at `path` holds, with the batch that they came in."""
    return read_live(spark, path, CLEAN_CLICK_SCHEMA)


def clean_click_preview(n: int = 10) -> Callable[[DataFrame, int], None]:
    """For `run_click_stream(clean_to=...)`: print the first `n` filtered clicks of every batch."""
    return lambda clean, batch_id: clean.show(n, truncate=False)


def start_console_preview(stream: DataFrame, n: int = 10, trigger: dict | None = None) -> StreamingQuery:
    """Print the first `n` rows of every micro-batch (the console sink takes only those rows)."""
    return (
        stream.writeStream.format("console")
        .option("numRows", n)
        .option("truncate", False)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def start_message_archive(
    stream: DataFrame, path: str, checkpoint: str, format: str = "text", trigger: dict | None = None
) -> StreamingQuery:
    """Keep every raw message: `value` as text lines, or all message columns as a Parquet table.

    The file sink records each batch in its own log, so a replayed batch is not
    written twice.
    """
    body = stream.select("value") if format == "text" else stream
    sink = "text" if format == "text" else "parquet"
    return (
        body.writeStream.format(sink)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )
