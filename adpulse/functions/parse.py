"""Parsing click messages (JSON text) into typed click rows.

Built-in expressions only (`from_json`, `try_to_timestamp`), so parsing stays
inside whole-stage codegen and works the same on a batch and on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.schema import CLICK_JSON_SCHEMA

# Fixed value: a bare day in `accessTime`.
DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}$"

# Stands behind a message in the array that checks it.
SENTINEL = "end of message"

CLICK_COLUMNS = ("user_id", "access_time", "province", "city", "adv_id", "ts", "click_day")


def _time_columns(access_time: Column) -> tuple[Column, Column, Column]:
    """(ts, click_day, well_formed) for an `accessTime` text.

    A bare day gives a day and no time (casting it would give midnight, so the
    pattern is tested first); a date-time gives both; anything else neither.
    """
    text = F.trim(access_time)
    is_day = text.rlike(DAY_PATTERN)
    ts = F.when(is_day, F.lit(None).cast("timestamp")).otherwise(F.try_to_timestamp(text))
    day = F.when(is_day, F.try_to_date(text)).otherwise(F.to_date(ts))
    return ts, day, day.isNotNull()


def with_click_time(df: DataFrame, access_time: str = "access_time") -> DataFrame:
    """Adds `ts` (TIMESTAMP) and `click_day` (DATE) derived from the access-time text."""
    ts, day, _ = _time_columns(F.col(access_time))
    return df.withColumns({"ts": ts, "click_day": day})


def is_one_json_value(raw: Column) -> Column:
    """Whether the text is one JSON value and nothing else (null: null).

    The JSON parser stops at the end of the first value, so `{...} rest` would pass. Put into an array before a
    sentinel, a text with a rest is no JSON any more, or an array of another length.
    """
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), raw, F.lit(f',"{SENTINEL}"]'))) == 2, F.lit(False))


def _json_fields(parsed: Column) -> dict[str, Column]:
    return {
        "user_id": parsed["userId"],
        "access_time": parsed["accessTime"],
        "province": parsed["province"],
        "city": parsed["city"],
        "adv_id": parsed["advId"],
    }


def parse_clicks(
    messages: DataFrame, mode: str = "FAILFAST", value: str = "value"
) -> DataFrame | tuple[DataFrame, DataFrame]:
    """Parse the JSON `value` of each message into a click.

    Keys match case-sensitively; unknown keys are ignored; numbers become
    text; JSON that is followed by anything but blanks is malformed. Other columns (topic, partition, offset, ...) are carried along and
    `value` is dropped.

    mode="FAILFAST": a malformed, empty or null message, or an `accessTime`
    that is neither a day nor a date-time, fails the job (the reference throws
    in the task). mode="QUARANTINE": returns `(good, bad)`; `bad` keeps every
    column of the rejected messages plus `error`.
    """
    carried = [c for c in messages.columns if c != value]
    raw = F.col(value)
    if mode == "FAILFAST":
        parsed = F.from_json(raw, CLICK_JSON_SCHEMA, {"mode": "FAILFAST"})
        empty = raw.isNull() | (F.trim(raw) == "")
        parsed = (
            F.when(empty, F.raise_error(F.lit("empty click message")))
            .when(~is_one_json_value(raw), F.raise_error(F.concat(F.lit("malformed click message: "), raw)))
            .otherwise(parsed)
        )
        fields = _json_fields(F.col("_j"))
        ts, day, ok = _time_columns(fields["access_time"])
        checked_day = F.when(ok, day).otherwise(
            F.raise_error(F.concat(F.lit("bad accessTime: "), F.coalesce(fields["access_time"], F.lit("null"))))
        )
        return (
            messages.withColumn("_j", parsed)
            .select(*carried, *[c.alias(n) for n, c in fields.items()], ts.alias("ts"), checked_day.alias("click_day"))
        )
    if mode == "QUARANTINE":
        parsed = F.from_json(raw, CLICK_JSON_SCHEMA, {"mode": "PERMISSIVE"})
        fields = _json_fields(F.col("_j"))
        ts, day, ok = _time_columns(fields["access_time"])
        error = (
            F.when(raw.isNull() | (F.trim(raw) == ""), F.lit("empty"))
            .when(
                F.col("_j").isNull()
                | F.col("_j").eqNullSafe(F.struct(*[F.lit(None).cast("string")] * 5))
                | ~is_one_json_value(raw),
                F.lit("malformed"),
            )
            .when(~ok, F.lit("bad accessTime"))
        )
        staged = messages.withColumn("_j", parsed).withColumn("_err", error)
        good = staged.where(F.col("_err").isNull()).select(
            *carried, *[c.alias(n) for n, c in fields.items()], ts.alias("ts"), day.alias("click_day")
        )
        bad = staged.where(F.col("_err").isNotNull()).select(*messages.columns, F.col("_err").alias("error"))
        return good, bad
    raise ValueError(f"unknown mode {mode!r}; use FAILFAST or QUARANTINE")
