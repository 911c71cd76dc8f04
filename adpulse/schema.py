"""Schemas of the click model.

Every field of a click message is text; typed columns (`ts`, `click_day`) are
derived when the message is parsed.
"""

from __future__ import annotations

from pyspark.sql import types as T

# JSON keys of a click message, in message order.
MESSAGE_KEYS = ("userId", "accessTime", "province", "city", "advId")

# Default threshold: a user with more than this many clicks on one ad in one day
# is blacklisted (strictly greater than).
DEFAULT_THRESHOLD = 100

# Default micro-batch interval of the click stream.
DEFAULT_TRIGGER = "5 seconds"

# What a Kafka read (or its file stand-in) delivers.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.StringType()),
    ]
)

# JSON body of a click message; all text, as sent.
CLICK_JSON_SCHEMA = T.StructType([T.StructField(k, T.StringType()) for k in MESSAGE_KEYS])

# A parsed click. `ts` is null when `access_time` is a bare day.
CLICK_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("access_time", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("adv_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("click_day", T.DateType()),
    ]
)

# A click that the stream let through, where it stood in the log, and its micro-batch.
CLEAN_CLICK_SCHEMA = T.StructType(
    [*MESSAGE_SCHEMA.fields[:3], *CLICK_SCHEMA.fields, T.StructField("batch_id", T.LongType())]
)

# Partial click counts of the stream's tables: three kinds of groups in one table, so that one aggregation and
# one write fill it. `user` counts (day, user, ad), `city` counts (day, province, city, ad) and `minute` counts
# (minute, ad); a column that is not of a row's kind is null. Stored by day and kind; a reader sees one kind.
KIND_COLUMNS = {
    "user": ("user_id", "adv_id", "clicks", "click_day", "batch_id"),
    "city": ("province", "city", "adv_id", "clicks", "click_day", "batch_id"),
    "minute": ("minute", "adv_id", "clicks", "on_minute", "click_day", "batch_id"),
}

# `on_minute`: the clicks whose time is exactly the minute (no seconds), which
# an open span start leaves out and a closed span end keeps.
ALL_COUNTS_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("minute", T.TimestampType()),
        T.StructField("adv_id", T.StringType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("on_minute", T.LongType()),
        T.StructField("click_day", T.DateType()),
        T.StructField("kind", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def _kind_schema(kind: str) -> T.StructType:
    return T.StructType([ALL_COUNTS_SCHEMA[name] for name in KIND_COLUMNS[kind]])


COUNT_SCHEMA = _kind_schema("user")
CITY_COUNT_SCHEMA = _kind_schema("city")
MINUTE_COUNT_SCHEMA = _kind_schema("minute")

# Running totals per province and ad: batch k's rows are the totals of all batches up to k.
PROVINCE_TOTALS_SCHEMA = T.StructType(
    [
        T.StructField("province", T.StringType()),
        T.StructField("adv_id", T.StringType()),
        T.StructField("clicks", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

BLACKLIST_SCHEMA = T.StructType([T.StructField("user_id", T.StringType())])

# Committed position of a consumer group: the next offset to read.
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("group_id", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

LEDGER_LOG_SCHEMA = T.StructType(list(LEDGER_SCHEMA.fields) + [T.StructField("batch_id", T.LongType())])

# The stream's ledger also keeps where each batch's range began.
RANGE_LOG_SCHEMA = T.StructType(
    [*LEDGER_SCHEMA.fields, T.StructField("from_offset", T.LongType()), T.StructField("batch_id", T.LongType())]
)

# Where a reader of a stored log started.
START_SCHEMA = T.StructType([*MESSAGE_SCHEMA.fields[:2], T.StructField("start_offset", T.LongType())])
