"""Adapter from the driver's tables to the click model (mapping in FIXTURES.md).

`events` plays the click log: `user_id` is the user, `props.k` the ad, and the
user's customer row gives province (region) and city (nation). The message
coordinates (`topic`, `partition`, `offset`) are made from `event_id`, so every
event is also a message of a four-partition topic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping.
TOPIC = "clicks"
TOPIC_PARTITIONS = 4
ACCESS_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DAY_FORMAT = "yyyy-MM-dd"
LEDGER_GROUP = "ad-clicks"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_geography(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """user key -> (province, city).

    `nation` and `region` are fixed-size dimensions (25 and 5 rows at every
    scale factor), so they are broadcast. `customer` grows with the data: joins
    with the result carry no hint, and AQE decides from its size at run time.
    """
    nat = nation.select("n_nationkey", "n_regionkey", F.col("n_name").alias("city"))
    reg = region.select("r_regionkey", F.col("r_name").alias("province"))
    return (
        customer.select("c_custkey", "c_nationkey")
        .join(F.broadcast(nat), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(F.broadcast(reg), F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select("c_custkey", "province", "city")
    )


def message_coordinates(events: DataFrame) -> DataFrame:
    """Adds `topic`, `partition`, `offset` made from `event_id`."""
    return events.withColumns(
        {
            "topic": F.lit(TOPIC),
            "partition": (F.col("event_id") % TOPIC_PARTITIONS).cast("int"),
            "offset": F.expr(f"event_id div {TOPIC_PARTITIONS}"),
        }
    )


def _geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`user_geography` of the fixture."""
    customer, nation, region = (read_fixture(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    return user_geography(customer, nation, region)


def fixture_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`user_id` (text) -> province, city, from the fixture's customer, nation and region tables."""
    return _geography(spark, sf_dir).select(F.col("c_custkey").cast("string").alias("user_id"), "province", "city")


def with_geography(spark: SparkSession, sf_dir: str, rows: DataFrame, few_rows: bool = False) -> DataFrame:
    """Adds `province` and `city` to rows keyed by `user_id` (a left join: unknown users get nulls).

    Both are attributes of the user, so rows can be aggregated per user first
    and enriched after: the join then moves aggregates, not clicks.
    `few_rows=True` is for a `rows` of a proven small size (a top-k): the
    geography is first cut to those users by a semi join that broadcasts their
    ids, so a large `customer` table is never shuffled for a handful of rows.
    """
    geo = fixture_geography(spark, sf_dir)
    if few_rows:
        geo = geo.join(F.broadcast(rows.select("user_id").distinct()), "user_id", "left_semi")
    return rows.join(geo, "user_id", "left")


def click_rows(spark: SparkSession, sf_dir: str, geography: bool = True) -> DataFrame:
    """Click fields as text, one row per event, with message coordinates.

    Columns: event_id, topic, partition, offset, userId, accessTime, province,
    city, advId — the message body before it is encoded as JSON — and the
    stored `ts`. `geography=False` leaves province and city out, and with them
    the join with `customer`.
    """
    events = read_fixture(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    rows = message_coordinates(events)
    if geography:
        rows = rows.join(_geography(spark, sf_dir), F.col("user_id") == F.col("c_custkey"), "left")
    place = ["province", "city"] if geography else []
    return (
        rows
        .select(
            "event_id",
            "topic",
            "partition",
            "offset",
            F.col("user_id").cast("string").alias("userId"),
            F.date_format(F.col("ts"), ACCESS_TIME_FORMAT).alias("accessTime"),
            *place,
            F.get_json_object("props", "$.k").alias("advId"),
            "ts",
        )
    )


def clicks_from_events(spark: SparkSession, sf_dir: str, geography: bool = True) -> DataFrame:
    """The parsed-click view of `events` without the JSON round trip.

    Same columns as `parse_clicks` gives, plus `event_id` and the message
    coordinates. `ts` stays the stored column (TIMESTAMP_NTZ, read in UTC) so
    that time predicates reach the Parquet scan. `geography=False` leaves out
    province and city (and the join that makes them).
    """
    rows = click_rows(spark, sf_dir, geography)
    place = ["province", "city"] if geography else []
    return rows.select(
        "event_id",
        "topic",
        "partition",
        "offset",
        F.col("userId").alias("user_id"),
        F.col("accessTime").alias("access_time"),
        *place,
        F.col("advId").alias("adv_id"),
        "ts",
        F.to_date("ts").alias("click_day"),
    )


def message_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the coordinates of the click log: `event_id, topic, partition, offset` (no body, no join)."""
    events = read_fixture(spark, sf_dir, "events").select("event_id")
    return message_coordinates(events)


def messages_from_events(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    """The click log as Kafka would deliver it: topic, partition, offset, value (JSON text)."""
    from adpulse.schema import MESSAGE_KEYS

    rows = click_rows(spark, sf_dir)
    cols = ["event_id"] if keep_event_id else []
    return rows.select(
        *cols,
        "topic",
        "partition",
        "offset",
        F.to_json(F.struct(*MESSAGE_KEYS)).alias("value"),
    )


def ledger_from_messages(messages: DataFrame, group_id: str = LEDGER_GROUP) -> DataFrame:
    """A committed-offset ledger for the fixture: half way into partitions 0-2, none for 3.

    Partition 3 has no committed entry, so it starts at the latest offset.
    """
    return (
        messages.where(F.col("partition") < TOPIC_PARTITIONS - 1)
        .groupBy("topic", "partition")
        .agg(F.expr("(max(offset) + 1) div 2").alias("offset"))
        .select(F.lit(group_id).alias("group_id"), "topic", "partition", "offset")
    )
