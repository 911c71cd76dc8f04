"""Table reads: stored count tables and blacklists, from Parquet or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession,
    table: str,
    *,
    url: str | None = None,
    path: str | None = None,
    schema: T.StructType | None = None,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetchsize: int = 10_000,
) -> DataFrame:
    """Read a table from Parquet (`path`) or a database (`url`).

    Over JDBC a table is read in one partition unless `partition_column` and
    its bounds split it into `num_partitions` range queries; `fetchsize` rows
    travel per round trip. Filters and selected columns are pushed into the
    database query by Spark. Connection options (user, password, driver) come
    from the caller; there are no defaults.
    """
    if url is not None:
        reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetchsize)
        for k, v in (properties or {}).items():
            reader = reader.option(k, v)
        if partition_column is not None:
            reader = (
                reader.option("partitionColumn", partition_column)
                .option("lowerBound", lower_bound)
                .option("upperBound", upper_bound)
                .option("numPartitions", num_partitions)
            )
        return reader.load()
    if path is None:
        raise ValueError("give either url (JDBC) or path (Parquet)")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.option("basePath", path).parquet(path)


def load_blacklist(table: DataFrame) -> DataFrame:
    """The blacklist as `user_id` text: the first column of each row, whatever its name or type.

    A null entry names no user and is left out (the reference fails on one).
    """
    first = table.columns[0]
    return table.select(F.col(first).cast("string").alias("user_id")).where(F.col("user_id").isNotNull())
