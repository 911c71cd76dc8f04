import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def edge_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    words = " ".join(f"word{k % 97}x{k % 31}" for k in range(6000))
    base = " ".join(f"alpha{k}" for k in range(120))
    return [
        (1, base, "en", "a", len(base)),
        (2, base, "en", "a", len(base)),
        (2, base, "en", "a", len(base)),
        (3, base.replace("alpha60", "other"), "en", "b", len(base)),
        (4, None, None, None, None),
        (5, "", "en", "b", 0),
        (6, " \n\t", "de", None, 3),
        (7, "one two", "de", "b", 7),
        (8, "one  two", "de", "c", 8),
        (9, words, "en", "c", len(words)),
        (None, base, "en", "c", len(base)),
        (None, None, None, None, None),
        (10, "ÄÖÜ äöü ß " * 60, "de", "d", 600),
        (11, "ab" * 400, "fr", "d", 800),
        (12, "12345 678", "fr", "é", 9),
        (13, words[:3000] + "ß" + words[5000:], "en", "c", None),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(edge_rows(), DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def clashing_docs(spark, edge_docs):
    """The edge rows with columns whose names the operators use themselves, or that differ in case only."""
    names = "TEXT size shard slot target taken source_size component_id kept node cluster copies row block mark".split()
    from pyspark.sql import functions as F

    return edge_docs.select("*", *[F.lit(7).alias(n) for n in names])


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
