"""Every registered query of the click engine against its DuckDB statement on the sf0.001 tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from adpulse.plans.catalog import batch_queries
from adpulse.plans.streams import stream_queries
from tools.oracle_check import compare, duck

NAMES = [*batch_queries(), *stream_queries()]


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_a_statement():
    assert set(NAMES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_small, con, name):
    got = compare(spark, name, sf_small, con)
    assert got["cols_match"], got
    assert got["values_match"], got
    assert got["types_match"], got


def test_entry(spark, con):
    df = entry(spark)
    assert df.columns == ["province", "adv_id", "clicks", "rank"]
    want = con.execute(f'SELECT province, adv_id, clicks, "rank" FROM ({oracle_sql()["top_ads_by_province"]})').fetchall()
    assert sorted(tuple(r) for r in df.collect()) == sorted(want) != []
