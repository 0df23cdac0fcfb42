"""Every query that has an SQL text gives the same columns, types and values in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tools.compare import connect, mismatch

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, folder, con, name):
    assert mismatch(QUERIES[name](spark, folder), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, small_folder, name):
    assert QUERIES[name](spark, small_folder).count() > 0


def test_entry_is_one_row_per_label(spark, small_folder):
    df = entry.entry(spark)
    labels = spark.read.parquet(f"{small_folder}/customer.parquet").filter("c_custkey % 5 <> 0").count()
    assert df.count() == df.select("msno").distinct().count() == labels


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
