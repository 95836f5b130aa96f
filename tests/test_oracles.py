import pathlib

import duckdb
import pytest

import __spark_entry__ as spark_entry
from catalog import queries as catalog_queries
from check_oracles import TABLES, compare


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{pathlib.Path(sf_dir) / table}.parquet'")
    return con


def test_each_query_has_sql():
    assert set(catalog_queries.QUERIES) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog_queries.QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(spark, con, name, sf_dir).startswith(f"{name}: ok")


def test_flagship(spark):
    assert [r["node"] for r in spark_entry.entry(spark).orderBy("node").collect()] == [1, 2, 3, 4, 5]
