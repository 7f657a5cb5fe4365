"""Every registered query against its DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from idweave import oracles, queries
from tools.check_oracles import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(queries.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, SF, name, queries.queries()[name], oracles.oracle_sql()[name])
    assert res["ok"], res


def test_entry_smoke(spark, expected):
    assert E.entry(spark).count() == expected["result"] > 3000
