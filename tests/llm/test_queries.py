import sys

import duckdb
import pytest

import __spark_entry__ as entry
from idweave.llm import queries as q
from tools.check_oracles import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in q.queries())
    assert numbers == list(range(1, 14))
    assert set(q.queries()) | {"pipeline"} <= set(entry.queries())
    assert set(q.oracle_sql()) <= set(q.queries())


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_against_sql(spark, con, name):
    result = compare(spark, con, SF, name, q.queries()[name], q.oracle_sql()[name])
    assert result["ok"], result


def test_nothing_else_imports_the_package():
    import subprocess

    code = ("import pkgutil, importlib, sys, idweave\n"
            "for m in pkgutil.walk_packages(idweave.__path__, 'idweave.'):\n"
            "    if not m.name.startswith('idweave.llm') and not m.name.endswith('__main__'):\n"
            "        importlib.import_module(m.name)\n"
            "sys.exit(any(n.startswith('idweave.llm.') for n in sys.modules))")
    assert subprocess.run([sys.executable, "-c", code]).returncode == 0
