import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[*]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    yield spark


@pytest.fixture(scope="session")
def expected():
    """Row counts of the flagship's stages at SF_SMALL, counted by DuckDB."""
    import duckdb

    from idweave.oracles import oracle_sql

    con = duckdb.connect()
    for t in ("lineitem", "orders", "part"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return dict(con.sql(oracle_sql()["stage_counts"]).fetchall())


@pytest.fixture(scope="session")
def src(spark):
    from idweave import fixtures

    return fixtures.sources(spark, SF_SMALL)
