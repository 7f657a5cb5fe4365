"""The FIXTURES.md views, built from the given tables with the DataFrame API.

In production these are catalog tables (allocations, the security master
partitioned by snapshot date, the equity and fund reference files, and the
symbol table). Here they are derived from lineitem, orders and part so that
their size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.tickers import local_ticker
from .plans.inputs import Sources
from .session import size_shuffles, task_count
from .constants import TICKER_RULES, PREFIX_SEDOL, PREFIX_TICKER


_TABLES: dict[tuple[int, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The given read-only table; the scan (schema read) is set up once per session."""
    path = f"{sf_dir}/{name}.parquet"
    key = (id(spark), spark.conf.get("spark.app.id", ""), path)
    if key not in _TABLES:
        _TABLES[key] = spark.read.parquet(path)
    return _TABLES[key]


_ROWS: dict[tuple[int, str, str], tuple[int, int]] = {}


def _rows(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """Rows of the allocations and of the security master, counted once per session from file footers
    and the calendar. They only size shuffles."""
    key = (id(spark), spark.conf.get("spark.app.id", ""), sf_dir)
    if key not in _ROWS:
        master = table(spark, sf_dir, "part").count() * snapshot_dates(spark, sf_dir).count()
        _ROWS[key] = table(spark, sf_dir, "lineitem").count(), master
    return _ROWS[key]


def _by_mod(c: Column, mod: int, values: list[str], default: str) -> Column:
    out = None
    for i, v in enumerate(values):
        cond = (c % mod) == i
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out.otherwise(F.lit(default))


def allocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    d = F.col("l_shipdate").cast("date")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_suppkey").alias("acct_id"),
        F.col("l_extendedprice").alias("gross"),
        F.col("l_partkey").alias("sec_id"),
        _by_mod(F.col("l_suppkey"), 8, ["ADR", "COM", "GDR", "MFC", "MFO", "PFD", "BND"], "OPT")
        .alias("sec_typ_cd"),
        F.when(F.col("l_returnflag") == "N", "CNCL").otherwise("ACCT").alias("status"),
        d.alias("trade_date_local"),
        F.when(F.col("l_suppkey") % 10 == 0, F.date_sub(d, 1)).otherwise(d).alias("trade_date_est"),
    )


def snapshot_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A fixed calendar rule at every size: the last order date of each quarter.
    day = F.col("o_orderdate").cast("date")
    return (table(spark, sf_dir, "orders").groupBy(F.trunc(day, "quarter").alias("_quarter"))
            .agg(F.max(day).alias("datadate")).select("datadate"))


def securities(spark: SparkSession, sf_dir: str, dates: DataFrame | None = None) -> DataFrame:
    part = table(spark, sf_dir, "part")
    dates = snapshot_dates(spark, sf_dir) if dates is None else dates
    k = F.col("p_partkey")
    ks = k.cast("string")
    dd = F.col("datadate")
    sd = k + F.dayofmonth(dd)
    # The security master holds one row per security per snapshot, so this
    # test table is part x snapshot dates (minus the missing pairs). The date
    # list is one row per calendar quarter: broadcast is bounded.
    # A part file of a few row groups would be read, and all its snapshots
    # made, by as few tasks: its rows are dealt out by their number first.
    tasks = task_count(_rows(spark, sf_dir)[1])
    if tasks > 1:
        part = part.select("p_partkey", "p_size").repartition(tasks, k)
    grid = part.join(F.broadcast(dates), (k + F.month(dd)) % 23 != 0, "inner")
    return grid.select(
        dd.alias("datadate"),
        ks.alias("sec_id"),
        F.concat(F.lit("E"), ks).alias("ext_sec_id"),
        F.when(sd % 11 == 0, F.lit(None).cast("string"))
        .when(sd % 13 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("S"), (k * 7 + F.month(dd)).cast("string"))).alias("sedol"),
        F.when(k % 17 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("C"), ks)).alias("cusip"),
        F.when(k % 19 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("I"), ks)).alias("isin_no"),
        _by_mod(F.col("p_size"), 4, ["THB", "AUD", "USD"], "CAD").alias("sec_currency"),
        F.concat(F.lit("T"), ks,
                 _by_mod(k, 12, ["ZZ", "BB", "YY", "XX", "XX*", "0A", "0B", "O", "DA", "-W", "/F"], ""))
        .alias("ticker"),
    )


def _reference(spark: SparkSession, sf_dir: str, lines: list[int], x: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    src = (li.filter(F.col("l_linenumber").isin(lines))
           .select(F.col("l_partkey").alias("k"),
                   F.date_add(F.col("l_shipdate").cast("date"), 1).alias("d"))
           .distinct())
    k = F.col("k")
    ks = k.cast("string")
    d = F.col("d")
    return src.select(
        ks.alias("sec_id"),
        (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int").alias("file_eff_dt"),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit(x + "V"), ks)).alias("parent_id_undr"),
        F.concat(F.lit(x + "S"), ks).alias("sedol_id"),
        F.concat(F.lit(x + "T"), ks).alias("ticker"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit(x + "I"), ks)).alias("isin_id"),
    )


def ref_equity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reference(spark, sf_dir, [1, 2, 3], "Q")


def ref_fund(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reference(spark, sf_dir, [3, 4], "F")


def symbology(spark: SparkSession, sf_dir: str, secs: DataFrame | None = None) -> DataFrame:
    """Stand-in for the external symbol service: one validity range per symbol."""
    secs = securities(spark, sf_dir) if secs is None else secs
    symbol, _ = local_ticker(F.col("ticker"), F.col("sec_currency"), TICKER_RULES, "always")
    sed = F.when(F.col("sedol").isNotNull() & (F.col("sedol") != ""),
                 F.struct(F.lit(PREFIX_SEDOL).alias("prefix"), F.col("sedol").alias("symbol")))
    tick = F.when(F.col("sec_currency").isin(list(TICKER_RULES)),
                  F.struct(F.lit(PREFIX_TICKER).alias("prefix"), symbol.alias("symbol")))
    # one pass over the security master: each row gives its SEDOL and ticker symbols
    pairs = (secs.select("datadate", F.explode(F.array(sed, tick)).alias("_s"))
             .where(F.col("_s").isNotNull())
             .select("_s.prefix", "_s.symbol", "datadate"))
    # The answer is a function of the symbol, so it is added after the
    # aggregation (which then stays a hash aggregate over fixed-width buffers).
    return (pairs.groupBy("prefix", "symbol")
            .agg(F.min("datadate").alias("valid_from"),
                 F.date_add(F.max("datadate"), 120).alias("valid_to"))
            .withColumn("resolved", F.concat(
                F.when(F.col("prefix") == PREFIX_SEDOL, F.lit("X")).otherwise(F.lit("Y")),
                F.col("symbol"))))


_SOURCES: dict[tuple[int, str, str], Sources] = {}


def sources(spark: SparkSession, sf_dir: str) -> Sources:
    """The six views over ``sf_dir``. They are lazy plans over read-only tables,
    so they are built once per session and reused; nothing is cached, and each
    action reads the tables again. Shuffles are sized by the larger of them."""
    size_shuffles(spark, max(_rows(spark, sf_dir)))
    key = (id(spark), spark.conf.get("spark.app.id", ""), sf_dir)
    if key not in _SOURCES:
        dates = snapshot_dates(spark, sf_dir)
        secs = securities(spark, sf_dir, dates)
        _SOURCES[key] = Sources(allocations(spark, sf_dir), dates, secs,
                                ref_equity(spark, sf_dir), ref_fund(spark, sf_dir),
                                symbology(spark, sf_dir, secs))
    return _SOURCES[key]
