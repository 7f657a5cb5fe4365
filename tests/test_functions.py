"""Edge rows for the column helpers (FIXTURES.md section 7)."""

import datetime as dt

from pyspark.sql import functions as F

from idweave.constants import TICKER_RULES
from idweave.functions import (date_from_text, date_from_yyyymmdd, day_end, day_start,
                               local_ticker, normalize_dates, prefix_columns, tag, yyyymmdd_text)


def test_integer_dates(spark):
    df = spark.createDataFrame([(20240103,), (20241301,), (None,)], "d int")
    got = [r[0] for r in df.select(date_from_yyyymmdd(F.col("d"))).collect()]
    assert got == [dt.date(2024, 1, 3), None, None]


def test_text_dates_first_ten_characters(spark):
    df = spark.createDataFrame([("2024-01-03 10:11:12",), ("2024-02-30",), ("junk",), (None,)], "s string")
    got = [r[0] for r in df.select(date_from_text(F.col("s"))).collect()]
    assert got == [dt.date(2024, 1, 3), None, None, None]


def test_yyyymmdd_text(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3),)], "d date")
    assert df.select(yyyymmdd_text(F.col("d"))).first()[0] == "20240103"


def test_day_bounds_null_safe(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 3),), (None,)], "d date")
    rows = df.select(day_start(F.col("d")).alias("s"), day_end(F.col("d")).alias("e")).collect()
    assert rows[0]["s"] == dt.datetime(2024, 1, 3, 0, 0)
    assert rows[0]["e"] == dt.datetime(2024, 1, 3, 23, 59)
    assert rows[1]["s"] is None and rows[1]["e"] is None
    assert dict(df.select(day_end(F.col("d")).alias("e")).dtypes)["e"] == "timestamp_ntz"


def _tickers(spark, rows, mode):
    df = spark.createDataFrame(rows, "t string, c string")
    sym, base = local_ticker(F.col("t"), F.col("c"), TICKER_RULES, mode)
    return [(r[0], r[1]) for r in df.select(sym, base).collect()]


def test_aud_suffixes_always(spark):
    rows = [(t, "AUD") for t in ["BHPZZ", "CBAXX*", "TLSO", "X-W", "ZZBB", "BHP", "O"]]
    got = [s for s, _ in _tickers(spark, rows, "always")]
    assert got == ["BHP AU", "CBA AU", "TLS AU", "X AU", "ZZ AU", "BHP AU", " AU"]


def test_every_aud_token(spark):
    toks = ["ZZ", "BB", "YY", "XX", "XX*", "0A", "0B", "O", "DA", "-W"]
    got = [s for s, _ in _tickers(spark, [("ABC" + t, "AUD") for t in toks], "always")]
    assert got == ["ABC AU"] * len(toks)


def test_thb_suffix(spark):
    got = _tickers(spark, [("PTT/F", "THB"), ("PTT", "THB")], "always")
    assert got == [("PTT TB", "PTT"), ("PTT TB", "PTT")]


def test_matched_mode_leaves_unmatched(spark):
    got = _tickers(spark, [("BHP", "AUD"), ("PTT", "THB"), ("BHPZZ", "AUD"), ("PTT/F", "THB")],
                   "matched")
    assert [s for s, _ in got] == ["BHP", "PTT", "BHP AU", "PTT TB"]


def test_other_currency_and_null(spark):
    got = _tickers(spark, [("IBM", "USD"), (None, "AUD")], "always")
    assert got == [("IBM", "IBM"), (None, None)]


def test_prefix_and_tag(spark):
    df = spark.createDataFrame([(1, "a", "b")], "k int, x string, y string")
    out = prefix_columns(df, "p_", keep=["k"], drop=["y"])
    assert out.columns == ["k", "p_x"]
    t = tag(df, source="O", process_type="historic")
    assert t.select("source", "process_type").first() == ("O", "historic")


def test_normalize_dates(spark):
    df = spark.createDataFrame([("2024-01-03T00:00:00", 20240105)], "a string, b int")
    r = normalize_dates(df, iso_cols=["a"], yyyymmdd_cols=["b"]).first()
    assert r == (dt.date(2024, 1, 3), dt.date(2024, 1, 5))
