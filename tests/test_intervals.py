"""Validity ranges of the security master: compression, round trip and as-of reads."""

import datetime as dt
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from idweave.operators import compress_snapshots, expand_intervals, join_intervals, join_snapshot, snapshot_calendar

DAYS = [dt.date(2022, 12, 20) + dt.timedelta(days=9 * k) for k in range(60)]
SCHEMA = "datadate date, sec_id string, sedol string, ticker string"
COLUMNS = ("sedol", "ticker")


def ranges(rows, days):
    """(security, from, to, first number, last number, values) by walking over the days."""
    out, no = [], {d: k for k, d in enumerate(days, 1)}
    for s in sorted({r[1] for r in rows}):
        open_ = None
        for d in days:
            v = next((r[2:] for r in rows if r[1] == s and r[0] == d), "none")
            if open_ and open_[1] != v:
                out.append((s, open_[0], last, no[open_[0]], no[last], *open_[1]))
                open_ = None
            if v != "none":
                open_ = open_ or (d, v)
                last = d
        if open_:
            out.append((s, open_[0], last, no[open_[0]], no[last], *open_[1]))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frames(spark, rows, days):
    secs = spark.createDataFrame(rows, SCHEMA)
    calendar = snapshot_calendar(spark.createDataFrame([(d,) for d in days], "datadate date"))
    return secs, calendar, compress_snapshots(secs, calendar, columns=COLUMNS)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10_000))
def test_ranges_round_trip_and_reads(spark, seed):
    rng = random.Random(seed)
    days = sorted(rng.sample(DAYS, rng.randint(1, 25)))
    rows = [(d, s, rng.choice([None, "a"]), "t" if rng.random() < 0.8 else "u") for s in "XYZ" for d in days if rng.random() < 0.85]
    secs, calendar, compressed = frames(spark, rows, days)
    assert sorted((r.datadate, r.no) for r in calendar.collect()) == [(d, k) for k, d in enumerate(days, 1)]
    assert got(compressed) == ranges(rows, days)
    assert got(expand_intervals(compressed, calendar, columns=COLUMNS)) == sorted(rows, key=repr)
    asked = [(k, rng.choice(["X", "Y", "W", None]), rng.choice([*days, None])) for k in range(30)]
    alloc = spark.createDataFrame(asked, "k int, sec_id string, snapshot_date date")
    for how in ("left", "inner"):
        assert got(join_intervals(alloc, compressed, how=how, columns=COLUMNS)) == \
            got(join_snapshot(alloc, secs, how=how, columns=COLUMNS))


def test_several_rows_of_a_security_are_all_kept(spark):
    days = DAYS[:4]
    rows = [(d, "X", v, "t") for d in days for v in ("a", "b")] + [(days[1], "X", "b", "t")]
    secs, calendar, compressed = frames(spark, rows, days)
    assert got(expand_intervals(compressed, calendar, columns=COLUMNS)) == sorted(rows, key=repr)


def test_a_steady_master_is_one_row_a_security(spark):
    secs = spark.range(50).select(F.col("id").cast("string").alias("sec_id"), F.lit("a").alias("sedol"),
                                  F.lit(None).cast("string").alias("ticker"))
    days = spark.createDataFrame([(d,) for d in DAYS], "datadate date")
    compressed = compress_snapshots(days.crossJoin(secs), snapshot_calendar(days), columns=COLUMNS)
    assert compressed.count() == 50 and compressed.select("first_no", "last_no").distinct().collect() == [(1, 60)]


def test_one_shuffle_of_the_master(spark):
    secs, calendar, compressed = frames(spark, [(DAYS[0], "X", "a", "t")], DAYS)
    plan = compressed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(sec_id") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_empty(spark):
    secs, calendar, compressed = frames(spark, [], DAYS[:2])
    assert compressed.count() == 0 and expand_intervals(compressed, calendar, columns=COLUMNS).count() == 0
    none = snapshot_calendar(spark.createDataFrame([], "datadate date"))
    assert none.count() == 0
