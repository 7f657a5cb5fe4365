"""Randomised checks against brute force on small inputs."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from idweave.operators import (assign_ids, batch_requests, dedup_allocations,
                               previous_snapshot, previous_snapshot_by_key)

BASE = dt.date(2024, 1, 1)
days = st.integers(min_value=0, max_value=40).map(lambda d: BASE + dt.timedelta(days=d))
# spans several calendar years, with clusters so that ties happen
long_days = st.one_of(st.integers(0, 1500), st.sampled_from([0, 1, 365, 366, 730, 731])).map(
    lambda d: BASE + dt.timedelta(days=d))
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(snaps=st.lists(long_days, max_size=8),
       trades=st.lists(st.one_of(st.none(), long_days), max_size=25), strict=st.booleans())
def test_previous_snapshot_brute_force(spark, snaps, trades, strict):
    dates = spark.createDataFrame([(d,) for d in snaps], "datadate date")
    alloc = spark.createDataFrame(list(enumerate(trades)), "id int, trade_date_est date")
    got = {r.id: r.snapshot_date
           for r in previous_snapshot(alloc, dates, how="left", strict=strict).collect()}
    assert len(got) == len(trades)
    for i, t in enumerate(trades):
        earlier = [s for s in snaps if t is not None and (s < t if strict else s <= t)]
        assert got[i] == (max(earlier) if earlier else None)


@SETTINGS
@given(snaps=st.lists(st.tuples(st.integers(0, 3), days), max_size=12),
       trades=st.lists(st.tuples(st.integers(0, 3), days), max_size=25))
def test_previous_snapshot_by_key_brute_force(spark, snaps, trades):
    s = spark.createDataFrame([(str(k), d) for k, d in snaps], "sec_id string, datadate date")
    a = spark.createDataFrame([(i, k, d) for i, (k, d) in enumerate(trades)],
                              "id int, sec_id bigint, trade_date_est date")
    got = {r.id: r.snapshot_date for r in previous_snapshot_by_key(a, s, how="left").collect()}
    assert len(got) == len(trades)
    for i, (k, t) in enumerate(trades):
        earlier = [d for sk, d in snaps if sk == k and d < t]
        assert got[i] == (max(earlier) if earlier else None)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 1000)),
                     max_size=30, unique_by=lambda r: r[2]))
def test_dedup_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int, o int")
    got = sorted(tuple(r) for r in dedup_allocations(df, ["a", "b"], tie=["o"]).collect())
    best = {}
    for a, b, o in rows:
        if (a, b) not in best or o < best[(a, b)]:
            best[(a, b)] = o
    assert got == sorted((a, b, o) for (a, b), o in best.items())


@SETTINGS
@given(keys=st.lists(st.tuples(st.integers(0, 50), st.integers(0, 50)), unique=True, max_size=40),
       parts=st.integers(1, 6))
def test_assign_ids_is_row_number(spark, keys, parts):
    df = spark.createDataFrame(keys, "k1 int, k2 int")
    got = sorted((r.DATA_ID, r.k1, r.k2) for r in
                 assign_ids(df.repartition(3), ["k1", "k2"], num_partitions=parts).collect())
    assert got == [(i + 1, k1, k2) for i, (k1, k2) in enumerate(sorted(keys))]


@SETTINGS
@given(ids=st.lists(st.integers(1, 200), max_size=40), size=st.integers(1, 7))
def test_batches_cover_every_request_once(spark, ids, size):
    df = spark.createDataFrame([(i, "AB"[i % 2]) for i in ids], "DATA_ID bigint, prefix string")
    got = batch_requests(df, size).collect()
    assert len(got) == len(ids)
    for p in "AB":
        own = sorted((r.DATA_ID, r.batch_no) for r in got if r.prefix == p)
        assert [b for _, b in own] == [k // size for k in range(len(own))]


TOKENS = ["ZZ", "BB", "YY", "XX", "XX*", "0A", "0B", "O", "DA", "-W", "/F", "A", "B", "Z", "X", "*"]


@SETTINGS
@given(rows=st.lists(st.tuples(st.lists(st.sampled_from(TOKENS), max_size=4).map("".join),
                               st.sampled_from(["AUD", "THB", "USD", None])), max_size=30),
       mode=st.sampled_from(["always", "matched"]))
def test_local_ticker_matches_python_regex(spark, rows, mode):
    import re

    from pyspark.sql import functions as F

    from idweave.constants import TICKER_RULES
    from idweave.functions import local_ticker

    df = spark.createDataFrame(rows, "t string, c string")
    sym, base = local_ticker(F.col("t"), F.col("c"), TICKER_RULES, mode)
    got = [(r[0], r[1]) for r in df.select(sym, base).collect()]
    for (t, c), (s, b) in zip(rows, got):
        if c not in TICKER_RULES:
            assert (s, b) == (t, t)
            continue
        pattern, code = TICKER_RULES[c]
        stripped = re.sub(pattern, "", t, count=1)
        if mode == "always" or re.search(pattern, t):
            assert (s, b) == (stripped + code, stripped)
        else:
            assert (s, b) == (t, t)


ref_rows = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 6),
                              st.one_of(st.none(), st.sampled_from(["a", "b"]))),
                    max_size=10, unique_by=lambda r: (r[0], r[1]))


@SETTINGS
@given(trades=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 6)), max_size=15),
       eq=ref_rows, fu=ref_rows, offset=st.sampled_from([1, -1]))
def test_join_reference_brute_force(spark, trades, eq, fu, offset):
    from idweave.operators import join_reference

    def day(d):
        return BASE + dt.timedelta(days=d)

    def ref(rows):
        return spark.createDataFrame(
            [(str(k), int(day(d).strftime("%Y%m%d")), v, f"S{k}{v}", None, v) for k, d, v in rows],
            "sec_id string, file_eff_dt int, parent_id_undr string, sedol_id string, "
            "ticker string, isin_id string")

    alloc = spark.createDataFrame([(i, k, day(d)) for i, (k, d) in enumerate(trades)],
                                  "id int, sec_id bigint, trade_date_est date")
    got = {r.id: r for r in join_reference(alloc, ref(eq), ref(fu), offset_days=offset).collect()}
    assert len(got) == len(trades)
    for i, (k, d) in enumerate(trades):
        # file date - offset = trade date  <=>  file date = trade date + offset
        e = [r for r in eq if r[0] == k and r[1] == d + offset]
        f = [r for r in fu if r[0] == k and r[1] == d + offset]
        ev = e[0][2] if e else None
        fv = f[0][2] if f else None
        row = got[i]
        assert row.underlying_parent_id == (ev if ev is not None else fv)
        assert row.underlying_sedol == (f"S{k}{ev}" if e else (f"S{k}{fv}" if f else None))
        assert row.equity_file_eff_dt == (int(day(d + offset).strftime("%Y%m%d")) if e else None)
        assert row.fund_file_eff_dt_minus1 == (day(d) if f else None)
