"""Operator edge cases and invariants."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from idweave.operators import (assign_ids, attach_symbols, audit_missing, batch_requests,
                               dedup_allocations, dense_index, filter_allocations,
                               join_reference, join_snapshot, lookup_symbols,
                               lookup_with_service, merge_responses, previous_snapshot,
                               previous_snapshot_by_key, sedol_requests, stage_counts,
                               symbol_requests, ticker_requests, union_snapshots,
                               valid_requests)
from idweave.plans import identifiers as plan
from idweave.plans import run

D = dt.date


def _dates(spark, ds):
    return spark.createDataFrame([(d,) for d in ds], "datadate date")


def test_previous_snapshot_edges(spark):
    snaps = _dates(spark, [D(2024, 1, 1), D(2024, 1, 2), D(2024, 1, 4)])
    alloc = spark.createDataFrame([(1, D(2024, 1, 5)), (2, D(2024, 1, 3)), (3, D(2024, 1, 1)),
                                   (4, None)], "id int, trade_date_est date")
    inner = {r.id: r.snapshot_date for r in previous_snapshot(alloc, snaps).collect()}
    assert inner == {1: D(2024, 1, 4), 2: D(2024, 1, 2)}
    left = {r.id: r.snapshot_date for r in previous_snapshot(alloc, snaps, how="left").collect()}
    assert left == {1: D(2024, 1, 4), 2: D(2024, 1, 2), 3: None, 4: None}
    # a snapshot on the trade date itself counts only when not strict
    same = {r.id: r.snapshot_date
            for r in previous_snapshot(alloc, snaps, how="left", strict=False).collect()}
    assert same[3] == D(2024, 1, 1)


def test_previous_snapshot_by_key_strict(spark):
    snaps = spark.createDataFrame([("1", D(2024, 1, 1)), ("1", D(2024, 1, 3)), ("2", D(2024, 1, 2))],
                                  "sec_id string, datadate date")
    alloc = spark.createDataFrame([(1, D(2024, 1, 3)), (1, D(2024, 1, 4)), (2, D(2024, 1, 2)),
                                   (2, D(2024, 1, 9)), (3, D(2024, 1, 9))],
                                  "sec_id bigint, trade_date_est date")
    got = sorted((r.sec_id, r.trade_date_est, r.snapshot_date)
                 for r in previous_snapshot_by_key(alloc, snaps, how="left").collect())
    assert got == [(1, D(2024, 1, 3), D(2024, 1, 1)), (1, D(2024, 1, 4), D(2024, 1, 3)),
                   (2, D(2024, 1, 2), None), (2, D(2024, 1, 9), D(2024, 1, 2)),
                   (3, D(2024, 1, 9), None)]


def test_previous_snapshot_one_row_per_input(src):
    alloc = plan.allocations_with_ids(src)
    prev = previous_snapshot(alloc, src.snapshot_dates, how="left")
    assert prev.count() == alloc.count()
    assert prev.select("DATA_ID").distinct().count() == alloc.count()


def test_dedup_keeps_first_by_tie(spark):
    df = spark.createDataFrame(
        [(3, 1, "A"), (1, 1, "B"), (2, 1, "C"), (5, 2, "D"), (4, 2, "E")],
        "o int, k int, v string")
    got = sorted(tuple(r) for r in dedup_allocations(df, ["k"], tie=["o"]).collect())
    assert got == [(1, 1, "B"), (4, 2, "E")]


def test_dedup_deterministic_across_partitionings(src):
    a = filter_allocations(src.allocations)
    x = dedup_allocations(a, tie=plan.TIE_KEYS)
    y = dedup_allocations(a.repartition(13), tie=plan.TIE_KEYS)
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_assign_ids_dense_and_stable(spark, src):
    clean = dedup_allocations(filter_allocations(src.allocations), tie=plan.TIE_KEYS)
    keys = ["sec_id", "trade_date_est", "trade_date_local"]
    a = assign_ids(clean, keys)
    b = assign_ids(clean.repartition(5), keys, num_partitions=3)
    n = clean.count()
    ids = sorted(r[0] for r in a.select("DATA_ID").collect())
    assert ids == list(range(1, n + 1))
    assert dict(a.dtypes)["DATA_ID"] == "bigint"
    assert a.exceptAll(b).count() == 0
    # ids follow the order keys
    rows = a.orderBy("DATA_ID").select(*keys).collect()
    assert rows == sorted(rows)


def test_dense_index_and_batches(spark):
    rows = [(1, "A"), (5, "A"), (9, "A"), (5, "B"), (2, "B"), (7, None)]
    df = spark.createDataFrame(rows, "DATA_ID bigint, prefix string")
    got = sorted((r.prefix or "", r.DATA_ID, r.batch_no) for r in batch_requests(df, 2).collect())
    assert got == [("", 7, 0), ("A", 1, 0), ("A", 5, 0), ("A", 9, 1), ("B", 2, 0), ("B", 5, 0)]
    with pytest.raises(ValueError):
        batch_requests(df, 0)
    assert sorted(tuple(r) for r in dense_index(df.select("DATA_ID"), "DATA_ID", "r").collect()) == \
        [(1, 1), (2, 2), (5, 3), (5, 3), (7, 4), (9, 5)]
    text = spark.createDataFrame([("b",), ("a",), ("b",), ("c",)], "k string")
    assert sorted(tuple(r) for r in dense_index(text, "k", "r").collect()) == \
        [("a", 1), ("b", 2), ("b", 2), ("c", 3)]
    wide = spark.createDataFrame([(-5,), (10**12,), (7,)], "k bigint")
    assert sorted(tuple(r) for r in dense_index(wide, "k", "r").collect()) == \
        [(-5, 1), (7, 2), (10**12, 3)]


def test_joins_keep_row_count(src):
    alloc = plan.allocations_with_ids(src)
    prev = previous_snapshot(alloc, src.snapshot_dates)
    snap = join_snapshot(prev, src.securities)
    enriched = join_reference(snap, src.ref_equity, src.ref_fund)
    n = prev.count()
    assert snap.count() == n and enriched.count() == n


def test_join_reference_prefers_equity(spark):
    base = spark.createDataFrame([(1, D(2024, 1, 2)), (2, D(2024, 1, 2)), (3, D(2024, 1, 2))],
                                 "sec_id bigint, trade_date_est date")
    cols = "sec_id string, file_eff_dt int, parent_id_undr string, sedol_id string, ticker string, isin_id string"
    eq = spark.createDataFrame([("1", 20240103, None, "QS1", "QT1", "QI1")], cols)
    fu = spark.createDataFrame([("1", 20240103, "FV1", "FS1", "FT1", None),
                                ("2", 20240103, "FV2", "FS2", "FT2", "FI2")], cols)
    got = {r.sec_id: r for r in join_reference(base, eq, fu).collect()}
    assert (got[1].underlying_parent_id, got[1].underlying_sedol, got[1].underlying_isin) == \
        ("FV1", "QS1", "QI1")
    assert got[1].equity_file_eff_dt_minus1 == D(2024, 1, 2)
    assert got[2].underlying_sedol == "FS2" and got[2].equity_file_eff_dt is None
    assert got[3].underlying_sedol is None


def test_audit_modes(spark):
    df = spark.createDataFrame([(None, None), ("a", None), ("a", "b")], "x string, y string")
    assert audit_missing(df, ["x", "y"], "all").count() == 1
    assert audit_missing(df, ["x", "y"], "any").count() == 2
    with pytest.raises(ValueError):
        audit_missing(df, ["x"], "some")


def test_valid_requests_drops_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("",), ("S1",)], "SYMBOL_NAME string")
    assert [r[0] for r in valid_requests(df).collect()] == ["S1"]


def test_symbol_requests_equal_separate_builders(src):
    e = plan.enriched_historic(src)
    both = symbol_requests(e)
    sep = sedol_requests(e).unionByName(ticker_requests(e))
    assert both.exceptAll(sep).count() == 0 and sep.exceptAll(both).count() == 0


def test_lookup_date_bounds_inclusive(spark):
    req = spark.createDataFrame(
        [(1, "SED", "S1", D(2024, 1, 1)), (2, "SED", "S1", D(2024, 1, 31)),
         (3, "SED", "S1", D(2024, 2, 1)), (4, "BTKR", "S1", D(2024, 1, 5))],
        "DATA_ID bigint, prefix string, SYMBOL_NAME string, sym_date date")
    sym = spark.createDataFrame([("SED", "S1", D(2024, 1, 1), D(2024, 1, 31), "XS1")],
                                "prefix string, symbol string, valid_from date, valid_to date, resolved string")
    got = sorted(r.DATA_ID for r in lookup_symbols(req, sym).collect())
    assert got == [1, 2]


def test_merge_responses_by_name(spark):
    a = spark.createDataFrame([("1", "SED", "x")], "DATA_ID string, prefix string, resolved string")
    b = spark.createDataFrame([("BTKR", "2")], "prefix string, DATA_ID string")
    m = merge_responses(a, b)
    assert dict(m.dtypes)["DATA_ID"] == "bigint"
    assert sorted((r.DATA_ID, r.prefix, r.resolved) for r in m.collect()) == \
        [(1, "SED", "x"), (2, "BTKR", None)]


def test_union_snapshots_fills_missing(spark):
    a = spark.createDataFrame([(1, "a")], "k int, x string")
    b = spark.createDataFrame([("b", 2)], "x string, k int")
    c = spark.createDataFrame([(3,)], "k int")
    assert sorted(tuple(r) for r in union_snapshots(a, b, c).collect()) == \
        [(1, "a"), (2, "b"), (3, None)]


def test_attach_symbols_one_to_many(spark):
    e = spark.createDataFrame([(1, "a"), (2, "b")], "DATA_ID bigint, v string")
    r = spark.createDataFrame([(1, "x"), (1, "y")], "DATA_ID bigint, resolved string")
    got = sorted(tuple(x) for x in attach_symbols(e, r, prefix="sym_").collect())
    assert got == [(1, "a", "x"), (1, "a", "y")]


def test_lookup_with_service_runs_on_executors(spark):
    req = spark.createDataFrame([(i, "SED", f"S{i}", D(2024, 1, 1)) for i in (1, 5, 9, 12)],
                                "DATA_ID bigint, prefix string, SYMBOL_NAME string, sym_date date")

    def service(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"DATA_ID": pdf["DATA_ID"], "resolved": "X" + pdf["SYMBOL_NAME"],
                             "batch_size": len(pdf)})

    out = lookup_with_service(req, service, "DATA_ID long, resolved string, batch_size long", 2)
    got = sorted(tuple(r) for r in out.collect())
    assert got == [(1, "XS1", 2), (5, "XS5", 2), (9, "XS9", 2), (12, "XS12", 2)]


def test_stage_counts(spark):
    a = spark.range(5)
    b = spark.range(3)
    assert {r.stage: r.rows for r in stage_counts({"a": a, "b": b}).collect()} == {"a": 5, "b": 3}


def test_run_process_types(src):
    assert run("daily", src) is None
    with pytest.raises(ValueError):
        run("weekly", src)
    out = run("historic", src)
    assert "process_type" in out.columns


def test_historic_equals_attach_by_id(src):
    """The fused job equals the step-by-step join back by DATA_ID."""
    e = plan.enriched_historic(src)
    resp = merge_responses(lookup_symbols(sedol_requests(e), src.symbology),
                           lookup_symbols(ticker_requests(e), src.symbology))
    slow = attach_symbols(e, resp)
    fast = plan.identifiers_historic(src).select(*slow.columns)
    assert slow.exceptAll(fast).count() == 0 and fast.exceptAll(slow).count() == 0


def test_batches_evaluate_their_input_once(spark):
    """The numbering reads what it wrote: the input's scan is not in the returned plan."""
    df = spark.range(1000).selectExpr("id AS DATA_ID", "CASE WHEN id % 3 = 0 THEN 'A' ELSE 'B' END AS prefix")
    out = batch_requests(df, 100)
    assert "Range (" not in out._jdf.queryExecution().executedPlan().toString()
    size = {}
    for r in out.collect():
        size[r.prefix, r.batch_no] = size.get((r.prefix, r.batch_no), 0) + 1
    assert max(size.values()) == 100 and len(size) == 4 + 7


def test_publish_identifiers_counts_in_one_action(spark, src, expected):
    import glob

    from idweave.plans import publish_identifiers
    from idweave.session import checkpoint_root, scratch_path

    root = checkpoint_root(spark).replace("file:", "")

    def stage_dirs():
        return set(glob.glob(f"{root}/idweave/ids-*") + glob.glob(f"{root}/idweave/daymap-*"))

    before = stage_dirs()
    audit = scratch_path(spark, "audit")
    counts = publish_identifiers(src, "idweave_test_result", path=scratch_path(spark, "result"),
                                 audit_dir=audit)
    requests = expected["sedol_requests"] + expected["ticker_requests"]
    assert counts == {"enriched": expected["enriched"], "requests": requests, "result": expected["result"]}
    assert spark.table("idweave_test_result").count() == expected["result"]
    from idweave.sources import scan_csv
    assert scan_csv(spark, f"{audit}/result_preview").count() == 100
    assert scan_csv(spark, f"{audit}/duplicate_equity_keys").count() == 0
    assert scan_csv(spark, f"{audit}/duplicate_fund_keys").count() == 0
    # the intermediate stage folders (ids, day map) are deleted after the write
    assert stage_dirs() == before
    missing = audit_missing(plan.enriched_historic(src), ["ext_sec_id", "sedol", "ticker"], "any")
    assert scan_csv(spark, f"{audit}/missing_identifiers").count() == missing.count() > 0


def test_hot_security_is_split_by_aqe(spark):
    """One security holding a third of all allocations: AQE splits its join partition."""
    n = 60_000
    alloc = (spark.range(n).selectExpr(
        "id AS DATA_ID",
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS sec_id",
        "DATE'2024-01-02' AS snapshot_date"))
    secs = spark.range(n).selectExpr(
        "CAST(id AS STRING) AS sec_id", "DATE'2024-01-02' AS datadate",
        "concat('E', id) AS ext_sec_id", "CAST(NULL AS STRING) AS sedol",
        "CAST(NULL AS STRING) AS cusip", "CAST(NULL AS STRING) AS isin_no",
        "CAST(NULL AS STRING) AS ticker", "'USD' AS sec_currency")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = join_snapshot(alloc, secs, on="snapshot_date")
        rows = out.collect()  # runs this plan, so AQE's final plan is kept
        assert len(rows) == n
        assert sum(r.ext_sec_id == "E7" for r in rows) == n // 3 + 1  # id 7 is security 7 too
        plan_text = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan_text, plan_text
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_assign_ids_spreads_a_hot_tied_value(spark):
    """A third of the rows share one order value: they still span many partitions."""
    from pyspark.sql import functions as F

    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("payload"))
    out = assign_ids(df, ["k"], num_partitions=8)
    rows = out.select("DATA_ID", "k").collect()
    assert sorted(r.DATA_ID for r in rows) == list(range(1, 30_001))
    hot = [r.DATA_ID for r in rows if r.k == 0]
    assert sorted(hot) == list(range(1, 10_001))  # ties first, ids contiguous
    # the hot value was written by several range partitions (files), not one task
    files = out.filter("k = 0").select(F.input_file_name()).distinct().count()
    assert files > 1


def test_historic_result_does_not_depend_on_input_partitioning(spark, src):
    from dataclasses import replace

    a = plan.identifiers_historic(src)
    b = plan.identifiers_historic(replace(src, allocations=src.allocations.repartition(7, "acct_id")))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_empty_inputs(src):
    from dataclasses import replace

    from pyspark.sql import functions as F

    no_trades = replace(src, allocations=src.allocations.filter(F.lit(False)))
    out = plan.identifiers_historic(no_trades)
    assert out.count() == 0 and "resolved" in out.columns
    no_snaps = replace(src, snapshot_dates=src.snapshot_dates.filter(F.lit(False)))
    assert plan.identifiers_historic(no_snaps).count() == 0
    assert previous_snapshot(plan.allocations_with_ids(src), no_snaps.snapshot_dates,
                             how="left").filter("snapshot_date IS NULL").count() == 3136


def test_salted_join_equals_plain_join_and_spreads_the_hot_key(spark):
    from pyspark.sql import functions as F

    from idweave.operators import hot_keys, salted_join

    n = 40_000
    big = spark.range(n).select(
        F.col("id").alias("rid"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
        (F.col("id") % 5).alias("d"))
    small = spark.range(1000).select(F.col("id").alias("sk"), F.lit(2).alias("d_lo"),
                                     F.concat(F.lit("v"), F.col("id")).alias("v"))
    small = small.unionByName(small.withColumn("d_lo", F.lit(4)))  # two rows per key
    hot = [r.k for r in hot_keys(big, ["k"], min_share=0.05, fraction=0.2).collect()]
    assert hot == [7]
    for how in ("inner", "left"):
        plain = big.join(small, (big.k == small.sk) & (big.d >= small.d_lo), how)
        salted = salted_join(big, small, ["k"], ["sk"], how, condition=big.d >= small.d_lo,
                             min_share=0.05)
        cols = ["rid", "k", "d", "sk", "d_lo", "v"]
        assert salted.select(*cols).exceptAll(plain.select(*cols)).count() == 0
        assert plain.select(*cols).exceptAll(salted.select(*cols)).count() == 0
    # without broadcast and without AQE's skew split, the hot key's rows are
    # still spread over several join tasks by the salt
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        salted = salted_join(big, small, ["k"], ["sk"], "inner", min_share=0.05)
        spread = (salted.filter("k = 7").select(F.spark_partition_id().alias("p"))
                  .distinct().count())
        plain = big.join(small, big.k == small.sk, "inner")
        one = (plain.filter("k = 7").select(F.spark_partition_id().alias("p"))
               .distinct().count())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert one == 1 and spread > 1


def test_salted_join_spreads_null_keys(spark):
    from pyspark.sql import functions as F

    from idweave.operators import salted_join

    big = spark.range(20_000).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("k"))
    small = spark.range(50).select(F.col("id").alias("sk"))
    keep = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    try:
        out = salted_join(big, small, ["k"], ["sk"], "left")
        rows = out.select("id", "k", "sk", F.spark_partition_id().alias("p")).collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 20_000 and sum(r.sk is not None for r in rows) == 25
    assert len({r.p for r in rows if r.k is None}) > 1


def test_hot_key_of_the_reference_join_is_split_by_aqe(spark):
    """A third of the rows on one (security, date): the one join of the large side is split."""
    n = 60_000
    rows = spark.range(n).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS sec_id",
                                     "DATE'2024-01-02' AS trade_date_est")
    ref = spark.range(n).selectExpr("CAST(id AS STRING) AS sec_id", "20240103 AS file_eff_dt",
                                    *(f"concat('{c}', id) AS {c}" for c in
                                      ("parent_id_undr", "sedol_id", "ticker", "isin_id")))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = join_reference(rows, ref, ref.where("file_eff_dt = 0"), prune=False)
        assert len(out.collect()) == n
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bucketed_lookup_equals_plain(spark):
    from datetime import timedelta

    req = spark.createDataFrame(
        [(i, "SED", f"S{i % 3}", D(2024, 1 + i % 12, 1 + i % 28)) for i in range(60)],
        "DATA_ID bigint, prefix string, SYMBOL_NAME string, sym_date date")
    sym = spark.createDataFrame(
        [("SED", f"S{k % 3}", D(2023, 11, 20) + timedelta(days=9 * k),
          D(2023, 11, 25) + timedelta(days=9 * k + 40 * (k % 4)), f"X{k}") for k in range(60)]
        + [("SED", "S1", D(2024, 5, 2), D(2024, 5, 1), "never")],
        "prefix string, symbol string, valid_from date, valid_to date, resolved string")
    plain = sorted(map(tuple, lookup_symbols(req, sym).collect()))
    assert plain
    for bucket in ("month", "quarter", "year"):
        assert sorted(map(tuple, lookup_symbols(req, sym, bucket=bucket).collect())) == plain


def test_stages_are_published(spark, src, expected):
    import uuid

    mark = f"idweave_staged_{uuid.uuid4().hex}"
    counts = plan.publish_identifiers(src, f"{mark}_result", stage_prefix=mark)
    assert counts["result"] == expected["result"] == spark.table(f"{mark}_result").count()
    for stage, rows in (("allocations", "deduplicated"), ("enriched", "enriched"),
                        ("sedol_requests", "sedol_requests"), ("ticker_requests", "ticker_requests"),
                        ("responses", "responses")):
        assert spark.table(f"{mark}_{stage}").count() == expected[rows]
    assert "process_type" in spark.table(f"{mark}_sedol_requests").columns
    for stage in ("allocations", "snapshot", "enriched", "sedol_requests", "ticker_requests", "responses",
                  "result"):
        spark.sql(f"DROP TABLE {mark}_{stage}")


def test_same_day_plan_runs_the_dedup_once(spark, src):
    text = plan.identifiers_same_day(src)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Window [") == 1 and text.count("l_shipdate") > 0


def test_salted_job_equals_default(src):
    for asof in ("table", "security"):
        a = plan.identifiers_historic(src, asof=asof)
        b = plan.identifiers_historic(src, asof=asof, skew="salt")
        assert a.columns == b.columns
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_duplicate_keys(spark):
    from idweave.operators import duplicate_keys

    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a")], "k int, v string")
    assert sorted(tuple(r) for r in duplicate_keys(df, ["k", "v"]).collect()) == [(1, "a", 2)]
