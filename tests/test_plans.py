"""Plan shape: the properties that matter at scale."""

from idweave.operators import dedup_allocations, filter_allocations, join_reference, join_snapshot
from idweave.operators import previous_snapshot
from idweave.plans import identifiers as plan


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_groups_before_shuffle(src):
    df = dedup_allocations(filter_allocations(src.allocations), tie=plan.TIE_KEYS)
    p = _plan(df)
    assert "WindowGroupLimit" in p
    # the map-side limit sits below the exchange
    assert p.index("Exchange hashpartitioning") < p.rindex("WindowGroupLimit")


def test_filter_pushed_to_scan(src):
    """On a stored allocations table the type/status filter becomes Parquet filters."""
    from idweave.session import materialize

    table = materialize(src.allocations, "alloc-table")
    p = _plan(filter_allocations(table).select("sec_id", "trade_date_est"))
    scan = [ln for ln in p.splitlines() if "FileScan parquet" in ln][0]
    assert "In(sec_typ_cd, [ADR,COM,GDR,MFC,MFO,PFD])" in scan
    assert "EqualTo(status,ACCT)" in scan
    # column pruning: only the projected and filtered columns are read
    assert "ReadSchema: struct<sec_id:bigint,sec_typ_cd:string,status:string,trade_date_est:date>" in scan


def test_no_single_partition_or_nested_loop_over_allocations(src):
    alloc = plan.allocations_with_ids(src)
    p = _plan(previous_snapshot(alloc, src.snapshot_dates))
    assert "SinglePartition" not in p
    assert "BroadcastNestedLoopJoin" not in p  # the nested loop only touched the day map


def test_reference_files_join_the_left_side_once(spark, src):
    alloc = plan.allocations_with_ids(src)
    snap = join_snapshot(previous_snapshot(alloc, src.snapshot_dates), src.securities)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = _plan(join_reference(snap, src.ref_equity, src.ref_fund))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # the two files meet each other first, then the left side once
    assert p.count("SortMergeJoin [_k") == 2 and p.count("FullOuter") == 1
    assert p.count("hashpartitioning(_k") == 3  # left once, equity once, fund once


def test_flagship_has_no_join_back_by_id(src):
    p = _plan(plan.identifiers_historic(src))
    assert "hashpartitioning(DATA_ID" not in p
    # requests meet the symbol table on both keys, no re-shuffle of the symbol table
    assert "hashpartitioning(prefix" in p


def test_lookup_drops_empty_symbols_before_the_shuffle(spark):
    import datetime as dt
    from idweave.operators import lookup_symbols

    req = spark.createDataFrame([(1, "SED", "S1", dt.date(2024, 1, 1))],
                                "DATA_ID bigint, prefix string, SYMBOL_NAME string, sym_date date")
    sym = spark.createDataFrame([("SED", "S1", dt.date(2024, 1, 1), dt.date(2024, 2, 1), "X")],
                                "prefix string, symbol string, valid_from date, valid_to date, resolved string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = lookup_symbols(req, sym)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NOT (SYMBOL_NAME" in p or "NOT (SYMBOL_NAME#" in p or "isnotnull(SYMBOL_NAME" in p


def test_checkpoint_root_is_read_from_the_session(spark):
    from idweave.session import checkpoint_root

    conf = spark.conf.get("spark.checkpoint.dir", None)
    root = checkpoint_root(spark)
    if conf:
        assert root == conf.rstrip("/")
    assert checkpoint_root(spark) == root


def test_bucketed_security_master_is_not_shuffled(spark, src):
    from idweave.session import scratch_path
    from idweave.sinks import publish

    publish(src.securities, "idweave_sec_bucketed", path=scratch_path(spark, "sec-bucketed"),
            bucket_by=(8, "sec_id", "datadate"))
    secs = spark.table("idweave_sec_bucketed")
    alloc = plan.allocations_with_ids(src)
    prev = previous_snapshot(alloc, src.snapshot_dates)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_snapshot(prev, secs)
        p = _plan(joined)
        assert joined.count() == prev.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [ln for ln in p.splitlines() if "idweave_sec_bucketed" in ln or "sec-bucketed" in ln]
    assert scans and "SelectedBucketsCount: 8 out of 8" in p
    # the allocation side is shuffled (plus the tiny distinct of the dates it
    # needs); the bucketed security master is read as it is stored
    assert p.count("Exchange hashpartitioning(_ak") == 1
    assert p.count("Exchange hashpartitioning") == 2 and "hashpartitioning(_need" in p
    assert "hashpartitioning(_sk" not in p


def test_snapshot_join_prunes_unused_snapshots(spark, src):
    """Snapshots no trade asks for are dropped before the join's shuffle."""
    alloc = plan.allocations_with_ids(src)
    prev = previous_snapshot(alloc, src.snapshot_dates)
    p = _plan(join_snapshot(prev, src.securities))
    assert "LeftSemi" in p
    assert join_snapshot(prev, src.securities).count() == \
        join_snapshot(prev, src.securities, prune=False).count()


def test_flagship_has_no_single_partition_exchange(spark, src):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the full static plan
    try:
        p = _plan(plan.identifiers_historic(src))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert "SinglePartition" not in p
    # the only nested-loop joins build the fixture security master (part x dates)
    nl = [ln for ln in p.splitlines() if "BroadcastNestedLoopJoin" in ln]
    assert all("p_partkey" in ln for ln in nl)
