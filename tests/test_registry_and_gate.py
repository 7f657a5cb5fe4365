"""Ids that live across runs, the duplicate-key gate, and partition pruning of the security master."""

import datetime as dt
import uuid
from dataclasses import replace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from idweave import versions as v
from idweave.operators import join_snapshot, registered_ids
from idweave.plans import DuplicateKeys, publish_identifiers, publish_same_day
from idweave.plans import identifiers as plan
from idweave.session import scratch_path

D = dt.date
SCHEMA = "k string, d date, payload int"


def fresh(what):
    return f"idweave_{what}_{uuid.uuid4().hex}"


def by_key(df):
    return {(r.k, r.d): r.DATA_ID for r in df.collect()}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                                   st.sampled_from([D(2024, 1, 1), D(2024, 1, 2), None])), max_size=8), min_size=2, max_size=4))
def test_ids_stay_from_run_to_run(spark, runs):
    name, given_ids = fresh("registry"), {}
    try:
        for n, keys in enumerate(runs):
            df = spark.createDataFrame([(k, d, n) for k, d in keys], SCHEMA)
            out = registered_ids(df, ["k", "d"], name)
            assert out.columns == ["DATA_ID", "k", "d", "payload"] and out.count() == len(keys)
            new = sorted(set(keys) - given_ids.keys(), key=lambda x: [(y is not None, y) for y in x])
            given_ids |= {key: len(given_ids) + 1 + i for i, key in enumerate(new)}
            assert by_key(out) == {key: given_ids[key] for key in keys}
        assert by_key(spark.table(name)) == given_ids
    finally:
        v.drop_versions(spark, name)


def test_a_run_without_new_keys_writes_nothing(spark):
    name = fresh("registry")
    df = spark.createDataFrame([("a", D(2024, 1, 1), 1)], SCHEMA)
    registered_ids(df, ["k", "d"], name)
    before = v.current_version(spark, name)
    assert by_key(registered_ids(df, ["k", "d"], name)) == {("a", D(2024, 1, 1)): 1}
    assert v.current_version(spark, name) == before and before.properties == {"last_id": 1}
    v.drop_versions(spark, name)


def test_the_first_run_may_be_empty(spark):
    name = fresh("registry")
    assert registered_ids(spark.createDataFrame([], SCHEMA), ["k", "d"], name).count() == 0
    df = spark.createDataFrame([("b", None, 1)], SCHEMA)
    assert by_key(registered_ids(df, ["k", "d"], name)) == {("b", None): 1}
    v.drop_versions(spark, name)


def with_a_second_row(src, spark):
    """The sources with one more equity row for the key of a trade that has one."""
    e = plan.enriched_historic(src).where("equity_file_eff_dt IS NOT NULL").orderBy("DATA_ID").first()
    again = (src.ref_equity.where((F.col("sec_id") == str(e.sec_id)) & (F.col("file_eff_dt") == e.equity_file_eff_dt))
             .withColumn("ticker", F.lit("another")))
    assert again.count() == 1
    return replace(src, ref_equity=src.ref_equity.unionByName(again))


@pytest.mark.parametrize("options", [{}, {"stages": True}, {"audit": True}, {"versioned": True}],
                         ids=["plain", "stages", "audit", "versioned"])
def test_a_duplicated_file_key_stops_the_job(spark, src, expected, options):
    name, audit = fresh("gate"), scratch_path(spark, "gate-audit")
    more = {"stage_prefix": f"{name}_s"} if "stages" in options else {"audit_dir": audit} if "audit" in options else options
    publish_identifiers(src, name, path=scratch_path(spark, "gate"), **more)
    twice = with_a_second_row(src, spark)
    with pytest.raises(DuplicateKeys, match="2 rows"):
        publish_identifiers(twice, name, path=scratch_path(spark, "gate"), **more)
    assert spark.table(name).count() == expected["result"]  # the old rows
    if "audit" in options:
        assert spark.read.option("header", True).csv(f"{audit}/duplicate_equity_keys").count() == 1
        counts = publish_identifiers(twice, name, path=scratch_path(spark, "gate"), on_duplicates="audit", **more)
        assert counts["result"] > expected["result"] and counts["enriched"] == expected["enriched"] + 1
    v.drop_versions(spark, name)
    for t in [t.name for t in spark.catalog.listTables() if t.name.startswith(name)]:
        spark.sql(f"DROP TABLE {t}")


def test_the_same_day_job_has_the_gate_too(spark, src):
    name, path = fresh("gate"), scratch_path(spark, "gate")
    e = plan.identifiers_same_day(src).where("fund_file_eff_dt IS NOT NULL").first()
    again = src.ref_fund.where((F.col("sec_id") == str(e.alloc_sec_id)) & (F.col("file_eff_dt") == e.fund_file_eff_dt))
    twice = replace(src, ref_fund=src.ref_fund.unionByName(again))
    with pytest.raises(DuplicateKeys):
        publish_same_day(twice, name, path=path)
    assert not spark.catalog.tableExists(name)
    rows = publish_same_day(src, name, path=path, versioned=True)["result"]
    assert publish_same_day(twice, name, path=path, versioned=True, on_duplicates="audit")["result"] > rows
    v.drop_versions(spark, name)


def scans(node):
    """The file scans of an executed plan, those inside query stages too."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return scans(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return scans(node.plan())
    found = [node] if name == "FileSourceScanExec" else []
    children = node.children()
    for k in range(children.size()):
        found += scans(children.apply(k))
    return found


def test_only_the_partitions_that_trades_ask_for_are_read(spark, src):
    name = fresh("master")
    v.publish_version(src.securities, name, partition_cols=["datadate"], path=scratch_path(spark, "master"))
    dates = src.snapshot_dates.count()
    alloc = plan.allocations_with_ids(src).where("trade_date_est BETWEEN '1996-04-01' AND '1996-06-15'")
    prev = plan.previous_snapshot(alloc, src.snapshot_dates)
    wanted = prev.select("snapshot_date").distinct().count()
    read = {}
    for prune in (True, False):
        out = join_snapshot(prev, spark.table(name), prune=prune)
        rows = out.collect()
        plan_ = out._jdf.queryExecution().executedPlan()
        master = [s for s in scans(plan_) if f"{name}__v" in s.toString() or "datadate" in s.toString()]
        master = [s for s in master if "ext_sec_id" in s.toString()]
        assert len(master) == 1
        read[prune] = (len(rows), master[0].metrics().apply("numPartitions").value(), "dynamicpruning" in master[0].toString())
    assert read[True] == (read[False][0], wanted, True)
    assert read[False][1] == dates > wanted
    v.drop_versions(spark, name)
