"""Bytes that no step needs are neither shuffled nor stored."""

import datetime
import glob
import os
import time
import uuid

import pytest

from idweave import fixtures, queries, session, sinks, versions
from idweave.operators import assign_ids, ids, join_reference, registered_ids
from idweave.plans import identifiers

SF = "/root/testdata/sf0.001"
REF = "sec_id string, file_eff_dt int, parent_id_undr string, sedol_id string, ticker string, isin_id string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def stored(monkeypatch):
    """The frames that ``module`` stores, by the name of their stage."""
    seen = {}

    def watch(module):
        before = module.materialize

        def keep(df, name="stage", **options):
            seen[name] = df
            return before(df, name, **options)

        monkeypatch.setattr(module, "materialize", keep)
        return seen

    return watch


def test_the_hash_that_spreads_ties_is_not_shuffled(spark, stored):
    seen = stored(ids)
    df = spark.createDataFrame([(k % 3 if k % 5 else None, k // 2) for k in range(60)], "k int, v int")
    out = assign_ids(df, ["k"])
    text = seen["ids"]._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in text and "xxhash64" in text and "_tie" not in text
    got = sorted(rows(out))
    assert [i for i, *_ in got] == list(range(1, 61))
    assert [k for _, k, _ in got] == sorted((k for _, k, _ in got), key=lambda k: (k is not None, k))


def test_file_dates_are_worked_out_after_the_join(spark):
    day = datetime.date(2024, 1, 2)
    df = spark.createDataFrame([(1, day), (2, day), (3, day), (4, day), (None, day), (1, None)], "sec_id int, trade_date_est date")
    eq = spark.createDataFrame([("1", 20240103, "p", "s", "t", "i"), ("3", 20240103, None, "s", "t", "i"),
                                ("4", None, "p", "s", "t", "i"), (None, 20240103, "p", "s", "t", "i")], REF)
    fu = spark.createDataFrame([("2", 20240103, "q", "s", "t", "i"), ("3", 20240103, "q", "s", "t", "i"),
                                ("1", 20240104, "q", "s", "t", "i")], REF)
    out = join_reference(df, eq, fu)
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "date_sub" not in text.split("Join")[0] and text.count("AS equity_file_eff_dt_minus1") == 1
    assert "isnotnull(equity_file_eff_dt" in text.split("Join")[0]
    got = rows(out.select("sec_id", "trade_date_est", *(f"{f}_file_eff_dt{m}" for f in ("equity", "fund") for m in ("", "_minus1"))))
    file = 20240103
    assert got == sorted([(1, day, file, day, None, None), (2, day, None, None, file, day), (3, day, file, day, file, day),
                          (4, day, None, None, None, None), (None, day, None, None, None, None),
                          (1, None, None, None, None, None)], key=repr)


@pytest.mark.parametrize("name", ["merge_responses", "stage_counts"])
def test_only_the_columns_that_requests_read_are_stored(spark, stored, name):
    seen = stored(queries)
    queries.queries()[name](spark, SF)
    assert set(seen["enriched"].columns) == set(queries.ASKED)


def test_stages_are_zstd_unless_the_session_names_a_codec(spark):
    def files(df):
        return [f for p in df.inputFiles() for f in glob.glob(p.removeprefix("file://"))]

    def written():
        return files(session.materialize(spark.range(10).toDF("x"), "codec"))

    assert written() and all(f.endswith(".zstd.parquet") for f in written())
    spark.conf.set("spark.sql.parquet.compression.codec", "gzip")
    try:
        assert all(f.endswith(".gz.parquet") for f in written())
    finally:
        spark.conf.unset("spark.sql.parquet.compression.codec")


def test_rows_of_a_version_outlive_its_name_without_a_copy(spark, tmp_path):
    name = f"detached_{uuid.uuid4().hex}"
    df = spark.createDataFrame([(i, f"{i % 3:02d}") for i in range(20)] + [(None, None)], "v int, part string")
    versions.publish_version(df.limit(3), name, path=str(tmp_path))
    versions.publish_version(df, name, ("part",), path=str(tmp_path), companions={"more": df.limit(2)})
    versions.append_version(df.limit(1), name, path=str(tmp_path))
    before, columns, types = rows(spark.table(name)), spark.table(name).columns, spark.table(name).dtypes
    out = versions.detach(spark, name)
    assert (out.columns, out.dtypes, rows(out)) == (columns, types, before)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(name)]
    assert len(list(tmp_path.iterdir())) == 2  # the folders of the two parts
    versions.publish_version(df, name)
    with pytest.raises(ValueError, match="folder of its own"):
        versions.detach(spark, name)
    assert rows(spark.table(name)) == rows(df)
    versions.drop_versions(spark, name)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key_rows", [None, "most"])
def test_files_cut_to_the_keys_of_the_trades_give_the_same_rows(spark, key_rows):
    """Keys that repeat on every side or are NULL, trades without a file's row and files' rows without a trade."""
    day, other = datetime.date(2024, 1, 2), datetime.date(2024, 1, 5)
    df = spark.createDataFrame([(i, k, d) for i, (k, d) in enumerate(
        [(1, day), (1, day), (2, day), (3, day), (4, day), (1, other), (None, day), (1, None)])],
        "id int, sec_id int, trade_date_est date")
    eq = spark.createDataFrame([("1", 20240103, "p", "s", None, "i"), ("1", 20240103, "p2", None, "t", "i"),
                                ("3", 20240103, None, None, "t", "i"), ("9", 20240103, "p", "s", "t", "i"),
                                (None, 20240103, "p", "s", "t", "i"), ("4", None, "p", "s", "t", "i")], REF)
    fu = spark.createDataFrame([("1", 20240103, "q", "u", "v", None), ("1", 20240103, None, "u", "v", None),
                                ("2", 20240103, "q", "u", "v", "j"), ("3", 20240103, "q", "u", "v", "j"),
                                ("2", 20240106, "q", "u", "v", "j"), (None, 20240103, "q", "u", "v", "j")], REF)
    whole = join_reference(df, eq, fu, key_rows=key_rows)
    cut = join_reference(df, eq, fu, prune="keys", key_rows=key_rows)
    assert cut.columns == whole.columns and cut.dtypes == whole.dtypes
    assert rows(cut) == rows(whole) and len(rows(cut)) == 14
    with pytest.raises(ValueError, match="unknown prune mode"):
        join_reference(df, eq, fu, prune="some")


def test_dated_job_meets_the_files_while_its_rows_are_narrow(spark):
    """historic_identifiers_dated: no file row without a trade meets the trades, identifiers and the days that follow
    from other columns are not shuffled before they are needed."""
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.debug.maxToStringFields": "1000"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        text = plan_of(queries.queries()["historic_identifiers_dated"](spark, SF))
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "FullOuter" not in text
    # from the top: requests to symbols, trades to snapshots, trades to files' rows, keys to either file
    joins = [line.split("SortMergeJoin ", 1)[1] for line in text.splitlines() if "SortMergeJoin [" in line]
    assert [j[1:].split("#")[0] for j in joins[:5]] == ["prefix", "_ak", "_k", "_ak", "_ak"]
    lookup = text.split("Exchange hashpartitioning(prefix", 1)
    assert "_minus1" in lookup[0] and "_minus1" not in lookup[1] and "sym_date" not in text


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (os.path.basename(str(files.apply(i))) for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def left_over(spark, before, wait=10):
    """The shuffle files that have come since ``before`` and stay."""
    until = time.time() + wait
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left


def shuffled(spark):
    return spark.range(3000).repartition(5, "id").groupBy("id").count().repartition(3, "count")


@pytest.mark.parametrize("how", ["materialize", "publish", "publish_version"])
def test_shuffles_of_a_write_go_with_it(spark, how, tmp_path):
    """attach_symbols and all jobs of several writes: what is stored is read from then on, its shuffles are not."""
    name, before = f"freed_{uuid.uuid4().hex}", shuffle_files(spark)
    if how == "materialize":
        session.materialize(shuffled(spark), "freed")
    elif how == "publish":
        sinks.publish(shuffled(spark), name, path=str(tmp_path))
    else:
        versions.publish_version(shuffled(spark), name, path=str(tmp_path))
    assert not left_over(spark, before) and spark.conf.get(FREED, None) is None
    if how != "materialize":
        assert spark.table(name).count() == 3000
        versions.drop_versions(spark, name) if how == "publish_version" else spark.sql(f"DROP TABLE {name}")


def test_a_session_may_keep_its_shuffles(spark):
    spark.conf.set(FREED, "false")
    try:
        df = shuffled(spark)
        with session.freed_shuffles(spark):
            assert spark.conf.get(FREED) == "false"
        assert session.materialize(df, "kept").count() == 3000 and spark.conf.get(FREED) == "false"
    finally:
        spark.conf.unset(FREED)
    with pytest.raises(ZeroDivisionError), session.freed_shuffles(spark):
        assert spark.conf.get(FREED) == "true"
        1 / 0
    assert spark.conf.get(FREED, None) is None


def test_trades_with_their_own_snapshots_are_stored_once(spark, stored):
    """historic_identifiers_by_security: the window over the security master is not part of three later plans."""
    seen = stored(identifiers)
    text = plan_of(queries.queries()["historic_identifiers_by_security"](spark, SF))
    assert {"as-of", "enriched"} <= set(seen) and "Window" not in text
    assert "Window" not in plan_of(seen["enriched"]) and "snapshot_date" in seen["as-of"].columns


def test_rows_with_registered_ids_are_stored_and_the_stages_before_them_are_not(spark, tmp_path):
    """published_versions_of_identifiers: later passes over the rows do not join the registry again."""
    name, day = f"ids_{uuid.uuid4().hex}", datetime.date(2024, 1, 2)
    df = spark.createDataFrame([(k, day if k != 2 else None, v) for k in (3, 1, None, 2) for v in "ab"],
                               "k int, d date, v string")
    try:
        first = rows(registered_ids(df.where("k < 3"), ["k", "d"], name))
        with session.stage_scope(spark) as stages:
            out = registered_ids(df, ["k", "d"], name)
            assert "Join" not in plan_of(out) and len(stages) == 1
            folders = os.listdir(os.path.dirname(stages[0].removeprefix("file:")))
            got = rows(out)
        assert not os.path.exists(stages[0].removeprefix("file:")) and stages[0].split("/")[-1].startswith("registered-")
        assert [f for f in folders if f == stages[0].split("/")[-1]]
        assert {(k, d, v): i for i, k, d, v in first}.items() <= {(k, d, v): i for i, k, d, v in got}.items()
        assert sorted({i for i, *_ in got}) == [1, 2, 3, 4] and len(got) == 8
    finally:
        versions.drop_versions(spark, name)


def test_published_job_stores_its_enriched_rows(spark, stored):
    seen, name = stored(identifiers), f"result_{uuid.uuid4().hex}"
    counts = identifiers.publish_identifiers(fixtures.sources(spark, SF), name, versioned=True, registry=f"{name}_ids",
                                             partition_cols=("prefix",))
    try:
        assert "enriched" in seen and identifiers.KEY_ROWS not in seen["enriched"].columns
        assert counts["enriched"] > 0 and counts["result"] == spark.table(name).count()
    finally:
        versions.drop_versions(spark, name)
        versions.drop_versions(spark, f"{name}_ids")
