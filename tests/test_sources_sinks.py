"""Sources and sinks: CSV quoting, SQL text, partition listings, tables."""

import datetime as dt

import pandas as pd

from idweave.session import scratch_path
from idweave.sinks import export_requests, preview, publish, write_preview
from idweave.sources import from_local, scan_csv, snapshot_dates, sql_relation


def test_csv_quoting_and_null_vs_empty(spark):
    path = scratch_path(spark, "csv-test")
    df = spark.createDataFrame([(1, 'he said "hi", ok'), (2, ""), (3, None)], "id int, s string")
    export_requests(df, path)
    back = {r.id: r.s for r in scan_csv(spark, path, schema=df.schema).collect()}
    assert back == {1: 'he said "hi", ok', 2: "", 3: None}
    # no schema: all text
    assert all(t == "string" for _, t in scan_csv(spark, path).dtypes)


def test_csv_reads_doubled_quotes(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text('a,b\n1,"he said ""hi"", ok"\n')
    r = scan_csv(spark, str(p)).first()
    assert r.b == 'he said "hi", ok'


def test_sql_relation_binds_frames_and_args(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2025, 1, 1))],
                               "k int, d date")
    out = sql_relation(spark, "SELECT k FROM {t} WHERE d < :cut", args={"cut": dt.date(2024, 6, 1)},
                       t=df)
    assert [r.k for r in out.collect()] == [1]


def test_snapshot_dates_from_partitions(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 3)), (2, dt.date(2024, 1, 4))],
                               "k int, datadate date")
    publish(df, "idweave_test_parts", partition_cols=["datadate"],
            path=scratch_path(spark, "parts"))
    got = sorted(r.datadate for r in snapshot_dates(spark, "idweave_test_parts").collect())
    assert got == [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]
    # publishing again replaces the table
    publish(df.filter("k = 1"), "idweave_test_parts", partition_cols=["datadate"],
            path=scratch_path(spark, "parts"))
    assert spark.table("idweave_test_parts").count() == 1


def test_partition_text_formats(spark):
    from pyspark.sql import functions as F
    raw = spark.createDataFrame([("datadate=2024-01-03",), ("datadate=20240103",),
                                 ("region=x/datadate=2024-01-05",)], "partition string")
    value = F.regexp_extract(F.col("partition"), "(^|/)datadate=([^/]*)", 2)
    got = [r[0] for r in raw.select(F.coalesce(F.try_to_date(value, "yyyy-MM-dd"),
                                               F.try_to_date(value, "yyyyMMdd"))).collect()]
    assert got == [dt.date(2024, 1, 3), dt.date(2024, 1, 3), dt.date(2024, 1, 5)]


def test_preview_is_ordered_top_n(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r.k for r in preview(df, ["k"], 3).collect()] == [0, 1, 2]
    path = scratch_path(spark, "preview")
    write_preview(df, path, ["k"], 5)
    assert scan_csv(spark, path).count() == 5


def test_from_local(spark):
    pdf = pd.DataFrame({"DATA_ID": [1, 2], "resolved": ["a", None]})
    df = from_local(spark, pdf, "DATA_ID long, resolved string")
    assert sorted((r.DATA_ID, r.resolved) for r in df.collect()) == [(1, "a"), (2, None)]


def test_command_line_job(spark, src, expected, tmp_path):
    from idweave.__main__ import main
    from idweave.session import materialize

    paths = {}
    for name in ("allocations", "securities", "ref_equity", "ref_fund", "symbology"):
        df = materialize(getattr(src, name), name)
        paths[name] = df.inputFiles()[0].rsplit("/", 1)[0]
    publish(src.securities, "idweave_cli_securities", partition_cols=["datadate"],
            path=scratch_path(spark, "cli-sec"))
    argv = ["historic", "--process-type", "historic", "--allocations", paths["allocations"],
            "--securities", "idweave_cli_securities", "--equity", paths["ref_equity"],
            "--fund", paths["ref_fund"], "--symbology", paths["symbology"],
            "--output", "idweave_cli_result", "--output-path", scratch_path(spark, "cli-out"),
            "--partition-by", "prefix"]
    counts = main(argv, spark=spark)
    assert counts["result"] == expected["result"]
    assert spark.table("idweave_cli_result").count() == expected["result"]
    parts = sorted(r[0] for r in spark.sql("SHOW PARTITIONS idweave_cli_result").collect())
    assert parts == ["prefix=BTKR", "prefix=SED"]
    daily = ["historic", "--process-type", "daily"] + argv[3:]
    assert main(daily, spark=spark) is None
    dates = main(["partitions", "--table", "idweave_cli_securities"], spark=spark)
    assert len(dates) == src.snapshot_dates.count() and dates == sorted(dates)
    from idweave.sinks import export_requests

    csv, text = scratch_path(spark, "cli-equity"), tmp_path / "securities.sql"
    export_requests(src.ref_equity.select("ticker", "sec_id", "isin_id", "file_eff_dt", "sedol_id",
                                          "parent_id_undr"), csv)
    text.write_text("SELECT * FROM idweave_cli_securities WHERE datadate < :data_date")
    same = ["same-day", "--allocations", paths["allocations"], "--securities", str(text),
            "--equity", f"csv:{csv}", "--fund", paths["ref_fund"], "--output", "idweave_cli_same_day",
            "--output-path", scratch_path(spark, "cli-same"), "--audit-dir", scratch_path(spark, "cli-audit")]
    counts = main(same, spark=spark)
    from idweave.plans import identifiers_same_day

    want = identifiers_same_day(src)
    got = spark.table("idweave_cli_same_day")
    assert got.count() == want.count() == counts["result"]
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert counts["missing"] == got.where("snap_ext_sec_id IS NULL AND snap_sedol IS NULL AND snap_cusip IS "
                                          "NULL AND snap_isin_no IS NULL AND snap_ticker IS NULL").count()


def test_sql_script_from_file(spark, tmp_path):
    from idweave.sources import sql_script

    p = tmp_path / "q.sql"
    p.write_text("SELECT k * 2 AS k2\nFROM {t}\nWHERE k > :lo\n")
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert sorted(r.k2 for r in sql_script(spark, str(p), args={"lo": 1}, t=df).collect()) == [4, 6]


def test_export_request_batches(spark):
    import glob

    from idweave.sinks import export_request_batches

    df = spark.createDataFrame([(i, f"S{i}", "SED") for i in (1, 5, 9, 12, 30)],
                               "DATA_ID bigint, SYMBOL_NAME string, prefix string")
    path = scratch_path(spark, "batches")
    export_request_batches(df, path, 2)
    local = path.replace("file:", "")
    assert sorted(p.rsplit("=", 1)[1] for p in glob.glob(f"{local}/prefix=SED/batch_no=*")) == ["0", "1", "2"]
    back = scan_csv(spark, path, schema="DATA_ID bigint, SYMBOL_NAME string, batch_no bigint")
    assert sorted((r.DATA_ID, r.batch_no) for r in back.collect()) == \
        [(1, 0), (5, 0), (9, 1), (12, 1), (30, 2)]


def test_timestamp_text(spark):
    from pyspark.sql import functions as F

    from idweave.functions import day_end, timestamp_text

    df = spark.createDataFrame([(dt.date(2024, 1, 3),)], "d date")
    assert df.select(timestamp_text(day_end(F.col("d")))).first()[0] == "2024-01-03 23:59:00"


def _raising(spark):
    from pyspark.sql import functions as F

    return spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(
        F.raise_error(F.lit("the write fails"))).cast("long").alias("id"))


def test_a_failed_publish_leaves_the_old_table(spark):
    import glob
    import uuid

    import pytest

    for path in (None, scratch_path(spark, "replaced")):
        name = f"idweave_replaced_{uuid.uuid4().hex}"
        publish(spark.range(5), name, path=path)
        with pytest.raises(Exception, match="the write fails"):
            publish(_raising(spark), name, path=path)
        assert sorted(r.id for r in spark.table(name).collect()) == [0, 1, 2, 3, 4]
        publish(spark.table(name).selectExpr("id * 2 AS id", "'x' AS more"), name, path=path)  # reads itself
        assert sorted(r.id for r in spark.table(name).collect()) == [0, 2, 4, 6, 8]
        assert spark.table(name).columns == ["id", "more"]
        if path:
            assert len(glob.glob(path.replace("file:", "") + "/*/")) == 1  # older versions are gone
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(name + "_")]
        home = spark.catalog.getDatabase("default").locationUri.replace("file:", "")
        assert not glob.glob(f"{home}/{name}_*")  # nor does the failed write leave files
        publish(spark.range(3), name, path=path, fmt="orc")
        assert spark.table(name).count() == 3
        spark.sql(f"DROP TABLE {name}")


def test_csv_columns_are_found_by_name(spark, tmp_path):
    import pytest

    (tmp_path / "a.csv").write_text('file_eff_dt,more,sec_id\n20240103,x,"A"\nnot a number,,""\n')
    rows = scan_csv(spark, str(tmp_path), schema="sec_id string, file_eff_dt int").collect()
    assert [tuple(r) for r in rows] == [("A", 20240103), ("", None)]
    with pytest.raises(ValueError, match="lacks other"):
        scan_csv(spark, str(tmp_path), schema="sec_id string, other int")


def test_default_date_of_a_sql_relation(spark):
    import datetime

    from idweave.sources import sql_relation

    row = sql_relation(spark, "SELECT :data_date AS d, count(*) AS n FROM {t}", t=spark.range(3)).first()
    assert (row.d, row.n) == (datetime.date(2025, 1, 1), 3)


def test_an_unknown_master_needs_a_checkpoint_folder(spark):
    import pytest

    from idweave import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_stage_folders_can_be_dropped(spark):
    import os

    from idweave import session

    kept = session.materialize(spark.range(3), "droptest")
    folder = kept.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "").replace("file:", "")
    assert os.path.isdir(folder) and kept.count() == 3
    held = list(session._UNSCOPED)
    session._UNSCOPED[:] = [e for e in held if "droptest" in e[1]]  # leave the other tests' stages
    session.drop_stages(spark)
    session._UNSCOPED[:] = [e for e in held if "droptest" not in e[1]]
    assert not os.path.exists(folder)
