"""Versions behind one name: replacement without a gap, appending, failed and concurrent writes."""

import datetime as dt
import glob
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from idweave import versions as v
from idweave.session import scratch_path
from idweave.sinks import publish
from idweave.sources import snapshot_dates


@pytest.fixture
def name(spark):
    n = f"idweave_versions_{uuid.uuid4().hex}"
    yield n
    v.drop_versions(spark, n)
    assert v.unlisted_parts(spark, n) == []
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(n)]


def values(spark, name):
    return sorted(r.id for r in spark.table(name).collect())


def test_readers_meet_one_whole_version_at_any_time(spark, name):
    rows = 2000

    def version(k):
        return spark.range(rows).select(F.lit(k).alias("version"), "id").repartition(4)

    v.publish_version(version(0), name, keep=3)
    seen, errors, done = set(), [], threading.Event()

    def read():
        while not done.is_set():
            try:
                got = spark.table(name).groupBy("version").count().collect()
                assert len(got) == 1 and got[0]["count"] == rows, got
                seen.add(got[0]["version"])
            except Exception as e:  # reported below
                errors.append(str(e)[:500])

    readers = [threading.Thread(target=read) for _ in range(3)]
    for t in readers:
        t.start()
    for k in range(1, 9):
        v.publish_version(version(k), name, keep=3)
    done.set()
    for t in readers:
        t.join()
    assert not errors and len(seen) > 2
    found = v.current_version(spark, name)
    assert found.number == 9 and [n for n, _ in found.before] == [8, 7, 6]
    v.drop_before(spark, name)
    assert v.current_version(spark, name).before == () and spark.table(name).count() == rows
    assert len([t for t in spark.catalog.listTables() if t.name.startswith(f"{name}__v")]) == 1


@pytest.mark.parametrize("with_path", [False, True])
def test_failed_and_checked_writes_leave_the_version_before(spark, name, with_path):
    path = scratch_path(spark, "versions") if with_path else None
    v.publish_version(spark.range(5), name, path=path)
    bad = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(
        F.raise_error(F.lit("the write fails"))).cast("long").alias("id"))
    with pytest.raises(Exception, match="the write fails"):
        v.publish_version(bad, name, path=path)

    def refuse():
        raise ValueError("not these rows")

    for write in (v.publish_version, v.append_version):
        with pytest.raises(ValueError, match="not these rows"):
            write(spark.range(3), name, path=path, check=refuse)
    assert values(spark, name) == [0, 1, 2, 3, 4] and v.current_version(spark, name).number == 1
    assert v.unlisted_parts(spark, name) == []
    v.publish_version(spark.table(name).selectExpr("id * 2 AS id", "'x' AS more"), name, path=path)  # reads itself
    assert values(spark, name) == [0, 2, 4, 6, 8] and spark.table(name).columns == ["id", "more"]
    v.publish_version(spark.range(2), name, path=path, keep=0, fmt="orc", bucket_by=(2, "id"))
    assert values(spark, name) == [0, 1] and v.current_version(spark, name).before == ()
    if path:
        assert len(glob.glob(path.replace("file:", "") + "/*/")) == 1


def test_appending_rewrites_nothing_until_there_are_many_parts(spark, name):
    want = []
    for k in range(1, 6):
        found = v.append_version(spark.range(10 * k, 10 * k + 3), name, properties={"last": 10 * k + 2}, max_parts=3, keep=0)
        want += range(10 * k, 10 * k + 3)
        assert values(spark, name) == want
        assert len(found.parts) == [1, 2, 3, 1, 2][k - 1] and found.properties == {"last": 10 * k + 2}
    assert v.current_version(spark, name) == found


def test_a_second_writer_is_refused(spark, name):
    v.publish_version(spark.range(1), name)

    def meanwhile():
        v.publish_version(spark.range(2), name)

    with pytest.raises(v.ConcurrentWrite):
        v.publish_version(spark.range(3), name, check=meanwhile)
    assert values(spark, name) == [0, 1] and v.current_version(spark, name).number == 2


def test_a_plain_table_becomes_the_first_version(spark, name):
    publish(spark.range(4), name)
    assert v.current_version(spark, name) is None
    v.publish_version(spark.table(name).where("id > 1"), name)
    assert values(spark, name) == [2, 3]
    assert [n for n, _ in v.current_version(spark, name).before] == [0]
    v.drop_versions(spark, name)
    publish(spark.range(2), name)
    v.append_version(spark.range(7, 8), name)
    assert values(spark, name) == [0, 1, 7]


def test_partitions_of_the_current_version(spark, name):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 3)), (2, dt.date(2024, 1, 4))], "k int, datadate date")
    v.publish_version(df, name, partition_cols=["datadate"])
    assert sorted(r.datadate for r in snapshot_dates(spark, name).collect()) == [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]
    v.publish_version(df.where("k = 2"), name, partition_cols=["datadate"])
    assert [r.datadate for r in snapshot_dates(spark, name).collect()] == [dt.date(2024, 1, 4)]


def test_publish_checks_before_the_old_table_goes(spark):
    name = f"idweave_checked_{uuid.uuid4().hex}"

    def refuse():
        raise ValueError("not these rows")

    for path in (None, scratch_path(spark, "checked")):
        publish(spark.range(5), name, path=path)
        with pytest.raises(ValueError, match="not these rows"):
            publish(spark.range(3), name, path=path, check=refuse)
        assert spark.table(name).count() == 5
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
        if path:
            assert len(glob.glob(path.replace("file:", "") + "/*/")) == 1
        spark.sql(f"DROP TABLE {name}")


def test_a_commit_alters_the_view_and_never_drops_it(spark, name, tmp_path, monkeypatch):
    said = []
    v.publish_version(spark.range(3), name, path=str(tmp_path))
    plain = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (said.append(text), plain(self, text, *a, **k))[1])
    for n in (4, 5, 6):
        assert v.publish_version(spark.range(n), name, path=str(tmp_path)).number == n - 2
        found = v.current_version(spark, name)
        assert found.number == n - 2 and spark.table(name).count() == n
    v.drop_before(spark, name)
    assert v.current_version(spark, name).before == () and spark.table(name).count() == 6
    keys = [r["key"] for r in plain(spark, f"SHOW TBLPROPERTIES {name}").collect() if r["key"].startswith(v.MANIFEST)]
    assert len(keys) <= 2
    assert not [t for t in said if "REPLACE VIEW" in t or t.startswith("DROP VIEW")]
