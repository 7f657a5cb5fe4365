"""Session helpers and stage materialisation.

``scratch_path`` reads ``spark.checkpoint.dir`` from the session: on a cluster
that is the shared folder the cluster names. Only when it is unset (local runs,
tests) is a private temporary folder chosen.
"""

from __future__ import annotations

import atexit
import contextlib
import logging
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "idweave", extra: dict | None = None) -> SparkSession:
    """Session for tests and the benchmark. Jobs take the caller's session."""
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}
_SCOPES: list[list[str]] = []
_UNSCOPED: list[tuple[str, str]] = []
log = logging.getLogger("idweave")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (``spark.checkpoint.dir``).

    Only a local session may fall back to a private temporary folder; on a
    cluster the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # a remote session has no SparkContext
            root = None
    if not root:
        master = spark.conf.get("spark.master", None) or ""
        if not re.fullmatch(r"local(\[.*\])?", master):  # an unknown master counts as a cluster
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by the cluster: stage data "
                "written to a machine-local folder would be lost with its executor")
        # Unset in a local run or a test: one private folder per application.
        app = spark.conf.get("spark.app.id", "")
        root = _LOCAL_ROOTS.setdefault(app, tempfile.mkdtemp(prefix="idweave-ckpt-"))
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # a remote session has no SparkContext
            pass
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/idweave/{name}-{uuid.uuid4().hex}"


_CODEC = "spark.sql.parquet.compression.codec"


def compact(writer: DataFrameWriter, spark: SparkSession, fmt: str = "parquet") -> DataFrameWriter:
    """Let Parquet files be written with zstd, a third smaller than Spark's own choice, unless the session names a codec."""
    if fmt != "parquet" or spark.conf.get(_CODEC, None) is not None:
        return writer
    return writer.option("compression", "zstd")


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Files of the shuffles of a write inside the block go when that write ends, unless the session has its own setting.

    What it has written is read from then on. Without this they stay until the driver happens to collect its
    garbage, so that a job of several writes holds the shuffles of all of them on disk.
    """
    if spark.conf.get(_FREED, None) is not None:
        yield
        return
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREED)


def materialize(df: DataFrame, name: str = "stage", count: bool = False, partition_by: tuple[str, ...] = ()):
    """Write ``df`` as Parquet under the checkpoint root and read it back.

    Cuts lineage (a lost executor re-reads the files instead of re-running the
    stage), fixes anything non-deterministic upstream, and keeps the data
    columnar so later scans prune columns and push filters.
    With ``count=True`` also return the row count, observed during the write
    (no second pass). With ``partition_by`` the rows of each value are files of their own, so that a
    filter on it reads no others. The shuffles of the write are freed with it (``freed_shuffles``).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    else:
        _UNSCOPED.append((spark.conf.get("spark.app.id", ""), path))
    if count:
        obs = Observation(f"{name}_rows")
        df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = compact(df.write.mode("errorifexists"), spark)
    with freed_shuffles(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    reader = spark.read.schema(df.schema) if partition_by else spark.read  # without rows there are no such files
    out = reader.parquet(path)
    return (out, obs.get["rows"]) if count else out


ROWS_PER_TASK = 500_000
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SIZED: dict[str, str] = {}


def task_count(rows: int, rows_per_task: int = ROWS_PER_TASK) -> int:
    """How many tasks share ``rows`` so that none holds many more than ``rows_per_task``."""
    return max(1, -(-rows // rows_per_task))


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Let shuffles begin with a partition for every ``ROWS_PER_TASK`` of ``rows``, never fewer than
    ``spark.sql.shuffle.partitions``; AQE merges small ones again.

    A fixed partition count makes every task grow with the input until its sorts spill. The setting stays in the
    session, since the frames it is made for are read later; the next call sets it anew, and a
    number that the caller has chosen stays as it is.
    """
    app, now = spark.conf.get("spark.app.id", ""), spark.conf.get(_INITIAL, None)
    if now is not None and now != _SIZED.get(app):
        return
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if task_count(rows) > least:
        _SIZED[app] = str(task_count(rows))
        spark.conf.set(_INITIAL, _SIZED[app])
    elif now is not None:
        del _SIZED[app]
        spark.conf.unset(_INITIAL)


@contextlib.contextmanager
def stage_scope(spark: SparkSession):
    """Delete the stage folders written inside the block once it succeeds.

    Use it around a job that ends in a write (e.g. ``publish``): afterwards no
    plan reads the intermediate files any more. On failure they are kept.
    """
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES.pop()
    for p in paths:
        delete_folder(spark, p)


def hand_over(spark: SparkSession, path: str) -> None:
    """Leave the last stage folder of the innermost ``stage_scope`` to the scope around it: it outlives its own."""
    _SCOPES[-1].remove(path)
    if len(_SCOPES) > 1:
        _SCOPES[-2].append(path)
    else:
        _UNSCOPED.append((spark.conf.get("spark.app.id", ""), path))


def drop_stages(spark: SparkSession) -> None:
    """Delete the stage folders that lazily returned frames of this application read.
    Call it once those frames have been consumed; inside ``stage_scope`` it is not needed."""
    app = spark.conf.get("spark.app.id", "")
    for entry in [e for e in _UNSCOPED if e[0] == app]:
        _UNSCOPED.remove(entry)
        delete_folder(spark, entry[1])


def delete_folder(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
    except Exception as e:  # a remote session cannot reach the file system API
        log.warning("could not delete stage folder %s: %s", path, e)


@atexit.register
def _drop_local_stages() -> None:
    """Stage folders written outside a ``stage_scope`` (e.g. by a query that
    returns a lazy DataFrame) live until the process ends. Folders on the
    local file system are removed then; on a shared folder ``drop_stages`` removes them."""
    for _, p in _UNSCOPED:
        local = p[len("file:"):] if p.startswith("file:") else p
        if "://" not in local and os.path.isdir(local):
            shutil.rmtree(local, ignore_errors=True)
