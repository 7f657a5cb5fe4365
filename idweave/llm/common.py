"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Python
    tasks can import it wherever the library itself is not installed."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    # texts make long rows: smaller Arrow batches than by default, unless the session has its own
    if spark.conf.get(BATCH_CONF) == "67108864b":
        spark.conf.set(BATCH_CONF, "4m")
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(package)
    with tempfile.NamedTemporaryFile(prefix=f"{name}-", suffix=".zip", delete=False) as f:
        with zipfile.ZipFile(f, "w") as z:
            for folder, _, files in os.walk(package):
                for file in sorted(files):
                    if file.endswith(".py"):
                        path = os.path.join(folder, file)
                        z.write(path, os.path.join(name, os.path.relpath(path, package)))
    spark.sparkContext.addPyFile(f.name)
    _SHIPPED.add(app)


_TABLES: dict[str, dict] = {}


def worker_table(owner: str) -> dict:
    """In a task: what ``owner`` remembers in this Python worker. Spark reuses workers, so the
    tables of operators that ran there before are dropped."""
    for other in [o for o in _TABLES if o != owner]:
        del _TABLES[other]
    return _TABLES.setdefault(owner, {})


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character left as it is."""
    return F.translate(c, UPPER, LOWER)


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """Only the two columns an operator works on (and ``more``), under fixed names, so that
    no other column of the caller can clash. A null text counts as empty."""
    ship(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
                     *more)


def join_counted(rows: DataFrame, table: DataFrame, keys: list[str], total: int, spread: list[str],
                 how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table``, which has one row for each key and in ``n`` how many of the ``total``
    rows hold it; ``n`` is dropped. No task gets all rows of a key that holds more than a shuffle
    partition's share: such rows are dealt by a hash of their ``spread`` columns, and the key's row of
    ``table`` is copied as often. Fewer keys than there are shuffle partitions are that hot, and only
    they are broadcast."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = max(1, total // parts)
    deals, deal = "deals of the key", "deal of the row"  # no column of an operator has these names
    hot = table.where(F.col("n") > share).select(*keys, F.ceil(F.col("n") / share).cast("int").alias(deals))
    copies = F.when(F.col("n") > share, F.ceil(F.col("n") / share).cast("int")).otherwise(1)
    dealt = F.explode(F.sequence(F.lit(0), copies - 1)).alias(deal)
    table = table.select(*(c for c in table.columns if c != "n"), dealt)
    rows = (rows.join(F.broadcast(hot), keys, "left")
            .withColumn(deal, F.coalesce(F.pmod(F.xxhash64(*spread), F.col(deals)).cast("int"), F.lit(0))).drop(deals))
    return rows.join(table, [*keys, deal], how).drop(deal)


__all__ = ["join_counted", "ship", "worker_table", "read_table", "ascii_lower", "id_text", "materialize", "scratch_path"]
