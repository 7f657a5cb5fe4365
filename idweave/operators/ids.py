"""Dense, stable row ids in a total order, without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY k)`` with no partition sends every row to one
task. Here the frame is range-partitioned on the order keys (bounds sampled
from the data, so a hot key value is spread by the later keys), sorted within
each partition, and written once under the checkpoint root: the written files
fix the bounds, so the ids never change when a stage is re-run. Each row's
position inside its partition comes from ``monotonically_increasing_id`` (low
33 bits), and a per-partition offset (a prefix sum of partition sizes, one
number per partition, as ``zipWithIndex`` does) is broadcast: its size is
the partition count, a bound known before the job runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_LOW33 = (1 << 33) - 1


def assign_ids(df: DataFrame, order: Sequence[str], name: str = "DATA_ID",
               num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1..n (BIGINT) following ``order`` (ascending, NULLs first).

    Without ``num_partitions`` the range exchange uses the shuffle partition
    count and AQE may merge adjacent ranges (order is kept).
    Rows that tie on ``order`` get ids in an arbitrary order, as with
    ``ROW_NUMBER``. A hash of the whole row is appended to the range and sort
    keys, so a tied value held by a large share of rows is still spread over
    many range partitions instead of landing in one task. The hash is an expression, not a column:
    eight bytes a row that do not compress are not shuffled, and the sort works it out for ties only.
    """
    spark = df.sparkSession
    order_cols = [F.col(c).asc_nulls_first() for c in order]
    range_cols = [*order_cols, F.xxhash64(*[F.col(c) for c in df.columns])]
    ranged = (df.repartitionByRange(num_partitions, *range_cols) if num_partitions
              else df.repartitionByRange(*range_cols))
    staged = materialize(
        ranged
        .sortWithinPartitions(*range_cols)
        .withColumn("_pid", F.spark_partition_id().cast("bigint"))
        .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))),
        "ids")
    sizes = sorted((r["_pid"], r["n"]) for r in
                   staged.groupBy("_pid").agg(F.count("*").alias("n")).collect())
    offsets, run = [], 0
    for pid, cnt in sizes:
        offsets.append((pid, run))
        run += cnt
    schema = T.StructType([T.StructField("_pid", T.LongType(), False),
                           T.StructField("_off", T.LongType(), False)])
    off = spark.createDataFrame(offsets, schema)
    out = staged.join(F.broadcast(off), "_pid", "inner")
    return (out.withColumn(name, (F.col("_off") + F.col("_pos") + F.lit(1)).cast("bigint"))
            .select(name, *[c for c in df.columns if c != name]))


def dense_index(df: DataFrame, col: str, name: str) -> DataFrame:
    """Add ``name`` = dense rank (1..m, BIGINT) of ``col`` over the whole frame.

    ``df`` is written once and read for both the numbering and the join, so an
    expensive upstream plan is evaluated once.
    """
    df = materialize(df, "dense")
    ranks = assign_ids(df.select(col).distinct(), [col], name)
    return df.join(ranks, col, "inner")
