"""Allocation cleaning: type/status filter and keyed deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ALLOCATION_STATUS, ALLOCATION_TYPES, DEDUP_KEYS_3


def filter_allocations(df: DataFrame, types: Sequence[str] = ALLOCATION_TYPES,
                       status: str = ALLOCATION_STATUS) -> DataFrame:
    """Keep allocations of the given security types with the given status.

    Plain column predicates, so Catalyst pushes them into the Parquet scan.
    """
    return df.filter(F.col("sec_typ_cd").isin(list(types)) & (F.col("status") == F.lit(status)))


def dedup_allocations(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS_3,
                      tie: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``; the survivor is the first by ``tie`` (deterministic).

    ``row_number() == 1`` is planned with a map-side ``WindowGroupLimit``: each
    task keeps one row per key before the shuffle, so a key that holds a third
    of all rows ships one row per map task, not a third of the table.
    ``tie`` defaults to every non-key column, a total order over distinct rows.
    """
    keys = list(keys)
    tie = [c for c in df.columns if c not in keys] if tie is None else list(tie)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in tie])
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))
