"""Unions."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_snapshots(*frames: DataFrame) -> DataFrame:
    """Union by name (e.g. current and history snapshot tables); missing columns NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
