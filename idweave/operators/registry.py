"""Ids that outlive a run: a registry of key -> id that only grows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import hand_over, materialize, stage_scope
from ..versions import append_version, current_version
from .ids import assign_ids

LAST_ID = "last_id"


def registered_ids(df: DataFrame, keys: Sequence[str], registry: str, name: str = "DATA_ID",
                   path: str | None = None) -> DataFrame:
    """Add ``name``: the id that ``registry`` holds for the row's ``keys``, a new one where it holds none.

    Keys that the registry lacks (an anti-join; NULL is a key value like any other) are numbered in key
    order from its last id on and appended as one part of a new version. Ids that were given never change,
    and every key has one, whatever later runs bring or leave out. Rows with equal keys share an id.
    The registry's old parts are neither rewritten nor numbered again; its last id is in its manifest. Of two
    runs at a time the second to commit is refused (``ConcurrentWrite``) and can be repeated.
    ``df`` is stored once: it is read for the new keys and for the rows. So are the rows with their ids, as
    ``assign_ids`` stores its own: a job reads them several times, and each time would join the registry anew. The other
    stages are deleted.
    """
    spark, keys = df.sparkSession, list(keys)
    with stage_scope(spark) as stages:
        stored = materialize(df, "to-number")
        version = current_version(spark, registry)
        last = version.properties.get(LAST_ID, 0) if version else 0
        new = stored.select(*keys).distinct()
        if version:
            new = new.join(*_known(new, spark.table(registry), keys, name), "left_anti")
        numbered = assign_ids(new, keys, name).withColumn(name, F.col(name) + F.lit(last).cast("bigint"))
        top = numbered.agg(F.max(name)).first()[0]
        if top is not None or version is None:
            append_version(numbered, registry, path=path, properties={LAST_ID: top or 0})
        known, on = _known(stored, spark.table(registry), keys, name)
        out = materialize(stored.join(known, on, "inner").select(name, *df.columns), "registered")
        hand_over(spark, stages[-1])
    return out


def _known(df: DataFrame, registry: DataFrame, keys: list[str], name: str):
    """The registry under names that cannot clash with those of ``df``, and the condition that joins them."""
    known = registry.select(name, *(F.col(k).alias(f"_known_{k}") for k in keys))
    on = F.lit(True)
    for k in keys:
        on = on & df[k].eqNullSafe(known[f"_known_{k}"])
    return known, on
