"""The daily run: only the published rows that changed inputs touch are built again.

A published result keeps two companions (``idweave.versions``): its allocations with their ids and snapshot
dates, and its enriched rows. A daily run takes the rows of every input that came, went or changed since, finds
the allocations they touch, runs the job's own steps for those, and puts their rows in the place of the old
ones. What is published equals a full run over the new inputs with the same id registry.
"""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DEDUP_KEYS_3
from ..functions.columns import tag
from ..functions.dates import date_from_yyyymmdd
from ..operators import (dedup_allocations, filter_allocations, lookup_symbols, observe_count,
                         previous_snapshot, registered_ids, symbol_requests, with_file_days)
from ..session import materialize, stage_scope
from ..versions import companion, publish_version
from .identifiers import KEY_ROWS, TIE_KEYS, DuplicateKeys, enrich
from .inputs import Sources

log = logging.getLogger("idweave")

ALLOCATIONS, ENRICHED = "allocations", "enriched"


def source_changes(old: Sources, new: Sources) -> Sources:
    """The rows of each input that only one of the two has: what came and what went. A row that was changed is
    there in both its forms. For callers who do not get changes delivered: it reads all of both."""
    return Sources(*(getattr(old, n).exceptAll(getattr(new, n)).unionByName(getattr(new, n).exceptAll(getattr(old, n)))
                     for n in Sources.__dataclass_fields__))


def publish_state(src: Sources, table: str, keys=DEDUP_KEYS_3, ticker_mode: str = "always", offset_days: int = 1,
                  path: str | None = None) -> dict[str, int]:
    """A full run that daily runs can follow: the result as a version of ``table`` with its companions, ids from the
    registry ``<table>_ids``. Returns the rows of each."""
    with stage_scope(src.allocations.sparkSession):
        clean = dedup_allocations(filter_allocations(src.allocations), keys=keys, tie=TIE_KEYS)
        alloc = registered_ids(clean, keys, f"{table}_ids", path=f"{path}_ids" if path else None)
        alloc = materialize(previous_snapshot(alloc, src.snapshot_dates, how="left"), "allocations")
        enriched = _enriched(alloc.where("snapshot_date IS NOT NULL"), src, offset_days)
        return _publish(table, alloc, enriched, _resolved(enriched, src, ticker_mode), path)


def publish_daily(src: Sources, changes: Sources, table: str, keys=DEDUP_KEYS_3, ticker_mode: str = "always",
                  offset_days: int = 1, path: str | None = None) -> dict[str, int]:
    """Bring ``table``, published by ``publish_state`` or an earlier daily run, up to the inputs ``src``.

    ``changes`` holds, for each input, the rows that came or went since then, a changed row in both forms; more rows
    than that do no harm, and inputs without a change are empty frames. The other parameters must be those of
    the runs before. An allocation is touched by

    - changes of its own key: another row may survive, or none;
    - snapshot dates, if its latest earlier one is now another;
    - rows of the security master for its security and snapshot date;
    - reference rows for its security and date;
    - symbol rows that its requests meet, or met.

    Allocations, enriched rows and result become a new version in one step; a failed run leaves the old one.
    Returns the rows of each, and how many allocations were ``touched``.
    """
    spark = src.allocations.sparkSession
    with stage_scope(spark):
        old, old_enriched = companion(spark, table, ALLOCATIONS), companion(spark, table, ENRICHED)
        # allocations: keys with a change are deduplicated again, from all of their rows
        changed = materialize(filter_allocations(changes.allocations).select(*keys).distinct(), "changed-keys")
        again = _match(filter_allocations(src.allocations), changed, keys, "left_semi")
        again = registered_ids(dedup_allocations(again, keys=keys, tie=TIE_KEYS), keys, f"{table}_ids",
                               path=f"{path}_ids" if path else None)
        same = _match(old, changed, keys, "left_anti").withColumnRenamed("snapshot_date", "_before")
        alloc = materialize(previous_snapshot(
            same.withColumn("_new", F.lit(False)).unionByName(
                again.withColumn("_new", F.lit(True)).withColumn("_before", F.lit(None).cast("date"))),
            src.snapshot_dates, how="left"), "allocations")

        touched = [_match(old, changed, keys, "left_semi"),
                   alloc.where(F.col("_new") | ~F.col("_before").eqNullSafe(F.col("snapshot_date")))]
        by_master = changes.securities.select(F.col("sec_id").alias("_s"), F.col("datadate").alias("_d")).distinct()
        touched.append(alloc.join(by_master, (F.col("sec_id").cast("string") == F.col("_s"))
                                  & (F.col("snapshot_date") == F.col("_d")), "left_semi"))
        for ref in (changes.ref_equity, changes.ref_fund):
            met = ref.select(F.col("sec_id").cast("string").alias("_s"), F.date_sub(
                date_from_yyyymmdd(F.col("file_eff_dt")), offset_days).alias("_d")).distinct()
            touched.append(alloc.join(met, (F.col("sec_id").cast("string") == F.col("_s"))
                                      & (F.col("trade_date_est") == F.col("_d")), "left_semi"))
        requests = symbol_requests(old_enriched, ticker_mode=ticker_mode)
        touched.append(lookup_symbols(requests, changes.symbology))
        ids, n_touched = materialize(reduce(DataFrame.unionByName, [t.select("DATA_ID") for t in touched]).distinct(),
                                     "touched", count=True)

        alloc = alloc.drop("_new", "_before")
        part = _enriched(alloc.where("snapshot_date IS NOT NULL").join(ids, "DATA_ID", "left_semi"), src, offset_days)
        enriched = old_enriched.join(ids, "DATA_ID", "left_anti").unionByName(part)
        result = (spark.table(table).join(ids, "DATA_ID", "left_anti")
                  .unionByName(_resolved(part, src, ticker_mode)))
        counts = _publish(table, alloc, enriched, result, path)
    return {**counts, "touched": n_touched}


def _match(df: DataFrame, keys_of: DataFrame, keys, how: str) -> DataFrame:
    """Semi or anti join on ``keys``, where NULL equals NULL."""
    other = keys_of.select(*(F.col(k).alias(f"_key_{k}") for k in keys))
    on = F.lit(True)
    for k in keys:
        on = on & df[k].eqNullSafe(other[f"_key_{k}"])
    return df.join(other, on, how)


def _enriched(alloc: DataFrame, src: Sources, offset_days: int) -> DataFrame:
    """The enriched rows of allocations with snapshot dates, stored; ``DuplicateKeys`` if a file has a key twice."""
    stored = materialize(with_file_days(enrich(alloc, src, offset_days, key_rows=KEY_ROWS)), "enriched")
    most = stored.agg(F.max(KEY_ROWS)).first()[0]  # one stored column
    if (most or 1) > 1:
        raise DuplicateKeys(f"a (security, file date) has {most} rows in a reference file")
    return stored.drop(KEY_ROWS)


def _resolved(enriched: DataFrame, src: Sources, ticker_mode: str) -> DataFrame:
    carry = [c for c in enriched.columns if c != "DATA_ID"]
    requests = symbol_requests(enriched, ticker_mode=ticker_mode, keep_input=True)
    return tag(lookup_symbols(requests, src.symbology, carry=carry, date_col="trade_date_local"),
               process_type="historic")


def _publish(table: str, alloc: DataFrame, enriched: DataFrame, result: DataFrame, path: str | None) -> dict[str, int]:
    frames, seen = {}, {}
    for name, df in ((ALLOCATIONS, alloc), (ENRICHED, enriched), ("result", result)):
        frames[name], seen[name] = observe_count(df, f"daily_{name}")
    publish_version(frames.pop("result"), table, path=path, companions=frames)
    counts = {name: obs.get["rows"] for name, obs in seen.items()}
    log.info("published %s: %s", table, counts)
    return counts
