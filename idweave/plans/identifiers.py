"""The identifier jobs, composed from the operators.

``identifiers_historic`` (the flagship): filter -> dedup (three keys) -> ids ->
previous snapshot -> equity/fund join -> snapshot join -> SEDOL and ticker
requests (one pass, carrying the enriched columns) -> symbol lookup.

``identifiers_same_day``: filter -> dedup (two keys) -> same-day snapshot join
-> prefixed columns (``alloc_``, ``snap_``) -> equity/fund join.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import AUDIT_ALL, AUDIT_ANY, DEDUP_KEYS_2, DEDUP_KEYS_3, SECURITY_COLUMNS
from .inputs import Sources
from ..functions.columns import prefix_columns, tag
from ..operators import (assign_ids, audit_missing, dedup_allocations, duplicate_keys,
                         filter_allocations, join_reference, join_snapshot, lookup_symbols,
                         observe_count, previous_snapshot, previous_snapshot_by_key,
                         registered_ids, sedol_requests, symbol_requests, ticker_requests, with_file_days)
from ..session import materialize, stage_scope
from ..sinks import FILE_FORMATS, export_requests, publish, write_preview
from ..versions import publish_version

log = logging.getLogger("idweave")

TIE_KEYS = ("order_id", "line_no", "acct_id", "gross")  # unique together


KEY_ROWS = "_key_rows"


class DuplicateKeys(ValueError):
    """A reference file holds a (security, file date) more than once, so its rows would multiply trades."""


def allocations_with_ids(src: Sources, keys=DEDUP_KEYS_3, registry: str | None = None) -> DataFrame:
    """Deduplicated allocations with ids: 1..n of this run, or those of a ``registry`` that
    all runs share (``registered_ids``)."""
    clean = dedup_allocations(filter_allocations(src.allocations), keys=keys, tie=TIE_KEYS)
    return registered_ids(clean, keys, registry) if registry else assign_ids(clean, list(keys))


def enriched_historic(src: Sources, offset_days: int = 1, how: str = "inner",
                      keys=DEDUP_KEYS_3, asof: str = "table", skew: str = "aqe") -> DataFrame:
    """Allocations with ids, their snapshot identifiers and underlying identifiers.

    ``asof="table"`` takes the latest snapshot date of the whole table before
    the trade, which is what the original job does. ``asof="security"`` takes
    the latest snapshot in which that security appears.
    """
    prev = _as_of(allocations_with_ids(src, keys), src, how, asof, skew)
    return with_file_days(enrich(prev, src, offset_days, skew))


def enrich(prev: DataFrame, src: Sources, offset_days: int = 1, skew: str = "aqe",
           key_rows: str | None = None) -> DataFrame:
    """The stored allocations ``prev`` with their snapshot identifiers and underlying identifiers, without the
    columns of ``with_file_days``.

    The two left joins commute. The files are met first, while rows are narrow: a trade has its six identifiers whenever
    its snapshot does, and they are shuffled once less; the file columns of a trade without a row there are NULL.
    """
    files = join_reference(prev, src.ref_equity, src.ref_fund, offset_days=offset_days, skew=skew,
                           prune="keys", key_rows=key_rows, days=False)
    met = [c for c in files.columns if c not in prev.columns]
    return (join_snapshot(files, src.securities, on="snapshot_date", skew=skew)
            .select(*prev.columns, *SECURITY_COLUMNS, *met))


def _as_of(alloc: DataFrame, src: Sources, how: str, asof: str, skew: str) -> DataFrame:
    if asof == "table":
        return previous_snapshot(alloc, src.snapshot_dates, how=how)
    if asof == "security":
        # read for its dates, its keys and its rows: each time the security master would be shuffled again
        return materialize(previous_snapshot_by_key(alloc, src.securities, how=how, skew=skew), "as-of")
    raise ValueError(f"unknown as-of mode {asof!r}")


def identifiers_historic(src: Sources, ticker_mode: str = "always", offset_days: int = 1,
                         how: str = "inner", keys=DEDUP_KEYS_3, asof: str = "table",
                         skew: str = "aqe") -> DataFrame:
    """Enriched rows joined to every symbol-table answer of their requests.

    Same rows as ``attach_symbols(enriched, responses)``, but requests carry
    the enriched columns, so the enriched frame is computed once and there is
    no join back by ``DATA_ID``. With ``asof="security"``, which shuffles more, the trades with their snapshot
    dates and the enriched rows are stored, so that the shuffles of one part are gone before the next begins.
    """
    prev = _as_of(allocations_with_ids(src, keys), src, how, asof, skew)
    enriched = enrich(prev, src, offset_days, skew)
    if asof == "security":
        enriched = materialize(enriched, "enriched")
    requests = symbol_requests(enriched, ticker_mode=ticker_mode, keep_input=True)
    carry = [c for c in enriched.columns if c != "DATA_ID"]
    return with_file_days(lookup_symbols(requests, src.symbology, carry=carry, skew=skew, date_col="trade_date_local"))


def identifiers_same_day(src: Sources, offset_days: int = 1, keys=DEDUP_KEYS_2,
                         key_rows: str | None = None) -> DataFrame:
    alloc = dedup_allocations(filter_allocations(src.allocations), keys=keys, tie=TIE_KEYS)
    # the deduplicated rows are not stored: pruning by their dates would run the dedup again
    joined = join_snapshot(alloc, src.securities, on="trade_date_est", how="left", prune=False)
    named = prefix_columns(prefix_columns(joined, "snap_", keep=alloc.columns), "alloc_",
                           keep=["snap_" + c for c in SECURITY_COLUMNS])
    return join_reference(named, src.ref_equity, src.ref_fund, offset_days=offset_days,
                          key="alloc_sec_id", date_col="alloc_trade_date_est", prune=False,
                          key_rows=key_rows)


def publish_identifiers(src: Sources, table: str, path: str | None = None,
                        ticker_mode: str = "always", offset_days: int = 1, how: str = "inner",
                        keys=DEDUP_KEYS_3, audit_dir: str | None = None,
                        asof: str = "table", skew: str = "aqe", partition_cols: tuple = (),
                        stage_prefix: str | None = None, preview_rows: int = 100,
                        fmt: str = "parquet", versioned: bool = False, registry: str | None = None,
                        on_duplicates: str = "fail") -> dict[str, int]:
    """Build the historic result and replace ``table`` with it.

    A reference file with several rows for the (security, file date) of a trade stops the job before ``table`` is
    touched (``DuplicateKeys``): the most rows of a key are observed while the enriched rows are stored, without a pass
    of their own. ``on_duplicates="audit"`` goes on, and the trade has a row for each of them. With ``versioned`` the result is the next
    version of ``table`` (``versions.publish_version``), so readers never miss it. With ``registry``
    ids come from that registry and stay the same from run to run.

    Stage row counts are collected with ``observe`` while the stages are
    written (no extra pass) and returned. With ``stage_prefix`` every stage is
    published as a table of that prefix (allocations, snapshot, enriched,
    sedol_requests, ticker_requests, responses) and the next one reads it. With
    ``audit_dir``, audit files are written as CSV: every enriched row that lacks an
    external id, SEDOL or ticker, an ordered preview of ``preview_rows`` rows of
    the result, and any (security, file date) key that occurs more than once in the
    equity or fund file. The audit reads the stored enriched rows, so nothing runs twice.
    The intermediate stage folders are deleted once everything is written.
    """
    spark = src.allocations.sparkSession
    counts: dict[str, int] = {}

    def keep(df: DataFrame, stage: str, check=None) -> DataFrame:
        if stage_prefix is None:
            return df
        publish(df, f"{stage_prefix}_{stage}", fmt=fmt, check=check)
        return spark.table(f"{stage_prefix}_{stage}")

    with stage_scope(spark):
        alloc = keep(allocations_with_ids(src, keys, registry), "allocations")
        prev = _as_of(alloc, src, how, asof, skew)
        if stage_prefix:
            snap = keep(join_snapshot(prev, src.securities, on="snapshot_date", skew=skew), "snapshot")
            enriched = join_reference(snap, src.ref_equity, src.ref_fund, offset_days=offset_days, skew=skew,
                                      prune="keys", key_rows=KEY_ROWS)
        else:
            enriched = with_file_days(enrich(prev, src, offset_days, skew, key_rows=KEY_ROWS))
        enriched, seen_enriched = observe_count(enriched, "enriched", most=F.max(KEY_ROWS))
        enriched = enriched.drop(KEY_ROWS)
        checked = fmt in FILE_FORMATS  # whether a write can be checked before it replaces

        def check_keys():
            _check_keys(src, seen_enriched.get["most"], on_duplicates, audit_dir)

        if stage_prefix and checked:
            enriched = keep(enriched, "enriched", check_keys)
        elif stage_prefix:
            enriched = keep(enriched, "enriched")
            check_keys()
        else:  # stored, so that the shuffles behind it are gone before those of the lookup begin
            enriched = materialize(enriched, "enriched")
            check_keys()
        if stage_prefix:
            keep(sedol_requests(enriched), "sedol_requests")
            keep(ticker_requests(enriched, mode=ticker_mode), "ticker_requests")
        requests, seen_requests = observe_count(
            symbol_requests(enriched, ticker_mode=ticker_mode, keep_input=True), "requests")
        carry = [c for c in enriched.columns if c != "DATA_ID"]
        answers = lookup_symbols(requests, src.symbology, carry=carry, skew=skew, date_col="trade_date_local")
        if stage_prefix:
            answers = keep(answers, "responses")
        result, seen_result = observe_count(tag(answers, process_type="historic"), "result")
        if versioned:
            publish_version(result, table, partition_cols, path, fmt=fmt)
        else:
            publish(result, table, partition_cols=partition_cols, path=path, fmt=fmt)
        counts = {"enriched": seen_enriched.get["rows"], "requests": seen_requests.get["rows"],
                  "result": seen_result.get["rows"]}
        if audit_dir:
            _write_audit(src, audit_missing(enriched, AUDIT_ANY, "any"), spark.table(table),
                         ["DATA_ID", "prefix"], audit_dir, preview_rows)
    log.info("published %s: %s", table, counts)
    return counts


def publish_same_day(src: Sources, table: str, path: str | None = None, offset_days: int = 1,
                     keys=DEDUP_KEYS_2, audit_dir: str | None = None, partition_cols: tuple = (),
                     preview_rows: int = 100, fmt: str = "parquet", versioned: bool = False,
                     on_duplicates: str = "fail") -> dict[str, int]:
    """Build the same-day result and replace ``table`` with it; ``versioned`` and ``on_duplicates``
    as in ``publish_identifiers``. Returns the row counts of the
    result and of its rows without any identifier, observed while it is written. With
    ``audit_dir`` those rows and a preview are written from the published table."""
    with stage_scope(src.allocations.sparkSession) as _:
        spark = src.allocations.sparkSession
        result, seen = observe_count(identifiers_same_day(src, offset_days, keys, key_rows=KEY_ROWS), "same_day",
                                     most=F.max(KEY_ROWS))
        result, check = result.drop(KEY_ROWS), lambda: _check_keys(src, seen.get["most"], on_duplicates, audit_dir)
        if fmt not in FILE_FORMATS:
            result = materialize(result, "same-day")
            check = check()
        if versioned:
            publish_version(result, table, partition_cols, path, fmt=fmt, check=check)
        else:
            publish(result, table, partition_cols=partition_cols, path=path, fmt=fmt, check=check)
        missing, seen_missing = observe_count(
            audit_missing(spark.table(table), ["snap_" + c for c in AUDIT_ALL], "all"), "missing")
        counts = {"result": seen.get["rows"]}
        if audit_dir:
            _write_audit(src, missing, spark.table(table), list("alloc_" + k for k in keys), audit_dir,
                         preview_rows)
            counts["missing"] = seen_missing.get["rows"]
    log.info("published %s: %s", table, counts)
    return counts


def _check_keys(src: Sources, most: int | None, on_duplicates: str, audit_dir: str | None) -> None:
    """Raise if a key that trades met has several rows (``most``) in a file; the audit folder gets all such keys."""
    if on_duplicates not in ("fail", "audit"):
        raise ValueError(f"unknown mode {on_duplicates!r} for duplicate keys")
    if on_duplicates == "audit" or (most or 1) <= 1:
        return
    if audit_dir:
        _write_duplicates(src, audit_dir)
    raise DuplicateKeys(f"a (security, file date) has {most} rows in a reference file; duplicate_keys lists all")


def _write_duplicates(src: Sources, audit_dir: str) -> None:
    for name, ref in (("equity", src.ref_equity), ("fund", src.ref_fund)):
        export_requests(duplicate_keys(ref, ["sec_id", "file_eff_dt"]), f"{audit_dir}/duplicate_{name}_keys")


def _write_audit(src: Sources, missing: DataFrame, result: DataFrame, order: list[str],
                 audit_dir: str, preview_rows: int) -> None:
    export_requests(missing, f"{audit_dir}/missing_identifiers")
    write_preview(result, f"{audit_dir}/result_preview", order, preview_rows)
    _write_duplicates(src, audit_dir)


def run(process_type: str, src: Sources, **options) -> DataFrame | None:
    """``historic`` builds the result; ``daily`` does nothing; anything else fails."""
    if process_type == "historic":
        return tag(identifiers_historic(src, **options), process_type=process_type)
    if process_type == "daily":
        return None
    raise ValueError(f"invalid process type: {process_type!r}")
