"""Registered queries: one per operator, each reading the given tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame. The
matching DuckDB text is in ``idweave.oracles``; column names agree.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fixtures as fx
from .constants import AUDIT_ALL, AUDIT_ANY, DEDUP_KEYS_2, DEDUP_KEYS_3, REFERENCE_SCHEMA
from .functions import normalize_dates, prefix_columns, tag
from .functions.dates import timestamp_text, yyyymmdd_text
from .operators import (ServiceFailed, attach_symbols, duplicate_keys, audit_missing, batch_requests,
                        compress_snapshots, dedup_allocations, expand_intervals, filter_allocations,
                        join_intervals, join_reference, join_snapshot,
                        lookup_symbols, lookup_with_ledger, merge_responses, previous_snapshot,
                        previous_snapshot_by_key, sedol_requests, snapshot_calendar, stage_counts,
                        symbol_requests,
                        ticker_requests, union_snapshots, valid_requests)
from .plans import identifiers as plan
from .plans import publish_daily, publish_state
from .session import materialize, scratch_path
from .sinks import export_request_batches, export_requests, preview, publish
from .sources import scan_csv, scan_csv_checked, snapshot_dates, sql_relation
from .versions import append_version, detach, drop_versions, publish_version

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _src(spark, sf_dir) -> fx.Sources:
    return fx.sources(spark, sf_dir)


def _filtered(spark, sf_dir):
    return filter_allocations(fx.allocations(spark, sf_dir))


def _ided(spark, sf_dir):
    return plan.allocations_with_ids(_src(spark, sf_dir))


def _enriched(spark, sf_dir):
    return plan.enriched_historic(_src(spark, sf_dir))


def _stored(spark, sf_dir, columns=None):
    """The enriched rows written once, for queries that use them more than once; with ``columns`` only those that
    the query's steps read, as a plan that is not cut by a write would have them."""
    e = _enriched(spark, sf_dir)
    return materialize(e.select(*columns) if columns else e, "enriched")


ASKED = ("DATA_ID", "sec_id", "trade_date_local", "sec_currency", "ticker", "sedol")  # what requests are made of


# ---- allocations ---------------------------------------------------------

@query
def filter_allocations_q(spark, sf_dir):
    """allocations of the kept security types with status ACCT."""
    return _filtered(spark, sf_dir)


@query
def dedup_allocations_q(spark, sf_dir):
    """One allocation per (security, trade date EST, trade date local)."""
    return dedup_allocations(_filtered(spark, sf_dir), DEDUP_KEYS_3, tie=plan.TIE_KEYS)


@query
def dedup_allocations_two_keys(spark, sf_dir):
    """One allocation per (security, trade date EST)."""
    return dedup_allocations(_filtered(spark, sf_dir), DEDUP_KEYS_2, tie=plan.TIE_KEYS)


@query
def dedup_allocations_by_account(spark, sf_dir):
    """Dedup keyed on the account instead of the security (many more ties)."""
    return dedup_allocations(_filtered(spark, sf_dir),
                             ("acct_id", "trade_date_est", "trade_date_local"),
                             tie=("order_id", "line_no", "sec_id"))


@query
def assign_ids_q(spark, sf_dir):
    """DATA_ID = 1..n over the deduplicated allocations, in key order."""
    return _ided(spark, sf_dir)


# ---- as-of lookups and enrichment ----------------------------------------

@query
def previous_snapshot_q(spark, sf_dir):
    """Latest snapshot date strictly before each trade (inner)."""
    src = _src(spark, sf_dir)
    return previous_snapshot(plan.allocations_with_ids(src), src.snapshot_dates)


@query
def previous_snapshot_left(spark, sf_dir):
    """J5 with allocations that have no earlier snapshot kept (NULL)."""
    src = _src(spark, sf_dir)
    return previous_snapshot(plan.allocations_with_ids(src), src.snapshot_dates, how="left")


@query
def previous_snapshot_by_key_q(spark, sf_dir):
    """Per security: its own latest snapshot strictly before the trade."""
    src = _src(spark, sf_dir)
    return previous_snapshot_by_key(plan.allocations_with_ids(src), src.securities)


@query
def join_snapshot_same_day(spark, sf_dir):
    """Snapshot identifiers of the trade date itself (left join)."""
    src = _src(spark, sf_dir)
    alloc = dedup_allocations(filter_allocations(src.allocations), DEDUP_KEYS_2, tie=plan.TIE_KEYS)
    return join_snapshot(alloc, src.securities, on="trade_date_est")


@query
def join_snapshot_previous(spark, sf_dir):
    """Snapshot identifiers of the previous snapshot (left join)."""
    src = _src(spark, sf_dir)
    prev = previous_snapshot(plan.allocations_with_ids(src), src.snapshot_dates)
    return join_snapshot(prev, src.securities, on="snapshot_date")


@query
def audit_missing_all(spark, sf_dir):
    """rows where all five identifiers are NULL."""
    return audit_missing(join_snapshot_previous(spark, sf_dir), AUDIT_ALL, mode="all")


@query
def audit_missing_any(spark, sf_dir):
    """rows where the external id, SEDOL or ticker is NULL."""
    return audit_missing(join_snapshot_previous(spark, sf_dir), AUDIT_ANY, mode="any")


@query
def join_reference_q(spark, sf_dir):
    """Underlying identifiers from the equity, then fund file."""
    return _enriched(spark, sf_dir)


@query
def join_reference_previous_day(spark, sf_dir):
    """Files dated the day before the trade (offset -1)."""
    src = _src(spark, sf_dir)
    prev = previous_snapshot(plan.allocations_with_ids(src), src.snapshot_dates)
    snap = join_snapshot(prev, src.securities, on="snapshot_date")
    return join_reference(snap, src.ref_equity, src.ref_fund, offset_days=-1)


# ---- requests and lookup -------------------------------------------------

@query
def sedol_requests_q(spark, sf_dir):
    """C4: SEDOL requests with day bounds (valid symbols only)."""
    return sedol_requests(_enriched(spark, sf_dir))


@query
def ticker_requests_q(spark, sf_dir):
    """Local-ticker requests, suffix stripped and exchange code added."""
    return ticker_requests(_enriched(spark, sf_dir), mode="always")


@query
def ticker_requests_matched(spark, sf_dir):
    """C5 (dated cut): only tickers ending in a suffix token are rewritten."""
    return ticker_requests(_enriched(spark, sf_dir), mode="matched")


@query
def valid_requests_q(spark, sf_dir):
    """requests with a NULL or empty symbol dropped."""
    e = _stored(spark, sf_dir)
    raw = sedol_requests(e, valid_only=False).unionByName(ticker_requests(e, valid_only=False))
    return valid_requests(raw)


@query
def batch_requests_q(spark, sf_dir):
    """Batches of 500 requests per prefix, in id order."""
    return batch_requests(symbol_requests(_enriched(spark, sf_dir)), 500)


@query
def lookup_symbols_sedol(spark, sf_dir):
    """SEDOL requests resolved against the dated symbol table."""
    src = _src(spark, sf_dir)
    return lookup_symbols(sedol_requests(plan.enriched_historic(src)), src.symbology)


@query
def lookup_symbols_ticker(spark, sf_dir):
    """Ticker requests resolved against the dated symbol table."""
    src = _src(spark, sf_dir)
    return lookup_symbols(ticker_requests(plan.enriched_historic(src)), src.symbology)


@query
def merge_responses_q(spark, sf_dir):
    """SEDOL and ticker responses unioned by name."""
    src = _src(spark, sf_dir)
    e = _stored(spark, sf_dir, ASKED)
    return merge_responses(lookup_symbols(sedol_requests(e), src.symbology),
                           lookup_symbols(ticker_requests(e), src.symbology))


@query
def attach_symbols_q(spark, sf_dir):
    """Responses joined back to the enriched rows by DATA_ID, prefixed."""
    src = _src(spark, sf_dir)
    e = _stored(spark, sf_dir)
    resp = merge_responses(lookup_symbols(sedol_requests(e), src.symbology),
                           lookup_symbols(ticker_requests(e), src.symbology))
    return attach_symbols(e, resp, prefix="sym_")


# ---- jobs ----------------------------------------------------------------

@query
def historic_identifiers(spark, sf_dir):
    """C3 (flagship) through run('historic'): the published result rows."""
    return plan.run("historic", _src(spark, sf_dir))


@query
def historic_identifiers_matched(spark, sf_dir):
    """C2 ticker rule inside the flagship."""
    return plan.identifiers_historic(_src(spark, sf_dir), ticker_mode="matched")


@query
def historic_identifiers_dated(spark, sf_dir):
    """The dated cut: two dedup keys, matched tickers, files dated the day before."""
    return plan.identifiers_historic(_src(spark, sf_dir), ticker_mode="matched", offset_days=-1,
                                     keys=DEDUP_KEYS_2)


@query
def historic_identifiers_by_security(spark, sf_dir):
    """The flagship with each security's own latest earlier snapshot."""
    return plan.identifiers_historic(_src(spark, sf_dir), asof="security")


@query
def same_day_identifiers(spark, sf_dir):
    """Same-day snapshot, prefixed columns, equity/fund identifiers."""
    return plan.identifiers_same_day(_src(spark, sf_dir))


@query
def stage_counts_q(spark, sf_dir):
    """A3: row count of every stage of the flagship."""
    src = _src(spark, sf_dir)
    filtered = filter_allocations(src.allocations)
    ided = plan.allocations_with_ids(src)  # stored
    prev = materialize(previous_snapshot(ided, src.snapshot_dates), "previous")
    enriched = materialize(join_reference(join_snapshot(prev, src.securities), src.ref_equity,
                                          src.ref_fund).select(*ASKED), "enriched")
    sed, tick = sedol_requests(enriched), ticker_requests(enriched)
    resp = materialize(lookup_symbols(symbol_requests(enriched), src.symbology), "responses")
    return stage_counts({
        "allocations": src.allocations, "filtered": filtered, "deduplicated": ided,
        "previous_snapshot": prev, "enriched": enriched, "sedol_requests": sed,
        "ticker_requests": tick, "responses": resp, "result": attach_symbols(enriched, resp),
    })


@query
def duplicate_keys_q(spark, sf_dir):
    """D8 check: (order, line) is not unique in the allocations; the reference
    files are unique per (security, file date), but not per security."""
    src = _src(spark, sf_dir)
    return (duplicate_keys(src.allocations, ["order_id", "line_no"])
            .withColumn("source", F.lit("allocations"))
            .unionByName(duplicate_keys(src.ref_equity, ["sec_id", "file_eff_dt"])
                         .select(F.col("sec_id").cast("bigint").alias("order_id"),
                                 F.col("file_eff_dt").alias("line_no"), "rows")
                         .withColumn("source", F.lit("ref_equity")))
            .unionByName(duplicate_keys(src.ref_equity.unionByName(src.ref_fund), ["sec_id", "file_eff_dt"])
                         .select(F.col("sec_id").cast("bigint").alias("order_id"),
                                 F.col("file_eff_dt").alias("line_no"), "rows")
                         .withColumn("source", F.lit("both files")))
            .unionByName(duplicate_keys(src.ref_fund, ["sec_id"])
                         .select(F.col("sec_id").cast("bigint").alias("order_id"),
                                 F.lit(None).cast("int").alias("line_no"), "rows")
                         .withColumn("source", F.lit("ref_fund"))))


@query
def date_texts(spark, sf_dir):
    """DATE as yyyyMMdd text and timestamps as request-file text."""
    req = symbol_requests(_enriched(spark, sf_dir))
    return req.select("DATA_ID", "prefix", yyyymmdd_text(F.col("sym_date")).alias("sym_day"),
                      timestamp_text(F.col("order_start_date")).alias("start_text"),
                      timestamp_text(F.col("order_end_date")).alias("end_text"))


def _many_ranges(symbology):
    """The symbol table with each validity range cut into 30-day pieces."""
    start = F.explode(F.sequence("valid_from", "valid_to", F.expr("INTERVAL 30 DAY"))).alias("_s")
    return (symbology.select("*", start)
            .select("prefix", "symbol", "resolved", F.col("_s").alias("valid_from"),
                    F.least(F.date_add("_s", 29), "valid_to").alias("valid_to")))


@query
def lookup_symbols_many_ranges(spark, sf_dir):
    """J10 over a table with many validity rows per symbol: the month is part of the key."""
    src = _src(spark, sf_dir)
    return lookup_symbols(symbol_requests(_enriched(spark, sf_dir)), _many_ranges(src.symbology),
                          bucket="month")


@query
def join_reference_from_reordered_csv(spark, sf_dir):
    """Reference files whose columns stand in another order, found by their header."""
    src = _src(spark, sf_dir)
    files = []
    for name, df in (("equity", src.ref_equity), ("fund", src.ref_fund)):
        files.append(scratch_path(spark, f"{name}-reordered"))
        export_requests(df.select("isin_id", "file_eff_dt", "ticker", F.lit("x").alias("more"),
                                  "sec_id", "sedol_id", "parent_id_undr"), files[-1])
    prev = previous_snapshot(plan.allocations_with_ids(src), src.snapshot_dates)
    return join_reference(join_snapshot(prev, src.securities),
                          *[scan_csv(spark, f, schema=REFERENCE_SCHEMA) for f in files])


@query
def published_identifiers(spark, sf_dir):
    """The whole historic job with every stage published, read back from its table."""
    src, mark = _src(spark, sf_dir), scratch_path(spark, "t").rsplit("-", 1)[-1]
    prefix = f"idweave_stage_{mark}"
    plan.publish_identifiers(src, f"{prefix}_result", path=scratch_path(spark, "result"),
                             stage_prefix=prefix)
    for stage in ("allocations", "snapshot", "enriched", "sedol_requests", "ticker_requests", "responses"):
        spark.sql(f"DROP TABLE {prefix}_{stage}")
    return _read_and_forget(spark, f"{prefix}_result")


# ---- columns and sets ----------------------------------------------------

@query
def prefix_columns_q(spark, sf_dir):
    """Snapshot columns prefixed, the key left out."""
    return prefix_columns(fx.securities(spark, sf_dir), "snap_", drop=["sec_id"])


@query
def tag_q(spark, sf_dir):
    """Constant source and process-type columns."""
    return tag(_filtered(spark, sf_dir), source="O", process_type="historic")


@query
def normalize_dates_q(spark, sf_dir):
    """Dates from yyyyMMdd integers/text and from timestamps."""
    eq = fx.ref_equity(spark, sf_dir).withColumn("loaded", F.col("file_eff_dt").cast("string"))
    li = fx.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_shipdate").alias("shipped"))
    return (normalize_dates(eq, yyyymmdd_cols=["file_eff_dt", "loaded"]).select(
        "sec_id", "file_eff_dt", "loaded").withColumn("kind", F.lit("file"))
        .unionByName(normalize_dates(li, iso_cols=["shipped"]).select(
            F.col("order_id").cast("string").alias("sec_id"),
            F.col("shipped").alias("file_eff_dt"), F.lit(None).cast("date").alias("loaded"),
            F.lit("ship").alias("kind"))))


@query
def union_snapshots_q(spark, sf_dir):
    """U4: current and history snapshots unioned by name."""
    secs = fx.securities(spark, sf_dir)
    last = secs.agg(F.max("datadate")).scalar()
    current = secs.filter(F.col("datadate") == last)
    history = secs.filter(F.col("datadate") < last).drop("sec_currency")
    return union_snapshots(current, history)


# ---- sources and sinks ---------------------------------------------------

@query
def sql_relation_q(spark, sf_dir):
    """The snapshot join as SQL text over bound frames and :data_date."""
    src = _src(spark, sf_dir)
    prev = previous_snapshot(plan.allocations_with_ids(src), src.snapshot_dates)
    text = """
        SELECT a.DATA_ID, a.sec_id, a.trade_date_est, a.snapshot_date,
               s.ext_sec_id, s.sedol, s.ticker
        FROM {alloc} a
        LEFT JOIN (SELECT * FROM {sec} WHERE datadate <= :data_date) s
          ON CAST(a.sec_id AS STRING) = s.sec_id AND a.snapshot_date = s.datadate
        WHERE a.trade_date_est <= :data_date"""
    return sql_relation(spark, text, args={"data_date": datetime.date(1996, 6, 30)},
                        alloc=prev, sec=src.securities)


@query
def snapshot_dates_q(spark, sf_dir):
    """Snapshot dates from the partition listing of a published table."""
    secs = fx.securities(spark, sf_dir)
    name = "idweave_securities_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    publish(secs, name, partition_cols=["datadate"], path=scratch_path(spark, "securities"))
    out = materialize(snapshot_dates(spark, name), "dates")
    spark.sql(f"DROP TABLE {name}")
    return out


@query
def publish_q(spark, sf_dir):
    """K1-K3: a table published, then replaced by its own filtered rows, and read back."""
    name = "idweave_alloc_" + scratch_path(spark, "t").rsplit("-", 1)[-1]
    path = scratch_path(spark, "alloc")
    publish(fx.allocations(spark, sf_dir), name, path=path)
    publish(filter_allocations(spark.table(name)), name, path=path)
    return _read_and_forget(spark, name)


def _scratch_name(spark, what: str) -> str:
    return f"idweave_{what}_" + scratch_path(spark, "t").rsplit("-", 1)[-1]


def _stored_rows(spark, name):
    """The rows of a versioned table, stored before its versions go."""
    out = materialize(spark.table(name), "versioned")
    drop_versions(spark, name)
    return out


@query
def publish_versions(spark, sf_dir):
    """K1-K3 without a gap: a first version, a second that reads it, and a part appended to that."""
    name = _scratch_name(spark, "versioned")
    alloc = fx.allocations(spark, sf_dir)
    accepted = F.col("status") == "ACCT"
    publish_version(alloc, name, path=scratch_path(spark, "versioned"))
    publish_version(spark.table(name).where(accepted), name, partition_cols=["sec_typ_cd"],
                    path=scratch_path(spark, "versioned"))
    append_version(alloc.where(~accepted & (F.col("sec_typ_cd") == "COM")), name,
                   path=scratch_path(spark, "versioned"))
    return _stored_rows(spark, name)


@query
def assign_ids_across_runs(spark, sf_dir):
    """Ids from a registry: the allocations of the first years, then all; the first keep their ids."""
    src, name = _src(spark, sf_dir), _scratch_name(spark, "ids")
    first = replace(src, allocations=src.allocations.where("trade_date_local < DATE'1998-01-01'"))
    plan.allocations_with_ids(first, registry=name)
    out = materialize(plan.allocations_with_ids(src, registry=name), "registered")
    drop_versions(spark, name)
    return out


@query
def join_snapshot_partitioned(spark, sf_dir):
    """The security master stored by snapshot date, its dates from the listing; only the
    partitions that trades ask for are read."""
    src, name = _src(spark, sf_dir), _scratch_name(spark, "master")
    publish_version(src.securities, name, partition_cols=["datadate"], path=scratch_path(spark, "master"))
    alloc = plan.allocations_with_ids(src).where(F.year("trade_date_est") == 1996)
    prev = previous_snapshot(alloc, snapshot_dates(spark, name))
    out = materialize(join_snapshot(prev, spark.table(name)), "snapshot")
    drop_versions(spark, name)
    return out


@query
def published_versions_of_identifiers(spark, sf_dir):
    """C3 with K1-K3: the historic job twice, on a part of the trades and on all, as versions of
    one name and with ids from one registry."""
    src, name = _src(spark, sf_dir), _scratch_name(spark, "result")
    options = {"versioned": True, "registry": f"{name}_ids", "partition_cols": ("prefix",)}
    first = replace(src, allocations=src.allocations.where("trade_date_local < DATE'1998-01-01'"))
    plan.publish_identifiers(first, name, path=scratch_path(spark, "result"), **options)
    plan.publish_identifiers(src, name, path=scratch_path(spark, "result"), **options)
    drop_versions(spark, f"{name}_ids")
    return detach(spark, name)


def _flawed_lines(df):
    """Text lines of a reference file; some lack a field, others have a text in place of the date."""
    k = F.col("sec_id").cast("bigint")
    day = F.when(k % 50 == 1, F.lit("n/a")).otherwise(F.col("file_eff_dt").cast("string"))
    cells = [F.col("sec_id"), day, *(F.coalesce(c, F.lit("")) for c in ("parent_id_undr", "sedol_id", "ticker"))]
    last = F.when(k % 70 == 2, F.array().cast("array<string>")).otherwise(F.array(F.coalesce("isin_id", F.lit(""))))
    return F.array_join(F.concat(F.array(*cells), last), ",")


@query
def scan_csv_with_rejects(spark, sf_dir):
    """A reference file with bad lines: its good rows, typed, and its rejects with their reasons."""
    path, name = scratch_path(spark, "flawed-csv"), _scratch_name(spark, "rejects")
    header = ",".join(f.split()[0] for f in REFERENCE_SCHEMA.split(", "))
    equity = fx.ref_equity(spark, sf_dir)
    (equity.select(_flawed_lines(equity).alias(header)).write.option("header", True)
     .option("sep", "\u0001").option("quote", "\u0000").option("emptyValue", "").csv(path))
    scan = scan_csv_checked(spark, path, REFERENCE_SCHEMA, quarantine=name)
    bad = _stored_rows(spark, name) if scan.counts["rejects"] else scan.rejects
    good = scan.rows.columns
    return (scan.rows.withColumns({"line": F.lit(None).cast("string"), "reason": F.lit(None).cast("string")})
            .unionByName(bad.select(*(F.lit(None).cast(t).alias(c) for c, t in scan.rows.dtypes), "line", "reason"))
            .select(*good, "line", "reason"))


def _stand_in_service(first_run: bool):
    """Stands in for the external symbol service: it answers by rule, nothing for some symbols and twice for others, and
    in the first run it breaks down on some batches."""
    def service(pdf):
        import pandas as pd

        if first_run and int(pdf["DATA_ID"].iloc[0]) % 3 == 0:
            raise ConnectionError("the service is away")
        out = pd.DataFrame({"DATA_ID": pdf["DATA_ID"], "prefix": pdf["prefix"], "SYMBOL_NAME": pdf["SYMBOL_NAME"],
                            "resolved": pdf["prefix"].str[0] + pdf["SYMBOL_NAME"]})
        twice = out[out["DATA_ID"] % 5 == 0].assign(resolved=lambda x: x["resolved"] + "+")
        return pd.concat([out[out["DATA_ID"] % 7 != 0], twice])

    return service


@query
def lookup_symbols_resumed(spark, sf_dir):
    """Batches asked of a service that breaks down on the way; a second run asks for the rest."""
    requests = materialize(symbol_requests(_enriched(spark, sf_dir)), "requests")
    name, schema = _scratch_name(spark, "ledger"), "DATA_ID bigint, prefix string, SYMBOL_NAME string, resolved string"
    try:
        lookup_with_ledger(requests, _stand_in_service(True), schema, 500, name)
    except ServiceFailed:
        pass  # the batches that were answered are in the ledger
    out = materialize(lookup_with_ledger(requests, _stand_in_service(False), schema, 500, name), "responses")
    drop_versions(spark, name)
    return out


STEADY = ("ext_sec_id", "cusip", "isin_no", "sec_currency", "ticker")  # the fixture's sedol changes every quarter


@query
def compressed_snapshots(spark, sf_dir):
    """U4: the security master as validity ranges of the identifiers that stay."""
    src = _src(spark, sf_dir)
    return compress_snapshots(src.securities, snapshot_calendar(src.snapshot_dates), columns=STEADY)


@query
def expanded_snapshots(spark, sf_dir):
    """U4: the ranges of all identifiers, and the snapshots that come back from them."""
    src = _src(spark, sf_dir)
    calendar = snapshot_calendar(src.snapshot_dates)
    return expand_intervals(materialize(compress_snapshots(src.securities, calendar), "ranges"), calendar)


@query
def join_snapshot_intervals(spark, sf_dir):
    """J7 on the ranges: the identifiers of the previous snapshot."""
    src = _src(spark, sf_dir)
    ranges = materialize(compress_snapshots(src.securities, snapshot_calendar(src.snapshot_dates)), "ranges")
    prev = previous_snapshot(plan.allocations_with_ids(src), src.snapshot_dates)
    return join_intervals(prev, ranges, on="snapshot_date")


@query
def daily_identifiers(spark, sf_dir):
    """A full run over the inputs before 1998, then a daily run with all that came later."""
    src, name = _src(spark, sf_dir), _scratch_name(spark, "daily")
    path = scratch_path(spark, "daily")
    conditions = {"allocations": "trade_date_local < DATE'1998-01-01'", "snapshot_dates": "datadate < DATE'1998-01-01'",
                  "securities": "datadate < DATE'1998-01-01'", "ref_equity": "file_eff_dt < 19980101",
                  "ref_fund": "file_eff_dt < 19980101", "symbology": "valid_from < DATE'1996-01-01'"}
    publish_state(fx.Sources(*(getattr(src, n).where(c) for n, c in conditions.items())), name, path=path)
    changes = fx.Sources(*(getattr(src, n).where(f"NOT ({c})") for n, c in conditions.items()))
    publish_daily(src, changes, name, path=path)
    drop_versions(spark, f"{name}_ids")
    return detach(spark, name)


def _read_and_forget(spark, name):
    """The rows of a table whose files outlive its catalog entry."""
    path = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP TABLE {name}")  # its location was given, so the files stay
    return spark.read.parquet(path)


@query
def export_requests_q(spark, sf_dir):
    """Requests written as CSV and scanned back with their schema."""
    req = symbol_requests(_enriched(spark, sf_dir))
    path = scratch_path(spark, "requests-csv")
    export_requests(req, path)
    return scan_csv(spark, path, schema=req.schema)


@query
def export_request_batches_q(spark, sf_dir):
    """Requests written as one CSV folder per prefix and batch of 500, read back."""
    req = symbol_requests(_enriched(spark, sf_dir))
    path = scratch_path(spark, "request-batches")
    export_request_batches(req, path, 500)
    schema = req.schema.add("batch_no", T.LongType())
    return scan_csv(spark, path, schema=schema)


@query
def join_reference_from_csv(spark, sf_dir):
    """Equity and fund files delivered as CSV, read back with their schema."""
    src = _src(spark, sf_dir)
    files = {}
    for name, df in (("equity", src.ref_equity), ("fund", src.ref_fund)):
        files[name] = scratch_path(spark, f"{name}-csv")
        export_requests(df, files[name])
    prev = previous_snapshot(plan.allocations_with_ids(src), src.snapshot_dates)
    snap = join_snapshot(prev, src.securities, on="snapshot_date")
    return join_reference(snap, scan_csv(spark, files["equity"], schema=REFERENCE_SCHEMA),
                          scan_csv(spark, files["fund"], schema=REFERENCE_SCHEMA))


@query
def preview_q(spark, sf_dir):
    """K4/L1: the first 100 enriched rows by DATA_ID."""
    return preview(_enriched(spark, sf_dir), ["DATA_ID"], 100)


def queries() -> dict[str, Query]:
    out = {}
    for name, fn in QUERIES.items():
        out[name[:-2] if name.endswith("_q") else name] = fn
    return out


__all__ = ["queries", "QUERIES"]
