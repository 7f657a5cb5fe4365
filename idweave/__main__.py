"""Command-line jobs.

    python -m idweave historic --process-type historic --allocations A --securities S \\
        --equity E --fund F --symbology Y --output T [--snapshot-dates D]
        [--ticker-mode matched] [--offset-days -1] [--dedup-keys 2]
    python -m idweave same-day --allocations A --securities S --equity E --fund F --output T
    python -m idweave partitions --table S

Each input is a catalog table name, a Parquet path (anything containing a
``/``), a CSV path (``csv:PATH``, or ending in ``.csv``; equity and fund files are read by the
names in their header) or a file of SQL text (``sql:PATH``, or ending in ``.sql``). Without ``--snapshot-dates`` the snapshot dates come from the
partition listing of the ``--securities`` catalog table.
"""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import DataFrame, SparkSession

from .constants import DEDUP_KEYS_2, DEDUP_KEYS_3, REFERENCE_SCHEMA
from .plans import Sources, publish_identifiers, publish_same_day
from .sources import scan_csv, snapshot_dates, sql_script


def _read(spark: SparkSession, ref: str | None, schema: str | None = None) -> DataFrame | None:
    if ref is None:
        return None
    if ref.startswith("csv:") or ref.endswith(".csv"):
        return scan_csv(spark, ref.removeprefix("csv:"), schema)
    if ref.startswith("sql:") or ref.endswith(".sql"):
        return sql_script(spark, ref.removeprefix("sql:"))
    return spark.read.parquet(ref) if "/" in ref else spark.table(ref)


def _cols(text: str) -> tuple:
    return tuple(c.strip() for c in text.split(",") if c.strip())


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="idweave")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("historic", "same-day"):
        j = sub.add_parser(name)
        j.add_argument("--allocations", required=True)
        j.add_argument("--securities", required=True)
        j.add_argument("--equity", required=True)
        j.add_argument("--fund", required=True)
        j.add_argument("--output", required=True, help="catalog table to replace")
        j.add_argument("--output-path")
        j.add_argument("--offset-days", type=int, default=1)
        j.add_argument("--partition-by", default="", help="comma-separated output partition columns")
        j.add_argument("--audit-dir", help="folder for the missing-identifier and preview CSVs")
        j.add_argument("--preview-rows", type=int, default=100)
        j.add_argument("--format", default="parquet", help="file or table format of the output")
        j.add_argument("--versioned", action="store_true",
                       help="publish the output as the next version behind its name, without a gap for readers")
        j.add_argument("--on-duplicates", default="fail", choices=["fail", "audit"],
                       help="a reference file with several rows of a trade's key: stop (default) or go on")
    h = sub.choices["historic"]
    h.add_argument("--id-registry", help="table of the ids given so far; new allocations are appended to it")
    h.add_argument("--process-type", default="historic")
    h.add_argument("--symbology", required=True)
    h.add_argument("--snapshot-dates")
    h.add_argument("--ticker-mode", default="always", choices=["always", "matched"])
    h.add_argument("--dedup-keys", type=int, default=3, choices=[2, 3])
    h.add_argument("--stage-prefix", help="publish every stage as a table of this prefix")
    h.add_argument("--asof", default="table", choices=["table", "security"],
                   help="latest snapshot of the table (default) or of each security")
    h.add_argument("--skew", default="aqe", choices=["aqe", "salt"],
                   help="hot keys: split by AQE (default) or salted (clusters without AQE)")
    part = sub.add_parser("partitions")
    part.add_argument("--table", required=True)
    return p.parse_args(argv)


def main(argv=None, spark: SparkSession | None = None):
    args = parse_args(argv)
    if args.job == "historic" and args.process_type == "daily":
        return None  # the daily run has nothing to do
    if args.job == "historic" and args.process_type != "historic":
        raise ValueError(f"invalid process type: {args.process_type!r}")
    spark = spark or SparkSession.builder.appName("idweave").getOrCreate()
    if args.job == "partitions":
        return [str(r[0]) for r in snapshot_dates(spark, args.table).orderBy(1).collect()]
    dates = (_read(spark, args.snapshot_dates) if getattr(args, "snapshot_dates", None)
             else snapshot_dates(spark, args.securities) if args.job == "historic" else None)
    src = Sources(_read(spark, args.allocations), dates, _read(spark, args.securities),
                  _read(spark, args.equity, REFERENCE_SCHEMA),
                  _read(spark, args.fund, REFERENCE_SCHEMA),
                  _read(spark, getattr(args, "symbology", None)))
    if args.job == "same-day":
        counts = publish_same_day(src, args.output, path=args.output_path,
                                  offset_days=args.offset_days, audit_dir=args.audit_dir,
                                  partition_cols=_cols(args.partition_by),
                                  preview_rows=args.preview_rows, fmt=args.format,
                                  versioned=args.versioned, on_duplicates=args.on_duplicates)
        return {"published": args.output, **counts}
    keys = DEDUP_KEYS_3 if args.dedup_keys == 3 else DEDUP_KEYS_2
    return publish_identifiers(src, args.output, path=args.output_path,
                               ticker_mode=args.ticker_mode, offset_days=args.offset_days,
                               keys=keys, audit_dir=args.audit_dir, asof=args.asof,
                               skew=args.skew, partition_cols=_cols(args.partition_by),
                               stage_prefix=args.stage_prefix, preview_rows=args.preview_rows,
                               fmt=args.format, versioned=args.versioned, registry=args.id_registry,
                               on_duplicates=args.on_duplicates)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    print(json.dumps(main()))
