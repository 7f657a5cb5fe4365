"""Summarise the physical plan of registered queries (static plan, AQE off).

Usage: python tools/plan_report.py [sf_dir] [name ...]
Prints, per query: exchanges by kind, join strategies, whole-stage codegen
spans and every Parquet scan with its pushed filters and read schema.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from idweave.queries import queries  # noqa: E402
from idweave.session import build_session  # noqa: E402

KINDS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
         "Exchange RoundRobinPartitioning", "BroadcastExchange", "SortMergeJoin",
         "BroadcastHashJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "Window", "WindowGroupLimit", "HashAggregate", "SortAggregate", "ObjectHashAggregate",
         "Generate", "TakeOrderedAndProject", "BatchEvalPython", "ArrowEvalPython",
         "FlatMapGroupsInPandas", "MapInPandas"]


def report(spark, sf_dir, name):
    df = queries()[name](spark, sf_dir)
    text = df._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    counts = Counter()
    for ln in lines:
        for k in KINDS:
            if re.search(r"(^|[\s:+-])" + re.escape(k) + r"\b", ln):
                counts[k] += 1
    codegen = len(set(re.findall(r"\*\((\d+)\)", text)))
    print(f"## {name}")
    print("operators: " + ", ".join(f"{k} x{v}" for k, v in counts.items() if v))
    print(f"whole-stage codegen stages: {codegen}")
    for ln in lines:
        if "FileScan parquet" in ln:
            tbl = re.search(r"Location: InMemoryFileIndex\(\d+ paths\)\[([^\]]*)\]", ln)
            pushed = re.search(r"PushedFilters: (.*?), ReadSchema", ln)
            schema = re.search(r"ReadSchema: (\S+)", ln)
            loc = tbl.group(1).rsplit("/", 1)[-1] if tbl else "?"
            loc = re.sub(r"-[0-9a-f]{32}$", "", loc)
            print(f"  scan {loc}: pushed {pushed.group(1) if pushed else '[]'} "
                  f"read {schema.group(1) if schema else '?'}")
    print()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or ["historic_identifiers", "same_day_identifiers", "previous_snapshot",
                             "previous_snapshot_by_key", "dedup_allocations", "batch_requests"]
    spark = build_session()
    spark.conf.set("spark.sql.maxPlanStringLength", str(10 ** 7))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    # static plan (AQE off) so whole-stage codegen spans are visible
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    for n in names:
        report(spark, sf_dir, n)


if __name__ == "__main__":
    main()
