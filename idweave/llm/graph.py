"""Connected components of an edge list by alternating star contraction.

Every step is a join and an aggregation; each round is written to the shared
checkpoint folder, so a lost executor re-reads files and no lineage grows. A hub
never gathers its neighbours: only their minimum is aggregated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a long, b long) -> (node, root): root is the smallest node of the
    component, for every node of an edge between different nodes that is not its own
    root. Nulls and self-links are ignored; no edges give no rows."""
    # stored before the first round too, which reads the edges many times over: else their whole plan is in it as often
    edges = materialize(edges.select("a", "b").dropna().where("a <> b"), "links")
    before = None
    for _ in range(max_rounds):
        both = (edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
                .unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))))
        # large star: every larger neighbour hangs on the smallest one
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        # small star: smaller neighbours and the node hang on the smallest one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        edges = materialize(small, "components")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
