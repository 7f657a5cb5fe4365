"""As-of lookups: the latest snapshot strictly before each trade date.

Neither plan compares allocations with snapshots row by row, and neither
forms (date, snapshot) pairs. The date-level plan reduces allocations to their
distinct trade dates first (at most one row per calendar day), solves the
as-of step on that small frame with a per-year window, and joins the answer
back by equality on the date. The per-security plan reduces to
distinct (security, date) pairs, so a hot security holds at most one row per
day in its window group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .skew import salted_join

# Size bounds. A frame of distinct DATE values can never exceed the number of
# days in years 1-9999 (3,652,059 rows, about 15 MB of dates), whatever the
# data volume; in practice it is the days of the trading history. A day map
# holds one row per distinct trade date; beyond MAX_BROADCAST_ROWS it is
# joined with a shuffle instead of broadcast.
MAX_BROADCAST_ROWS = 2_000_000


def _checked_broadcast(small: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Materialise ``small`` and broadcast it only if its row count is within bound."""
    small, rows = materialize(small, "daymap", count=True)
    return F.broadcast(small) if rows <= max_rows else small


def _day_map(trade_days: DataFrame, snaps: DataFrame, out: str, strict: bool) -> DataFrame:
    """``_t`` -> latest snapshot before (or on, if not strict) that day.

    Trade days and snapshot dates are unioned and ordered within each
    calendar year, trades before snapshots on a tie when strict, so a running
    ``last(snapshot, ignorenulls)`` is the answer inside the year. A day whose
    year has no earlier snapshot takes the latest snapshot of the earlier
    years. No (day, snapshot) pairs are formed: a window group is at most one
    year of days, and the carry-in joins years with earlier years only.
    """
    trade_side = 0 if strict else 2
    u = (trade_days.select(F.col("_t").alias("_d"), F.lit(trade_side).alias("_side"),
                           F.lit(None).cast("date").alias("_snap"))
         .unionByName(snaps.select(F.col("_s").alias("_d"), F.lit(1).alias("_side"),
                                   F.col("_s").alias("_snap")))
         .withColumn("_y", F.year("_d")))
    w = (Window.partitionBy("_y").orderBy("_d", "_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = (u.withColumn("_in", F.last("_snap", ignorenulls=True).over(w))
              .where(F.col("_side") == trade_side)
              .select(F.col("_d").alias("_t"), "_y", "_in"))
    year_last = snaps.groupBy(F.year("_s").alias("_sy")).agg(F.max("_s").alias("_ylast"))
    # the years of the trade days (not of the window output), so the carry-in
    # runs beside the window instead of after it
    carry = (trade_days.select(F.year("_t").alias("_y")).distinct()
             .join(F.broadcast(year_last), F.col("_sy") < F.col("_y"), "inner")
             .groupBy("_y").agg(F.max("_ylast").alias("_carry")))
    return (within.join(carry, "_y", "left")
            .select("_t", F.coalesce("_in", "_carry").alias(out))
            .where(F.col(out).isNotNull()))


def previous_snapshot(alloc: DataFrame, dates: DataFrame, date_col: str = "trade_date_est",
                      snap_col: str = "datadate", out: str = "snapshot_date",
                      how: str = "inner", strict: bool = True) -> DataFrame:
    """Add ``out`` = max snapshot date ``<`` (``<=`` if not strict) the trade date.

    ``how="inner"`` drops allocations that have no earlier snapshot (the
    reference behaviour); ``"left"`` keeps them with NULL.
    """
    trade_days = alloc.select(F.col(date_col).alias("_t")).where(F.col("_t").isNotNull()).distinct()
    snaps = dates.select(F.col(snap_col).alias("_s")).where(F.col("_s").isNotNull()).distinct()
    right = _checked_broadcast(_day_map(trade_days, snaps, out, strict))
    return alloc.join(right, alloc[date_col] == right["_t"], how).drop("_t")


def previous_snapshot_by_key(alloc: DataFrame, snaps: DataFrame, key: str = "sec_id",
                             date_col: str = "trade_date_est", snap_key: str = "sec_id",
                             snap_col: str = "datadate", out: str = "snapshot_date",
                             how: str = "inner", skew: str = "aqe") -> DataFrame:
    """Per security: the latest snapshot of *that security* strictly before the trade.

    Distinct (security, trade date) pairs and (security, snapshot date) pairs
    are unioned and ordered by date within each security, trades before
    snapshots on a tie, so ``last(snapshot, ignorenulls)`` is strictly earlier.
    """
    pairs = (alloc.select(F.col(key).cast("string").alias("_k"), F.col(date_col).alias("_d"))
             .where(F.col("_d").isNotNull()).distinct()
             .withColumn("_side", F.lit(0)).withColumn("_snap", F.lit(None).cast("date")))
    snap = (snaps.select(F.col(snap_key).cast("string").alias("_k"), F.col(snap_col).alias("_d"))
            .where(F.col("_d").isNotNull()).distinct()
            .withColumn("_side", F.lit(1)).withColumn("_snap", F.col("_d")))
    w = (Window.partitionBy("_k").orderBy("_d", "_side")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (pairs.unionByName(snap)
             .withColumn(out, F.last("_snap", ignorenulls=True).over(w))
             .where((F.col("_side") == 0) & F.col(out).isNotNull())
             .select("_k", "_d", out))
    left = alloc.withColumn("_k", F.col(key).cast("string"))
    if skew == "salt":
        found = found.withColumnRenamed("_k", "_fk")
        return salted_join(left, found, ["_k", date_col], ["_fk", "_d"], how).drop("_k", "_fk", "_d")
    if skew != "aqe":
        raise ValueError(f"unknown skew mode {skew!r}")
    return (left.join(found, (left["_k"] == found["_k"]) & (left[date_col] == found["_d"]), how)
            .drop("_k", "_d"))
