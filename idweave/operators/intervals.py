"""The security master as validity ranges instead of one row for each security and snapshot.

Most securities keep their identifiers from one snapshot to the next, so a daily master repeats the same row
hundreds of times. ``compress_snapshots`` keeps each stretch of consecutive snapshots with equal values once;
``expand_intervals`` gives the snapshots back, and ``join_intervals`` reads a snapshot date off the ranges
as ``join_snapshot`` reads it off the snapshots.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import SECURITY_COLUMNS
from ..session import materialize, task_count

RANGE = ("valid_from", "valid_to", "first_no", "last_no")


def snapshot_calendar(dates: DataFrame, col: str = "datadate") -> DataFrame:
    """Snapshot dates numbered from 1 in order: (``col``, ``no``). One row a DATE value, so bounded by the
    calendar; stored, so that the numbers stay."""
    days = dates.select(F.col(col).cast("date").alias(col)).where(F.col(col).isNotNull()).distinct()
    # numbered year by year, each year from the days of the years before it on
    year = F.year(col)
    in_year = Window.partitionBy("_y").orderBy(col)
    sizes = days.groupBy(year.alias("_y2")).agg(F.count(F.lit(1)).alias("_n"))
    before = (days.select(year.alias("_y")).distinct().join(F.broadcast(sizes), F.col("_y2") < F.col("_y"), "left")
              .groupBy("_y").agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_before")))
    return materialize(days.withColumn("_y", year).withColumn("_in", F.row_number().over(in_year))
                       .join(F.broadcast(before), "_y")
                       .select(col, (F.col("_before") + F.col("_in")).cast("int").alias("no")), "calendar")


def compress_snapshots(securities: DataFrame, calendar: DataFrame, key: str = "sec_id",
                       columns: Sequence[str] = SECURITY_COLUMNS) -> DataFrame:
    """(``key``, valid_from, valid_to, first_no, last_no, ``columns``): one row for each stretch of snapshots that follow
    each other in ``calendar`` in which the security has the same values, NULLs equal.

    A snapshot without the security ends its stretch, as does any changed value. If a security has several rows
    in a snapshot, all are kept, each in ranges of its own. Snapshots that the calendar lacks are left out. One shuffle, on the security: a security
    has at most a row for each snapshot date (times its copies), so no group is larger than the calendar. Equal values
    shrink so well in a shuffle that its bytes say little of a task's memory: partitions are made by the number of rows.
    """
    parts = max(task_count(securities.count()), int(securities.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    value = F.struct(*columns)
    rows = (securities.select(F.col(key), F.col("datadate").alias("_d"), *columns)
            .join(F.broadcast(calendar.select(F.col("datadate").alias("_d"), "no")), "_d")
            .repartition(parts, key)
            .withColumn("_copy", F.row_number().over(Window.partitionBy(key, "_d").orderBy(*columns))))
    line = Window.partitionBy(key, "_copy").orderBy("no")
    starts = (F.lag("no").over(line).isNull() | (F.lag("no").over(line) + 1 != F.col("no"))
              | ~F.lag(value).over(line).eqNullSafe(value))
    return (rows.withColumn("_start", starts.cast("int"))
            .withColumn("_stretch", F.sum("_start").over(line.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(key, "_copy", "_stretch")
            .agg(F.min("_d").alias("valid_from"), F.max("_d").alias("valid_to"), F.min("no").alias("first_no"),
                 F.max("no").alias("last_no"), F.first(value).alias("_v"))
            .select(key, *RANGE, *(F.col("_v").getField(c).alias(c) for c in columns)))


def expand_intervals(intervals: DataFrame, calendar: DataFrame, key: str = "sec_id",
                     columns: Sequence[str] = SECURITY_COLUMNS) -> DataFrame:
    """The snapshot rows that ``intervals`` were made of: (datadate, ``key``, ``columns``)."""
    each = intervals.select(key, *columns, F.explode(F.sequence("first_no", "last_no")).alias("no"))
    return each.join(F.broadcast(calendar), "no").select("datadate", key, *columns)


def join_intervals(alloc: DataFrame, intervals: DataFrame, on: str = "snapshot_date", key: str = "sec_id",
                   how: str = "left", columns: Sequence[str] = SECURITY_COLUMNS) -> DataFrame:
    """Join the values of the security on the snapshot date ``on``: the same rows as ``join_snapshot`` gives over
    the expanded snapshots, for dates that are snapshot dates.

    Each distinct (security, date) that is asked for meets the ranges of the security that touch the date's
    year: an equi-join on security and year with the range as residual, in which a hot security has
    at most a row for each day. The rows found join back by equality, and ``alloc`` is shuffled once.
    """
    asked = (alloc.select(F.col(key).cast("string").alias("_k"), F.col(on).alias("_d"))
             .where(F.col("_k").isNotNull() & F.col("_d").isNotNull()).distinct()
             .withColumn("_y", F.year("_d")))
    ranges = (intervals.select(F.col(key).cast("string").alias("_rk"), "valid_from", "valid_to", *columns)
              .withColumn("_ry", F.explode(F.sequence(F.year("valid_from"), F.year("valid_to")))))
    met = (asked["_k"] == ranges["_rk"]) & (asked["_y"] == ranges["_ry"])
    found = (asked.join(ranges, met & asked["_d"].between(ranges["valid_from"], ranges["valid_to"]))
             .select(F.col("_k").alias("_fk"), F.col("_d").alias("_fd"), *columns))
    left = alloc.withColumn("_ak", F.col(key).cast("string"))
    return (left.join(found, (left["_ak"] == found["_fk"]) & (left[on] == found["_fd"]), how)
            .drop("_ak", "_fk", "_fd"))
