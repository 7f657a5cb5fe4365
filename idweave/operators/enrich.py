"""Snapshot and reference-file enrichment, and the missing-identifier audit."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import SECURITY_COLUMNS, UNDERLYING_COLUMNS
from ..functions.dates import date_from_yyyymmdd
from .skew import salted_join

LAST_DATE = datetime.date(9999, 12, 31)
FILE_DATES = ("equity_file_eff_dt", "fund_file_eff_dt")


def join_snapshot(alloc: DataFrame, securities: DataFrame, on: str = "snapshot_date",
                  key: str = "sec_id", how: str = "left",
                  columns: Sequence[str] = SECURITY_COLUMNS, skew: str = "aqe",
                  prune: bool = True) -> DataFrame:
    """Left-join the snapshot row of the security on the chosen date.

    The allocation key is cast to text to meet the snapshot's text key. An
    equi-join on (security, date): sort-merge at scale; a hot key is split by
    AQE, or with ``skew="salt"`` by salting. NULL keys never match and keep
    their row.

    With ``prune`` the security master is first semi-joined with the distinct
    dates the allocations ask for, which are broadcast (only DATE values, so their
    number is bounded by the calendar). Snapshots no trade uses are dropped before
    the shuffle, and of a master that is stored partitioned by date their files are not read: the
    broadcast dates become a partition filter at run time. The
    dates are read in a pass of their own: prune where ``alloc`` is stored.
    """
    sec = securities.select(F.col("sec_id").alias("_sk"), F.col("datadate").alias("_sd"),
                            *columns)
    if prune and dict(alloc.dtypes)[on] == "date":
        # Spark prunes partitions by the other side of a join only if that side is filtered by a comparison;
        # this one holds for every date
        needed = (alloc.select(F.col(on).alias("_need"))
                  .where(F.col("_need").isNotNull() & (F.col("_need") <= F.lit(LAST_DATE))).distinct())
        sec = sec.join(F.broadcast(needed), sec["_sd"] == needed["_need"], "left_semi")
    left = alloc.withColumn("_ak", F.col(key).cast("string"))
    if skew == "salt":
        joined = salted_join(left, sec, ["_ak", on], ["_sk", "_sd"], how)
    elif skew == "aqe":
        joined = left.join(sec, (left["_ak"] == sec["_sk"]) & (left[on] == sec["_sd"]), how)
    else:
        raise ValueError(f"unknown skew mode {skew!r}")
    return joined.drop("_ak", "_sk", "_sd")


def _prepare_reference(ref: DataFrame, tag: str, offset_days: int, date_col: str) -> DataFrame:
    eff = date_from_yyyymmdd(F.col("file_eff_dt"))
    return ref.select(
        F.col("sec_id").cast("string").alias("_k"),
        F.date_sub(eff, offset_days).alias(date_col),
        F.col("file_eff_dt").alias(f"{tag}_file_eff_dt"),
        *[F.col(src).alias(f"_{tag}_{src}") for src, _ in UNDERLYING_COLUMNS],
    )


def join_reference(df: DataFrame, equity: DataFrame, fund: DataFrame, offset_days: int = 1,
                   key: str = "sec_id", date_col: str = "trade_date_est",
                   skew: str = "aqe", prune: bool | str = True, key_rows: str | None = None,
                   days: bool = True) -> DataFrame:
    """Left-join the equity and fund files where file date - offset = trade date.

    The two files are first joined with each other (full outer, on security and
    date) and their four underlying identifiers merged, the equity value
    before the fund value. ``df`` is then joined once, so it is shuffled once and a
    hot (security, date) key of it is split by AQE, or salted with ``skew="salt"``.
    Each file is expected to hold one row per (security, file date); with ``key_rows`` a column of that name
    has how many the fuller of the files holds for the row's key (NULL: none), so that a job can
    observe it while the join runs. It is counted by a window over the partitioning that the join of the files
    needs anyway. With ``prune``
    each file is first semi-joined with the broadcast distinct trade dates of ``df``
    (only if they are DATE values, so that their number is bounded by the calendar);
    use it where ``df`` is stored, since its dates are read in a pass of their own.

    ``prune="keys"`` also cuts the files to the distinct (security, date) keys of ``df``, which the two files then join
    one after the other instead of each other: of the files' rows only those that some row of ``df`` meets are
    shuffled to ``df``. The rows are the same. The keys are read in a pass of their own too. With ``days=False``
    the columns that ``with_file_days`` adds are left to the caller, who can add them after later shuffles.
    """
    if prune not in (True, False, "keys"):
        raise ValueError(f"unknown prune mode {prune!r}")
    eq = _prepare_reference(equity, "equity", offset_days, date_col)
    fu = _prepare_reference(fund, "fund", offset_days, date_col)
    if prune and dict(df.dtypes)[date_col] == "date":
        needed = F.broadcast(df.select(date_col).where(F.col(date_col).isNotNull()).distinct())
        eq = eq.join(needed, date_col, "left_semi")
        fu = fu.join(needed, date_col, "left_semi")
    count = ()
    if key_rows:
        per_key = Window.partitionBy("_k", date_col)
        eq = eq.withColumn("_equity_rows", F.count(F.lit(1)).over(per_key))
        fu = fu.withColumn("_fund_rows", F.count(F.lit(1)).over(per_key))
        count = (F.greatest("_equity_rows", "_fund_rows").alias(key_rows),)
    merged = {dst: F.coalesce(F.col(f"_equity_{src}"), F.col(f"_fund_{src}"))
              for src, dst in UNDERLYING_COLUMNS}
    found = [*[c.alias(dst) for dst, c in merged.items()], *FILE_DATES, *count]
    if prune == "keys":
        asked = (df.select(F.col(key).cast("string").alias("_ak"), F.col(date_col).alias("_ad"))
                 .where(F.col("_ak").isNotNull() & F.col("_ad").isNotNull()).distinct())
        both = asked
        for side, k, d in ((eq, "_ek", "_ed"), (fu, "_fk", "_fd")):
            side = side.withColumnsRenamed({"_k": k, date_col: d})
            both = both.join(side, (F.col("_ak") == F.col(k)) & (F.col("_ad") == F.col(d)), "left")
        ref = (both.where(F.col("_ek").isNotNull() | F.col("_fk").isNotNull())
               .select(F.coalesce("_ek", "_fk").alias("_rk"), F.coalesce("_ed", "_fd").alias("_rd"), *found))
    else:
        ref = (eq.join(fu, ["_k", date_col], "full")
               .select(F.col("_k").alias("_rk"), F.col(date_col).alias("_rd"), *found))
    keyed = df.withColumn("_k", F.col(key).cast("string"))
    if skew == "salt":
        out = salted_join(keyed, ref, ["_k", date_col], ["_rk", "_rd"], "left")
    elif skew == "aqe":
        out = keyed.join(ref, (keyed["_k"] == ref["_rk"]) & (keyed[date_col] == ref["_rd"]), "left")
    else:
        raise ValueError(f"unknown skew mode {skew!r}")
    out = out.select(*df.columns, *merged, *FILE_DATES, *([key_rows] if key_rows else []))
    return with_file_days(out, date_col) if days else out


def with_file_days(df: DataFrame, date_col: str = "trade_date_est") -> DataFrame:
    """Add after each file's date its file date - offset, ``<file date>_minus1``, as ``join_reference`` returns it.

    A file's row that has met a row of ``df`` has that row's date as its file date - offset, so no shuffle need carry it.
    """
    cols = []
    for c in df.columns:
        cols.append(F.col(c))
        if c in FILE_DATES:
            cols.append(F.when(F.col(c).isNotNull(), F.col(date_col).cast("date")).alias(f"{c}_minus1"))
    return df.select(*cols)


def audit_missing(df: DataFrame, cols: Sequence[str], mode: str = "all") -> DataFrame:
    """Rows where all (``mode="all"``) or any (``"any"``) of ``cols`` are NULL."""
    tests = [F.col(c).isNull() for c in cols]
    if mode == "all":
        cond = tests[0]
        for t in tests[1:]:
            cond = cond & t
    elif mode == "any":
        cond = tests[0]
        for t in tests[1:]:
            cond = cond | t
    else:
        raise ValueError(f"unknown audit mode {mode!r}")
    return df.filter(cond)
