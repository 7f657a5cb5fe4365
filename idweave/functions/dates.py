"""Date conversions. ANSI mode is on: malformed input becomes NULL, never an error."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DAY_END, DAY_START


def date_from_text(c: Column) -> Column:
    """Date from the first ten characters of a date/timestamp-like value."""
    return F.try_to_date(F.substring(c.cast("string"), 1, 10), "yyyy-MM-dd")


def date_from_yyyymmdd(c: Column) -> Column:
    """Date from an integer or text ``yyyyMMdd`` (20240103 -> 2024-01-03)."""
    return F.try_to_date(c.cast("string"), "yyyyMMdd")


def yyyymmdd_text(c: Column) -> Column:
    """``yyyyMMdd`` text of a DATE."""
    return F.date_format(c, "yyyyMMdd")


def timestamp_text(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a timestamp (as request files carry it)."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _at(c: Column, hhmm: str) -> Column:
    h, m = (int(x) for x in hhmm.split(":"))
    return c.cast("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(h), F.lit(m))


def day_start(c: Column) -> Column:
    """Timestamp (no zone) at the start of the day; NULL stays NULL."""
    return _at(c, DAY_START)


def day_end(c: Column) -> Column:
    """Timestamp (no zone) at 23:59 of the day; NULL stays NULL."""
    return _at(c, DAY_END)


def normalize_dates(df: DataFrame, iso_cols: Iterable[str] = (),
                    yyyymmdd_cols: Iterable[str] = ()) -> DataFrame:
    """Replace timestamp/text columns by DATE and ``yyyyMMdd`` integers by DATE."""
    repl = {c: date_from_text(F.col(c)) for c in iso_cols}
    repl.update({c: date_from_yyyymmdd(F.col(c)) for c in yyyymmdd_cols})
    return df.withColumns(repl) if repl else df
