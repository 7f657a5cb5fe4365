"""Column-level helpers: dates, column naming, local tickers."""

from .columns import prefix_columns, tag
from .dates import (date_from_text, date_from_yyyymmdd, day_end, day_start,
                    normalize_dates, timestamp_text, yyyymmdd_text)
from .tickers import local_ticker

__all__ = ["prefix_columns", "tag", "date_from_text", "date_from_yyyymmdd", "day_end",
           "day_start", "normalize_dates", "timestamp_text", "yyyymmdd_text", "local_ticker"]
