"""Sources: CSV files, SQL text over frames, partition listings, local frames."""

from .files import CheckedScan, RejectedRows, scan_csv, scan_csv_checked
from .sql import from_local, snapshot_dates, sql_relation, sql_script

__all__ = ["scan_csv", "scan_csv_checked", "CheckedScan", "RejectedRows", "sql_relation", "sql_script", "snapshot_dates", "from_local"]
