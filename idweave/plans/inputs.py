"""The inputs of an identifier job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame


@dataclass
class Sources:
    """The six inputs: allocations, the snapshot dates of the security master,
    the security master itself, the equity and fund reference files, and the
    dated symbol table. Each is any DataFrame (catalog table, Parquet, CSV)."""

    allocations: DataFrame
    snapshot_dates: DataFrame
    securities: DataFrame
    ref_equity: DataFrame
    ref_fund: DataFrame
    symbology: DataFrame
