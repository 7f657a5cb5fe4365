"""SQL-text relations and catalog listings."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DEFAULT_SNAPSHOT_DATE
from ..versions import current_version


def sql_relation(spark: SparkSession, text: str, args: dict | None = None,
                 **frames: DataFrame) -> DataFrame:
    """Run SQL text. Frames are bound as ``{name}`` references (no global views)
    and values as named parameters (``:data_date``), never by string formatting.
    A text that names ``:data_date`` without a value for it gets the default date."""
    if ":data_date" in text and "data_date" not in (args or {}):
        args = {**(args or {}), "data_date": datetime.date.fromisoformat(DEFAULT_SNAPSHOT_DATE)}
    return spark.sql(text, args=args, **frames)


def sql_script(spark: SparkSession, path: str, args: dict | None = None,
               **frames: DataFrame) -> DataFrame:
    """``sql_relation`` over SQL text kept in a file (any Spark-readable path)."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return sql_relation(spark, text, args=args, **frames)


def snapshot_dates(spark: SparkSession, table: str, column: str = "datadate") -> DataFrame:
    """Snapshot dates of a partitioned catalog table, from its partition listing.

    Reads metadata only. Values may be ISO dates or ``yyyyMMdd``. A versioned name
    (``idweave.versions``) gives the partitions of its current version.
    """
    version = current_version(spark, table)
    raw = None
    for part in version.parts if version else (table,):
        listed = spark.sql(f"SHOW PARTITIONS {part}")
        listed = listed.withColumnRenamed(listed.columns[0], "partition")
        raw = listed if raw is None else raw.unionByName(listed)
    value = F.regexp_extract(F.col("partition"), f"(^|/){column}=([^/]*)", 2)
    return raw.select(
        F.coalesce(F.try_to_date(value, "yyyy-MM-dd"),
                   F.try_to_date(value, "yyyyMMdd")).alias(column)).distinct()


def from_local(spark: SparkSession, pdf, schema) -> DataFrame:
    """A small local pandas frame as a DataFrame (Arrow transfer, explicit schema)."""
    return spark.createDataFrame(pdf, schema=schema)
