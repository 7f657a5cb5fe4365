"""File sources."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from ..versions import append_version

# No CSV field is ever this character, so only an unquoted empty field is NULL.
_NO_NULL_TEXT = "\u0000"


def scan_csv(spark: SparkSession, path: str, schema=None, null_value: str | None = None) -> DataFrame:
    """CSV with header, comma delimiter, ``"`` as quote and as escape.

    An unquoted empty field reads as NULL and a quoted one (``""``) as the
    empty string, so the two stay apart through a write/read round trip.
    Without a schema every column is text (no inference pass over the data).
    With one, columns are found by their header name, in any order, and cast; a
    value that does not fit its type reads as NULL, a column that the header
    lacks is an error, and columns the schema does not name are left out.
    """
    reader = _reader(spark, null_value)
    if schema is None:
        return reader.csv(path)
    fields = _fields(schema)
    text = reader.option("inferSchema", False).csv(path)
    _require(path, fields, text.columns)
    return text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields])


def _reader(spark: SparkSession, null_value: str | None):
    return (spark.read.option("header", True).option("delimiter", ",")
            .option("quote", '"').option("escape", '"')
            .option("emptyValue", "")
            .option("nullValue", _NO_NULL_TEXT if null_value is None else null_value))


def _fields(schema) -> list[T.StructField]:
    return (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields


def _require(path: str, fields: list[T.StructField], header: list[str]) -> None:
    missing = [f.name for f in fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: the header lacks {', '.join(missing)}")


class RejectedRows(ValueError):
    """A file has more bad lines than its reader allows."""


@dataclass
class CheckedScan:
    """The good rows of a file, its rejects (file, line, reason), and how many of each there are."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def scan_csv_checked(spark: SparkSession, path: str, schema, null_value: str | None = None,
                     quarantine: str | None = None, max_rejects: int | None = None) -> CheckedScan:
    """``scan_csv`` with a schema, for files that may be bad: no line is lost and none turns into NULLs in silence.

    A line with another number of fields than the header, or with a value that does not fit the type of its column,
    is a reject: its file, its text and the reason (every bad column with its value). Of a line with the
    right number of fields the text is that of its fields, quoted anew. An empty field is no bad value.
    All files must have the same header, in the same order. The files are parsed once: lines
    with their verdict are stored, and counted while they are written.

    ``quarantine`` names a versioned table (``versions.append_version``) that the rejects are appended to.
    With more than ``max_rejects`` rejects the scan raises ``RejectedRows``, after they are in quarantine.
    """
    fields = _fields(schema)
    header = _reader(spark, null_value).csv(path).columns
    _require(path, fields, header)
    whole, file = f"line of {uuid.uuid4().hex}", f"file of {uuid.uuid4().hex}"
    typed = T.StructType([T.StructField(c, T.StringType()) for c in header] + [T.StructField(whole, T.StringType())])
    text = (_reader(spark, null_value).schema(typed).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", whole).option("columnPruning", False)
            .option("enforceSchema", False).csv(path).withColumn(file, F.col("_metadata.file_path")))
    cast = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in fields}
    bad = [F.when(F.col(f"`{f.name}`").isNotNull() & (F.col(f"`{f.name}`") != "") & cast[f.name].isNull(), F.concat(
        F.lit(f"{f.name}: "), F.col(f"`{f.name}`"), F.lit(f" is no {f.dataType.simpleString()}")))
        for f in fields]
    reason = (F.when(F.col(f"`{whole}`").isNotNull(), F.lit(f"not the {len(header)} fields of the header"))
              .when(F.coalesce(*bad).isNotNull(), F.concat_ws("; ", *bad)))
    line = F.coalesce(F.col(f"`{whole}`"), F.to_csv(F.struct(*(F.col(f"`{c}`") for c in header)),
                                                   {"quote": '"', "escape": '"', "emptyValue": '""'}))
    judged = text.select(F.struct(*(c.alias(k) for k, c in cast.items())).alias("row"), F.col(f"`{file}`").alias("file"),
                         line.alias("line"), reason.alias("reason"))
    seen = Observation(f"rejects-{uuid.uuid4().hex}")
    judged = judged.select(F.when(F.col("reason").isNull(), F.col("row")).alias("row"), "reason",
                           *(F.when(F.col("reason").isNotNull(), F.col(c)).alias(c) for c in ("file", "line")))
    stored = materialize(judged.observe(seen, F.count("row").alias("rows"), F.count("reason").alias("rejects")), "checked")
    counts = {k: seen.get[k] for k in ("rows", "rejects")}
    rejects = stored.where("reason IS NOT NULL").select("file", "line", "reason")
    if quarantine and counts["rejects"]:
        append_version(rejects, quarantine)
    if max_rejects is not None and counts["rejects"] > max_rejects:
        some = "; ".join(f"{r.line!r} ({r.reason})" for r in rejects.limit(3).collect())
        raise RejectedRows(f"{path}: {counts['rejects']} bad lines, {max_rejects} allowed, for example {some}")
    return CheckedScan(stored.where("reason IS NULL").select("row.*"), rejects, counts)
