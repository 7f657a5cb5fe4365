"""Versions of a table behind one name, exchanged in one catalog step.

The name is a view, and every version is one or more tables of their own (the *parts*) that the view
reads. A new version is written beside the others; then the view's text is altered. A property of the view, named after
that text, is the manifest: number, parts and properties of the version, and the versions before it that
are still stored. So the pointer and the manifest change in the same step, and a reader meets the rows of
one version, whole, at any time. Versions that nobody needs are dropped after the step.

Tables that belong to a version without being its rows, such as what an incremental run needs to know of
the last one, are its *companions*: they are written with it, listed in its manifest and dropped with it,
so that all of them change in the one step (``companion`` reads them).

``publish_version`` replaces the rows. ``append_version`` adds a part to those of the version before and
rewrites nothing; when there are many parts of a level they are stored as one of the next level.
"""

from __future__ import annotations

import hashlib
import json
import logging
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from .session import compact, delete_folder, freed_shuffles

MANIFEST = "idweave.version"
MAX_PARTS = 16
READS = 10
log = logging.getLogger("idweave")


@dataclass(frozen=True)
class Version:
    """A version of a table: its number from 1, the tables that hold its rows, values its writer noted,
    the stored versions before it as (number, tables), its companions by name, and how often each part
    has been stored anew (its level)."""

    number: int
    parts: tuple[str, ...]
    properties: dict = field(default_factory=dict)
    before: tuple[tuple[int, tuple[str, ...]], ...] = ()
    companions: dict = field(default_factory=dict)
    levels: tuple[int, ...] = ()

    def text(self) -> str:
        return json.dumps({"number": self.number, "parts": self.parts, "properties": self.properties,
                           "before": self.before, "companions": self.companions, "levels": self.levels})

    def tables(self) -> tuple[str, ...]:
        """All tables of this version, not those of the versions before."""
        return (*self.parts, *self.companions.values())

    @staticmethod
    def parse(text: str) -> Version:
        d = json.loads(text)
        return Version(d["number"], tuple(d["parts"]), d["properties"],
                       tuple((n, tuple(parts)) for n, parts in d["before"]), d["companions"],
                       tuple(d.get("levels", ())))


class ConcurrentWrite(RuntimeError):
    """Another writer has moved the name to a version that this one has not seen."""


def current_version(spark: SparkSession, name: str) -> Version | None:
    """The version that ``name`` points to; None if there is none, or ``name`` is a plain table."""
    if not spark.catalog.tableExists(name):
        return None
    for _ in range(READS):  # the manifest of a text is dropped one commit after the next one
        key = _manifest_key(_view_text(spark, name))
        found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if key in found or MANIFEST in found:  # the plain key: a view that was made before texts had manifests of their own
            return Version.parse(found.get(key) or found[MANIFEST])
        if not any(k.startswith(MANIFEST) for k in found):
            return None
    raise ConcurrentWrite(f"{name} moves on faster than its manifest can be read")


def _view_text(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'View Text'").collect()
    return rows[0]["data_type"] if rows else ""


def _manifest_key(rows: str) -> str:
    return f"{MANIFEST}.{hashlib.sha256(rows.encode()).hexdigest()[:32]}"


def publish_version(df: DataFrame, name: str, partition_cols: Sequence[str] = (), path: str | None = None,
                    bucket_by: tuple | None = None, fmt: str = "parquet", keep: int = 1,
                    check: Callable[[], None] | None = None, properties: dict | None = None,
                    companions: dict[str, DataFrame] | None = None) -> Version:
    """Make the rows of ``df`` the next version of ``name``, and return it.

    Readers see the version before until all rows are written and the new one whole from then on.
    ``check`` is called between the two: if it raises, the new rows are dropped and the name stays as it
    was, as after any failed write. ``keep`` versions before the new one stay stored, so that
    readers who began with them can end; older ones are dropped after the step. ``df`` may read ``name``.
    With ``path`` each part is a folder of its own below it. A plain table of that name becomes
    version 0: the commit renames it once, which is the only moment without the name.
    """
    spark = df.sparkSession
    before = _found(spark, name)
    written, beside = [], {}
    try:
        for key, extra in (companions or {}).items():
            beside[key] = _write(extra, name, before.number + 1, (), path, None, fmt)
            written.append(beside[key])
        part = _write(df, name, before.number + 1, partition_cols, path, bucket_by, fmt)
    except Exception:
        _drop(spark, written)
        raise
    return _commit(spark, name, before, [part], [part, *written], keep, check, properties, beside)


def companion(spark: SparkSession, name: str, key: str) -> DataFrame:
    """The companion ``key`` of the current version of ``name``."""
    version = current_version(spark, name)
    if version is None or key not in version.companions:
        raise ValueError(f"{name} has no companion {key!r}")
    return spark.table(version.companions[key])


def append_version(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet", keep: int = 1,
                   check: Callable[[], None] | None = None, properties: dict | None = None,
                   max_parts: int = MAX_PARTS) -> Version:
    """Add the rows of ``df`` to those of ``name``: the next version has one part more.

    Rows that are there already are not read or written again, except that beyond ``max_parts`` parts of a level
    these and the new one are stored as one part of the next level. So a row is written once for each level, and many
    appends do not write all rows over and over. Columns are matched by name and must be the same. The rest
    is as in ``publish_version``.
    """
    spark = df.sparkSession
    before = _found(spark, name)
    levels = before.levels or (0,) * len(before.parts)  # from the oldest part on, never rising
    level, kept = 0, len(levels)
    while levels.count(level) >= max_parts:
        level, kept = level + 1, levels.index(level)
    if kept < len(levels):
        df = reduce(DataFrame.unionByName, [*(spark.table(p) for p in before.parts[kept:]), df])
    part = _write(df, name, before.number + 1, (), path, None, fmt)
    return _commit(spark, name, before, [*before.parts[:kept], part], [part], keep, check,
                   {**before.properties, **(properties or {})}, levels=(*levels[:kept], level))


def drop_before(spark: SparkSession, name: str) -> None:
    """Drop every version but the current one. Call it once no reader of them is left."""
    version = current_version(spark, name)
    if version and version.before:
        _point(spark, name, replace(version, before=()))
        _drop(spark, {p for _, tables in version.before for p in tables} - set(version.tables()))


def drop_versions(spark: SparkSession, name: str) -> None:
    """Drop the name with all its versions."""
    version = current_version(spark, name)
    if version:
        spark.sql(f"DROP VIEW {name}")
        _drop(spark, {*version.tables(), *(p for _, tables in version.before for p in tables)})


def detach(spark: SparkSession, name: str) -> DataFrame:
    """Drop the name with all its versions, but leave the files of the current rows, which are returned as a frame.

    Nothing is read or written. Every part must be Parquet in a folder of its own (``path``): files of other parts go with
    their tables. The folders are the caller's from then on.
    """
    version = current_version(spark, name)
    if version is None:
        raise ValueError(f"{name} has no versions")
    frames = []
    for part in version.parts:
        details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {part}").collect()}
        if details.get("Type") != "EXTERNAL" or details.get("Provider") != "parquet":
            raise ValueError(f"{part} is not Parquet in a folder of its own")
        frames.append(spark.read.schema(spark.table(part).schema).parquet(details["Location"]))
    out = reduce(DataFrame.unionByName, frames).select(*spark.table(name).columns)
    spark.sql(f"DROP VIEW {name}")
    for part in version.parts:
        spark.sql(f"DROP TABLE {part}")
    _drop(spark, {*version.tables(), *(p for _, tables in version.before for p in tables)} - set(version.parts))
    return out


def unlisted_parts(spark: SparkSession, name: str) -> list[str]:
    """Parts that no stored version lists: of a writer that is still writing, or that has died."""
    version = current_version(spark, name) or Version(0, ())
    listed = {p.rpartition(".")[2] for p in (*version.tables(), *(p for _, ts in version.before for p in ts))}
    db, _, own = name.rpartition(".")
    tables = spark.catalog.listTables(db) if db else spark.catalog.listTables()
    prefix = f"{own}__v".lower()
    return sorted(f"{db}.{t.name}" if db else t.name for t in tables
                  if not t.isTemporary and t.name.lower().startswith(prefix) and t.name.lower() not in
                  {x.lower() for x in listed})


def _found(spark: SparkSession, name: str) -> Version:
    """The current version; of a plain table version 0, whose part is the table itself until the commit renames it."""
    found = current_version(spark, name)
    if found is None:
        found = Version(0, (name,) if spark.catalog.tableExists(name) else ())
    return found


def _write(df: DataFrame, name: str, number: int, partition_cols, path, bucket_by, fmt) -> str:
    """Write one part; a failed write leaves nothing behind."""
    spark, part = df.sparkSession, f"{name}__v{number}_{uuid.uuid4().hex[:12]}"
    if partition_cols:
        df = df.hint("rebalance", *partition_cols)
    writer = compact(df.write.mode("errorifexists").format(fmt), spark, fmt)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    if bucket_by:
        n, *cols = bucket_by
        writer = writer.bucketBy(n, *cols).sortBy(*cols)
    folder = f"{path}/{part.rpartition('.')[2]}" if path else None
    if folder:
        writer = writer.option("path", folder)
    try:
        with freed_shuffles(spark):
            writer.saveAsTable(part)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {part}")
        db, _, own = part.rpartition(".")
        home = spark.catalog.getDatabase(db or spark.catalog.currentDatabase()).locationUri
        delete_folder(spark, folder or f"{home}/{own.lower()}")
        raise
    return part


def _commit(spark: SparkSession, name: str, before: Version, parts: list[str], written: list[str], keep: int,
            check: Callable[[], None] | None, properties: dict | None, companions: dict | None = None,
            levels: tuple[int, ...] = ()) -> Version:
    plain = name in before.parts
    moved = f"{name}__v0_{uuid.uuid4().hex[:12]}"
    if plain:
        before, parts = replace(before, parts=(moved,)), [moved if p == name else p for p in parts]
    stored = ((before.number, before.tables()), *before.before) if before.parts else ()
    new = Version(before.number + 1, tuple(parts), properties or {}, stored[:keep], companions or {}, levels)
    try:
        if check is not None:
            check()
        seen = current_version(spark, name)
        if (seen.number if seen else 0) != before.number:
            raise ConcurrentWrite(f"{name} is at version {seen.number if seen else 0}, not {before.number}")
        if plain:
            spark.sql(f"ALTER TABLE {name} RENAME TO {moved}")
        try:
            _point(spark, name, new)
        except Exception:
            if plain:
                spark.sql(f"ALTER TABLE {moved} RENAME TO {name}")
            raise
    except Exception:
        _drop(spark, written)
        raise
    needed = {*new.tables(), *(p for _, ps in new.before for p in ps)}
    _drop(spark, {p for _, ps in stored for p in ps} - needed)
    log.info("%s is at version %d: %s", name, new.number, ", ".join(parts))
    return new


def _point(spark: SparkSession, name: str, version: Version) -> None:
    """The one catalog step: the view's text. The manifest of a text is a property named after that text, noted before the
    step, so both change with it. ``CREATE OR REPLACE VIEW`` would drop the name and make it anew."""
    columns = ", ".join(f"`{c}`" for c in spark.table(version.parts[0]).columns)
    rows = " UNION ALL ".join(f"SELECT {columns} FROM {p}" for p in version.parts)
    text = version.text().replace("\\", "\\\\").replace("'", "\\'")
    key = _manifest_key(rows)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE VIEW {name} TBLPROPERTIES ('{key}' = '{text}') AS {rows}")
        return
    before = _view_text(spark, name)
    spark.sql(f"ALTER VIEW {name} SET TBLPROPERTIES ('{key}' = '{text}')")
    if rows != before:
        spark.sql(f"ALTER VIEW {name} AS {rows}")
    # of the texts before, the last keeps its manifest for those who are just reading it
    old = [r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
           if r["key"].startswith(MANIFEST) and r["key"] not in (key, _manifest_key(before))]
    if old:
        spark.sql(f"ALTER VIEW {name} UNSET TBLPROPERTIES IF EXISTS ({', '.join(repr(k) for k in old)})")


def _drop(spark: SparkSession, parts) -> None:
    """Drop tables and, where they lie in a folder of their own choice, that folder."""
    for part in parts:
        details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {part}").collect()}
        spark.sql(f"DROP TABLE {part}")
        if details.get("Type") == "EXTERNAL" and details.get("Location"):
            delete_folder(spark, details["Location"])
