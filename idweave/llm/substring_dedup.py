"""Removal of long repeated byte strings by prefix-free parsing.

A byte goes if a ``length``-byte string covers it that starts anywhere else too.

1. *Parse.* A rolling hash of 16 bytes triggers phrases: every window of
   ``length`` bytes belongs to the trigger whose hash is least in its first ``REACH`` bytes. That
   choice depends on the window's bytes alone, so equal windows have the same
   trigger at the same place. A phrase is a trigger with the windows it owns.
2. *Dictionary.* All windows of a trigger share the ``core`` bytes behind it. A phrase whose
   core occurs once in the corpus has no repeated window. Only phrases with a repeated core
   stay, each as its extended text: from the start of its first window to the end of its last.
3. *Equal phrases.* Extended texts that occur twice are repeated as a whole, so
   of highly repetitive text each distinct phrase is looked at once.
4. *Corpus order.* The other phrases are compared with the distinct phrases of their core: the suffixes of
   these dictionary entries that start a window are sorted (a suffix array of the
   group, in the order of the corpus, as an extended text holds what the parse puts behind
   the phrase), and neighbours that agree in ``length`` bytes are repeated.
   A core with more than ``GROUP`` distinct phrases is dealt out anew: its phrases are split
   into parts of ``PART`` windows, which go through steps 2 to 4 with their longer cores. Groups
   still too large are resolved window by window, by counting window digests, so
   that no group has to fit a task.
5. The ranges found are merged per document and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import id_text, join_counted, materialize, worker_table

LENGTH = 200
GRAM = 16
BLOCK = 1 << 18     # window starts parsed at a time
GROUP = 2000        # distinct phrases of a core sorted together
PART = 16           # windows of a part of a phrase whose core is too common
ROWS = 128          # rows of a batch turned into Python objects at a time
_MASK = np.uint64((1 << 20) - 1)
_MULT = np.uint64(0x9E3779B97F4A7C15)


# ---- parse ----------------------------------------------------------------

def reach_of(length: int) -> int:
    """First bytes of a window among which its trigger is chosen."""
    return max(1, min(112, (length - GRAM + 1) * 3 // 5))


def _triggers(block: bytes, length: int) -> np.ndarray:
    """The trigger of every window of ``block``, as a place in the block."""
    h = np.frombuffer(block, np.uint8).astype(np.uint64) + np.uint64(1)
    h *= _MULT
    h ^= h >> np.uint64(29)
    mult = _MULT
    for step in (1, 2, 4, 8):  # hash of 2, 4, 8, 16 bytes
        h = h[:-step] * mult + h[step:]
        with np.errstate(over="ignore"):
            mult = mult * mult
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h = (h & ~_MASK) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the first place
    reach, size = reach_of(length), 1
    while size * 2 <= reach:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    if size < reach:
        h = np.minimum(h[:size - reach], h[reach - size:])
    return (h[:len(block) - length + 1] & _MASK).astype(np.int64)


def phrases(raw: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(trigger, first window, last window) of every phrase of a text."""
    n = len(raw) - length + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    parts = []
    for b in range(0, n, BLOCK):
        stop = min(n, b + BLOCK)
        parts.append(_triggers(raw[b:stop + length - 1], length) + b)
    at = np.concatenate(parts)
    new = np.flatnonzero(np.diff(at, prepend=-1))
    return at[new], new, np.append(new[1:], n) - 1


def _digest(seed: int = 0):
    import xxhash

    one = xxhash.xxh3_64_intdigest
    return lambda x: one(x, seed)


def _cores(raw: bytes, at: list[int], length: int) -> list[int]:
    size, digest = length - reach_of(length) + 1, _digest()
    return [digest(raw[t:t + size]) for t in at]


def _signed(x) -> np.ndarray:
    return np.array(x, np.uint64).view(np.int64)


# a phrase's place in one number: trigger, and how far before it its windows start
def _pack(t, first, last):
    return t << 16 | (t - first) << 8 | (t - last)


def _unpack(loc):
    t = loc >> 16
    return t, t - ((loc >> 8) & 255), t - (loc & 255)


def _parse(docs: DataFrame, length: int, places: bool) -> DataFrame:
    """(core) or (core, key, loc) of every phrase."""
    def run(batches):
        worker_table("substring_dedup")
        for batch in batches:
            keys = batch.column("key").to_pylist() if places else None
            for lo in range(0, batch.num_rows, 512):
                cores, own, locs = [], [], []
                for k, text in enumerate(batch.column("text").slice(lo, 512).to_pylist()):
                    raw = text.encode("utf-8", "surrogatepass")
                    t, first, last = phrases(raw, length)
                    cores += _cores(raw, t.tolist(), length)
                    if places:
                        own += [keys[lo + k]] * len(t)
                        locs.append(_pack(t, first, last))
                cols = {"core": pa.array(_signed(cores))}
                if places:
                    cols |= {"key": pa.array(own, pa.int64()),
                             "loc": pa.array(np.concatenate(locs) if locs else [], pa.int64())}
                yield pa.RecordBatch.from_pydict(cols)

    if places:
        return docs.select("key", "text").mapInArrow(run, "core long, key long, loc long")
    return docs.select("text").mapInArrow(run, "core long")


def _slices(batches):
    """The rows of Arrow batches, ``ROWS`` at a time: their Python objects take many times the memory of the batch."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            yield batch.slice(lo, ROWS)


def _members(lists: pa.ListArray, *fields: str) -> Iterator[tuple[np.ndarray, ...]]:
    """Per row of a list of structs, the values of ``fields`` (null lists: none) without an object for each."""
    flat, ends = lists.flatten(), np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    columns = [flat.field(f).to_numpy(zero_copy_only=False) for f in fields]
    for lo, hi in zip(np.concatenate([[0], ends]), ends):
        yield tuple(c[lo:hi] for c in columns)


# ---- dictionary -----------------------------------------------------------

def _extended(stored: DataFrame, length: int) -> DataFrame:
    """(core, phrase, key, loc) of the phrases with a repeated core; ``phrase`` digests the
    extended text and where its windows lie."""
    def run(batches):
        worker_table("substring_dedup")
        for batch in _slices(batches):
            cores, found, keys, locs = [], [], [], []
            for key, text, (marked, own) in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(),
                                                _members(batch.column("marks"), "core", "loc")):
                raw = text.encode("utf-8", "surrogatepass")
                # marks of another text with the same key would not fit
                core = _signed(_cores(raw, (own >> 16).tolist(), length))
                fits = core == marked
                for loc, c in zip(own[fits].tolist(), core[fits].tolist()):
                    _, first, last = _unpack(loc)
                    cores.append(c)
                    found.append(_digest(1 + (loc & 0xFFFF))(raw[first:last + length]))
                    keys.append(key)
                    locs.append(loc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cores, pa.int64()), pa.array(_signed(found)), pa.array(keys, pa.int64()),
                 pa.array(locs, pa.int64())], names=["core", "phrase", "key", "loc"])

    return stored.select("key", "text", "marks").mapInArrow(
        run, "core long, phrase long, key long, loc long")


def _contexts(stored: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` (core, n, many, key, loc) with the extended text."""
    lists = wanted.groupBy("key").agg(F.collect_set(F.struct("core", "n", "many", "loc")).alias("wanted"))
    rows = stored.select("key", "text").dropDuplicates(["key"]).join(lists, "key")

    def run(batches):
        for batch in _slices(batches):
            out = []
            for key, text, want in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "wanted"))):
                raw = text.encode("utf-8", "surrogatepass")
                for w in want:
                    _, first, last = _unpack(w["loc"])
                    out.append({**w, "key": key, "context": raw[first:last + length]})
            yield pa.RecordBatch.from_pylist(out, pa.schema(
                [("core", pa.int64()), ("n", pa.int64()), ("many", pa.bool_()), ("loc", pa.int64()),
                 ("key", pa.int64()), ("context", pa.binary())]))

    return rows.mapInArrow(run, "core long, n long, many boolean, loc long, key long, context binary")


def repeated_windows(contexts: list[bytes], length: int) -> list[np.ndarray]:
    """Per context, which of its windows also occur elsewhere in the group: the suffixes
    that start a window are sorted, and neighbours compared in their first bytes. Windows whose digest no
    other has are not repeated and left out of the sort, so only the others take their bytes in memory."""
    digest = _digest()
    digests = np.fromiter((digest(c[i:i + length]) for c in contexts for i in range(len(c) - length + 1)), np.uint64)
    _, place, times = np.unique(digests, return_inverse=True, return_counts=True)
    left = (times[place] > 1).tolist()
    windows = ((c, i) for c in contexts for i in range(len(c) - length + 1))
    suffix = {k: c[i:i + length] for k, (c, i) in enumerate(windows) if left[k]}
    order = sorted(suffix, key=suffix.__getitem__)
    repeated = np.zeros(len(digests), bool)
    for a, b in zip(order, order[1:]):
        if suffix[a] == suffix[b]:
            repeated[a] = repeated[b] = True
    return np.split(repeated, np.cumsum([len(c) - length + 1 for c in contexts])[:-1])


def _runs(repeated: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _sorted_groups(contexts: DataFrame, length: int) -> DataFrame:
    """(key, lo, hi) of the repeated ranges of single phrases, core by core."""
    def solve(rows):
        out = []
        for row, repeated in zip(rows, repeated_windows([r["context"] for r in rows], length)):
            if row["n"] == 1:  # phrases that occur twice are known to be repeated
                _, first, _ = _unpack(row["loc"])
                out += [{"key": row["key"], "lo": first + a, "hi": first + b - 1 + length}
                        for a, b in _runs(repeated)]
        return out

    def run(batches):
        schema = pa.schema([("key", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])
        held = []
        for batch in _slices(batches):
            out = []
            for row in batch.to_pylist():
                if held and held[0]["core"] != row["core"]:
                    out += solve(held)
                    held = []
                held.append(row)
            yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist(solve(held), schema)

    return (contexts.repartition("core").sortWithinPartitions("core")
            .mapInArrow(run, "key long, lo long, hi long"))


def _counted_windows(contexts: DataFrame, length: int) -> DataFrame:
    """The same for cores with very many phrases: digests of single windows, counted."""
    def run(batches):
        import xxhash

        for batch in _slices(batches):
            for row in batch.to_pylist():
                text = row["context"]
                _, first, _ = _unpack(row["loc"])
                n = len(text) - length + 1
                digest = [xxhash.xxh3_128_digest(text[i:i + length]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest, pa.binary()), pa.array([row["key"]] * n, pa.int64()),
                     pa.array(range(first, first + n), pa.int64()), pa.array([row["n"] == 1] * n)],
                    names=["window", "key", "lo", "single"])

    rows = materialize(contexts.mapInArrow(run, "window binary, key long, lo long, single boolean"),
                       "windows")
    twice = rows.groupBy("window").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("window")
    return (rows.where("single").join(twice, "window")
            .select("key", "lo", (F.col("lo") + length).alias("hi")))


def _parts(contexts: DataFrame, length: int) -> DataFrame:
    """(core, phrase, key, loc, single, context) of the parts of phrases, cut at multiples
    of ``PART`` before the trigger, so that equal windows lie in corresponding parts."""
    def run(batches):
        for batch in _slices(batches):
            out = []
            for row in batch.to_pylist():
                t, first, last = _unpack(row["loc"])
                for b in range((t - last) // PART, (t - first) // PART + 1):
                    hi, lo = min(last, t - b * PART), max(first, t - (b + 1) * PART + 1)
                    core = row["context"][t - b * PART - first:t - (b + 1) * PART + 1 + length - first]
                    own = row["context"][lo - first:hi + length - first]
                    loc = _pack(t, lo, hi)
                    out.append((_digest(b)(core), _digest(1 + (loc & 0xFFFF))(own), row["key"], loc,
                                row["n"] == 1, own))
            core, phrase, key, loc, single, own = zip(*out) if out else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(_signed(core)), pa.array(_signed(phrase)), pa.array(key, pa.int64()),
                 pa.array(loc, pa.int64()), pa.array(single, pa.bool_()), pa.array(own, pa.binary())],
                names=["core", "phrase", "key", "loc", "single", "context"])

    return contexts.mapInArrow(
        run, "core long, phrase long, key long, loc long, single boolean, context binary")


def _range(length: int) -> list:
    """lo and hi of all windows of a phrase, from its packed place."""
    t = F.shiftright("loc", 16)
    return [(t - F.shiftright("loc", 8).bitwiseAND(255)).alias("lo"),
            (t - F.col("loc").bitwiseAND(255) + length).alias("hi")]


def _common_cores(contexts: DataFrame, length: int, group: int) -> DataFrame:
    """(key, lo, hi) for the phrases of cores too common to be sorted at once."""
    rows = materialize(_parts(contexts, length), "parts")
    entry = rows.groupBy("core", "phrase").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("single", "key", "loc", "context")).alias("place"))
    twice = entry.where("n > 1").select("core", "phrase")
    whole = rows.where("single").join(twice, ["core", "phrase"]).select("key", *_range(length))
    entry = entry.select("core", F.when(F.col("place.single") & (F.col("n") == 1), 1).otherwise(2)
                         .cast("long").alias("n"), "place.key", "place.loc", "place.context")
    mixed = (entry.groupBy("core").agg(F.count(F.lit(1)).alias("entries"), F.min("n").alias("least"))
             .where("entries > 1 AND least = 1")
             .select("core", (F.col("entries") > group).alias("many")))
    wanted = materialize(entry.join(mixed, "core"), "part_contexts")
    return (whole.unionByName(_sorted_groups(wanted.where("not many"), length))
            .unionByName(_counted_windows(wanted.where("many"), length)))


def repeated_ranges(stored: DataFrame, length: int, group: int) -> DataFrame:
    """(key, lo, hi): byte ranges covered by repeated windows, not merged."""
    rows = materialize(_extended(stored, length), "phrases")
    entry = rows.groupBy("core", "phrase").agg(F.count(F.lit(1)).alias("n"),
                                               F.min(F.struct("key", "loc")).alias("place"))
    twice = entry.where("n > 1").select("core", "phrase", "n")
    whole = join_counted(rows, twice, ["core", "phrase"], rows.count(), ["key", "loc"]).select("key", *_range(length))
    mixed = (entry.groupBy("core").agg(F.count(F.lit(1)).alias("entries"), F.min("n").alias("least"))
             .where("entries > 1 AND least = 1")
             .select("core", (F.col("entries") > group).alias("many")))
    wanted = entry.join(mixed, "core").select("core", "n", "many", "place.key", "place.loc")
    contexts = materialize(_contexts(stored, wanted, length), "contexts")
    return (whole.unionByName(_sorted_groups(contexts.where("not many"), length))
            .unionByName(_common_cores(contexts.where("many"), length, group)))


# ---- result ---------------------------------------------------------------

def _cut(raw: bytes, ranges: Iterable[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    merged: list[list[int]] = []
    for r in sorted(ranges):
        if merged and r[0] <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], r[1])
        else:
            merged.append(list(r))
    kept, at = [], 0
    for lo, hi in merged:
        kept.append(raw[at:lo])
        at = hi
    return b"".join([*kept, raw[at:]]), [tuple(m) for m in merged]


_COLUMNS = {"n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(),
            "kept_sha256": pa.string(), "kept": pa.string(), "spans": pa.list_(pa.list_(pa.int64()))}
_DDL = {"n_bytes": "long", "n_removed": "long", "n_spans": "long", "kept_sha256": "string",
        "kept": "string", "spans": "array<array<long>>"}


def _results(rows: DataFrame, outputs: tuple[str, ...]) -> DataFrame:
    schema = StructType.fromDDL("doc_id long").add(rows.schema["carry"])  # its names may hold any character
    for field in StructType.fromDDL(", ".join(f"{c} {_DDL[c]}" for c in outputs)):
        schema = schema.add(field)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in _slices(batches):
            cols = {c: [] for c in outputs}
            for text, (lo, hi) in zip(batch.column("text").to_pylist(), _members(batch.column("ranges"), "lo", "hi")):
                raw = text.encode("utf-8", "surrogatepass")
                kept, merged = _cut(raw, zip(lo.tolist(), hi.tolist()))
                values = {"n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(merged)}
                if "kept_sha256" in cols:
                    values["kept_sha256"] = hashlib.sha256(kept).hexdigest()
                if "kept" in cols:  # a character that a cut went through is dropped
                    values["kept"] = kept.decode("utf-8", "ignore")
                if "spans" in cols:
                    values["spans"] = [list(m) for m in merged]
                for c in outputs:
                    cols[c].append(values[c])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("carry"),
                 *(pa.array(cols[c], _COLUMNS[c]) for c in outputs)],
                names=["doc_id", "carry", *outputs])

    return rows.select("doc_id", "carry", "text", "ranges").mapInArrow(
        run, schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH,
                   outputs: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept",
                                               "spans"), *,
                   carry: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text",
                   group: int = GROUP) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``outputs``, and the struct ``carry`` of the
    columns of that name, if any is asked for.

    Every byte covered by a ``length``-byte string (at least 32) that also starts anywhere else,
    in the same or another document, is removed; strings are judged on the input.
    ``kept`` is the remaining text (characters cut apart dropped), ``kept_sha256``
    digests the remaining bytes, ``spans`` are the removed byte ranges. Null and empty
    texts, and texts shorter than ``length``, lose nothing. Repeated rows count as copies, so
    their strings are repeated. A null id stays null; other columns are left out; an empty
    table gives no rows.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be at least {2 * GRAM}")
    outputs = tuple(outputs)
    kept = F.struct(*(F.col(f"`{c}`") for c in carry or (id_col,))).alias("carry")
    docs = id_text(docs, id_col, text_col, kept).withColumn("key", F.xxhash64("doc_id", "text"))
    long_texts = docs.where(F.octet_length("text") >= length)
    twice = materialize(_parse(long_texts, length, False).groupBy("core").agg(F.count(F.lit(1)).alias("n"))
                        .where("n > 1"), "cores")
    total = twice.agg(F.sum("n")).first()[0] or 0
    marks = (join_counted(_parse(long_texts, length, True), twice, ["core"], total, ["key", "loc"])
             .groupBy("key").agg(F.collect_set(F.struct("core", "loc")).alias("marks")))
    # the texts move once; those without a mark are done
    stored = materialize(docs.join(marks, "key", "left"), "marked")
    marked = stored.where("marks is not null")
    ranges = (repeated_ranges(marked, length, group)
              .groupBy("key").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges")))
    ready = (marked.join(ranges, "key", "left").select("doc_id", "carry", "text", "ranges")
             .unionByName(stored.where("marks is null").select(
                 "doc_id", "carry", "text", F.lit(None).cast("array<struct<lo:long,hi:long>>").alias("ranges"))))
    out = _results(ready, outputs)
    return out if carry else out.drop("carry")
