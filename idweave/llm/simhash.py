"""SimHash near-duplicates with a Gray-order hierarchical index.

1. *Fingerprints.* Per document, a bit is 1 if it is set in more than half of the
   XXH64 values of its word shingles. Only (doc_id, fingerprint) goes on.
2. *Shared masked patterns.* The 64 bits are cut into blocks. Two fingerprints with
   at most ``max_bits`` differing bits agree in all but ``max_bits`` blocks, so each
   distinct fingerprint is dealt out by every choice of the other blocks: the masked
   pattern is the uppermost node of the index. A pattern that very many
   fingerprints share is split into slabs, and each pair of slabs is a cell of its own.
3. *Index in a cell.* The fingerprints are sorted by Gray rank; runs of 16 form a
   node that holds the bits its members share, 16 nodes form one of the next
   level. The search for pairs walks pairs of nodes downwards: a pair's
   differences accumulate over the bits that become known, and beyond ``max_bits`` the
   whole pair of groups is pruned. If even all unknown bits keep within it, all members link
   without a closer look.
4. A cell gives a spanning forest of its links, never the pairs; the forests
   are joined by connected components.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, join_counted, materialize, worker_table
from .graph import connected_components

CELL = 8192        # fingerprints of a masked pattern dealt with together
FAN = 16
AT_ONCE = 1 << 16  # pairs of nodes expanded together
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---- fingerprints ---------------------------------------------------------

def fingerprint(text: str, shingle: int) -> int:
    """Unsigned 64-bit SimHash of the A-Z lower-cased words' shingles."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    n = len(words) - shingle + 1
    for lo in range(0, n, AT_ONCE):
        hi = min(n, lo + AT_ONCE)
        a, b = starts[lo:hi].tolist(), ends[lo + shingle - 1:hi + shingle - 1].tolist()
        h = np.array([digest(joined[x:y], 42) for x, y in zip(a, b)], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(total * 2 > n, bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, *, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long; null and empty texts have 0."""
    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        worker_table("simhash")
        fp = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64)
        return pa.array(fp.view(np.int64))

    return id_text(docs, id_col, text_col).select("doc_id", simhash("text").alias("fp"))


# ---- index ----------------------------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence (prefix XOR of its bits)."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def pattern_masks(max_bits: int, blocks: int) -> list[int]:
    """One mask for each choice of ``blocks - max_bits`` of the blocks, as signed longs."""
    edge = [64 * k // blocks for k in range(blocks + 1)]
    part = [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:])]
    masks = [sum(c) for c in itertools.combinations(part, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


class Index:
    """Levels of nodes over codes sorted by (cell, Gray rank); level 0 are the codes."""

    def __init__(self, cell: np.ndarray, fp: np.ndarray):
        order = np.lexsort((gray_rank(fp), cell))
        self.fp, cell = fp[order], cell[order]
        n = len(self.fp)
        self.known, self.value = [np.full(n, ALL)], [self.fp]
        self.first, self.end = [], []  # children of the nodes of level k + 1 in level k
        self.member = [(np.arange(n), np.arange(1, n + 1))]
        low, high = self.fp, self.fp
        while True:
            new = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
            size = np.diff(np.r_[new, len(cell)])
            place = np.arange(len(cell)) - np.repeat(new, size)
            first = np.flatnonzero(place % FAN == 0)
            low, high = np.bitwise_and.reduceat(low, first), np.bitwise_or.reduceat(high, first)
            end = np.r_[first[1:], len(cell)]
            cell = cell[first]
            self.known.append(~(low ^ high))
            self.value.append(low)
            self.first.append(first)
            self.end.append(end)
            self.member.append((self.member[-1][0][first], self.member[-1][1][end - 1]))
            if (cell[1:] != cell[:-1]).all():
                self.roots = len(cell)
                return

    def links(self, max_bits: int):
        """Arrays (i, j) of linked codes whose closure holds every link."""
        top = len(self.known) - 1
        root = np.arange(self.roots)
        zero = np.zeros(self.roots, np.uint64)
        stack = [(top, root[k:k + AT_ONCE], root[k:k + AT_ONCE], zero[k:k + AT_ONCE],
                  zero[k:k + AT_ONCE].astype(np.int64)) for k in range(0, self.roots, AT_ONCE)]
        while stack:
            level, a, b, done, dist = stack.pop()
            new = self.known[level][a] & self.known[level][b] & ~done
            dist = dist + np.bitwise_count(new & (self.value[level][a] ^ self.value[level][b]))
            done = done | new
            worst = dist + 64 - np.bitwise_count(done)
            sure, keep = worst <= max_bits, dist <= max_bits
            if level == 0:
                yield a[keep], b[keep]
                continue
            if sure.any():  # all members of both groups are within reach of each other
                hub = self.member[level][0][a[sure]]
                for g in (a[sure], b[sure]):
                    start, stop = self.member[level][0][g], self.member[level][1][g]
                    size = stop - start
                    yield (np.repeat(hub, size),
                           np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum()))
            keep &= ~sure
            a, b, done, dist = a[keep], b[keep], done[keep], dist[keep]
            if not len(a):
                continue
            fa, na = self.first[level - 1][a], self.end[level - 1][a] - self.first[level - 1][a]
            fb, nb = self.first[level - 1][b], self.end[level - 1][b] - self.first[level - 1][b]
            cuts = np.flatnonzero(np.diff(np.cumsum(na * nb) // AT_ONCE)) + 1
            for s in np.split(np.arange(len(a)), cuts):
                if not len(s):
                    continue
                size = na[s] * nb[s]
                k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                w = np.repeat(nb[s], size)
                x, y = np.repeat(fa[s], size) + k // w, np.repeat(fb[s], size) + k % w
                ok = (x < y) if level == 1 else (x <= y)
                stack.append((level - 1, x[ok], y[ok], np.repeat(done[s], size)[ok],
                              np.repeat(dist[s], size)[ok]))


def spanning_links(cell: np.ndarray, fp: np.ndarray, max_bits: int):
    """(member, root) fingerprints of a spanning forest of all links within cells."""
    index = Index(cell, fp)
    label = np.arange(len(fp))
    for i, j in index.links(max_bits):
        while True:
            i, j = label[i], label[j]
            apart = i != j
            if not apart.any():
                break
            i, j = i[apart], j[apart]
            np.minimum.at(label, np.maximum(i, j), np.minimum(i, j))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    member = np.flatnonzero(label != np.arange(len(fp)))
    return index.fp[member], index.fp[label[member]]


def _forests(cells: DataFrame, max_bits: int) -> DataFrame:
    """Spanning forest edges (a, b) of every cell; rows come sorted by cell."""
    keys = ["pattern", "masked", "c1", "c2"]

    def run(batches):
        held: list[np.ndarray] = []

        def solve(rows):
            if len(rows) < 2:
                return None
            new = np.r_[False, (rows[1:, :4] != rows[:-1, :4]).any(axis=1)]
            cell = np.cumsum(new)
            a, b = spanning_links(cell, rows[:, 4].copy().view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            rows = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)
                                    for k in [*keys, "fp"]])
            if not len(rows):
                continue
            # up to the last cell, which may go on in the next batch
            last = np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0
            if cut or (held and (held[-1][-1, :4] != rows[0, :4]).any()):
                out = solve(np.concatenate([*held, rows[:cut]]))
                held = []
                if out is not None:
                    yield out
            held.append(rows[cut:])
        if held:
            out = solve(np.concatenate(held))
            if out is not None:
                yield out

    return (cells.repartition(*keys).sortWithinPartitions(*keys)
            .mapInArrow(run, "a long, b long"))


def near_links(distinct: DataFrame, max_bits: int, cell: int = CELL) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs within ``max_bits``.

    ``distinct`` has one column ``fp`` of distinct fingerprints. The more there are, the
    more blocks the 64 bits are cut into, so that a pattern holds few on average.
    """
    n = distinct.count()
    blocks = max_bits + 1
    while n >> (64 * (blocks - max_bits) // blocks) > cell // 2 and blocks < max_bits + 4:
        blocks += 1
    masks = F.array(*(F.struct(F.lit(k).alias("pattern"), F.lit(m).cast("long").alias("mask"))
                      for k, m in enumerate(pattern_masks(max_bits, blocks))))
    dealt = (distinct.select("fp", F.explode(masks).alias("x"))
             .select("fp", "x.pattern", F.col("fp").bitwiseAND(F.col("x.mask")).alias("masked")))
    full = dealt.groupBy("pattern", "masked").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    slabs = F.ceil(F.col("n") / F.lit(cell)).cast("int")
    own = F.pmod(F.xxhash64("fp"), slabs).cast("int")
    cells = (dealt.join(full, ["pattern", "masked"])
             .select("pattern", "masked", "fp", own.alias("own"),
                     F.explode(F.sequence(F.lit(0), slabs - 1)).alias("other"))
             .select("pattern", "masked", F.least("own", "other").alias("c1"),
                     F.greatest("own", "other").alias("c2"), "fp"))
    return _forests(cells, max_bits)


def simhash_components(docs: DataFrame, shingle: int = 4, max_bits: int = 4, *,
                       id_col: str = "doc_id", text_col: str = "text",
                       cell: int = CELL) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Documents link if their fingerprints differ in at most ``max_bits`` bits;
    component_id is the smallest doc_id of the connected component. Null and empty texts
    have fingerprint 0 and link like any other. A null doc_id stays null and
    is never a component_id unless the component has no other id; repeated rows and
    ids are kept each; other columns are left out; an empty table gives no rows.
    """
    own = materialize(fingerprints(docs, shingle, id_col=id_col, text_col=text_col), "fingerprints")
    distinct = own.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
    roots = connected_components(near_links(distinct.select("fp"), max_bits, cell))
    linked = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    linked = linked.join(distinct, linked.node == distinct.fp).select("fp", "root", "first_id")
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(least, "root").select(F.col("fp").alias("linked_fp"), "component_id")
    place = (distinct.join(linked, F.col("fp") == F.col("linked_fp"), "left")
             .select("fp", F.coalesce("component_id", "first_id").alias("component_id"), "n"))
    return join_counted(own, place, ["fp"], own.count(), ["doc_id"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
