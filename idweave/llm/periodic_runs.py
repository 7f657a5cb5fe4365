"""Runs of repeated words, found by internal pattern matching.

A run is a stretch of words with smallest period q that holds at least ``REPEATS`` periods and
cannot be longer on either side. Tasks work on the texts of a batch together, each text for itself:

1. *Suffix array.* Suffixes are ranked by their first 2, 4, 8, ... words; from round to round only those
   that still share a rank are sorted on. The ranks of every round are kept: they name all
   factors of that length, so two places are compared for their longest common extension,
   to the right or left, in one step for each length.
2. *Dyadic blocks.* For lengths b = 2, 4, 8, ... every text is cut into blocks. A block that occurs
   again is a range of the suffix array.
3. *Range successor.* A wavelet tree over the suffix array gives the occurrences of a block that start
   in the window ``[s + (2b-1)/3, s + (4b-1)/3)`` behind its own start s: their number, the first and the second.
4. *Progressions.* The window is shorter than b, so occurrences in it form one arithmetic progression. One or
   two of them are candidate periods themselves. Of three or more, the block and they lie in stretches
   with the progression's difference as period, and a run that holds both stretches moves the
   ends of one to those of the other: two candidates, however many occurrences.
5. *Runs.* A candidate is extended to both sides; long enough stretches are runs, and of equal
   stretches the smallest period counts.

Every run of four periods is found: with b at most (3q + 1) / 2 it holds a whole block among its first
2b - 1 words, and the copy of this block q words on.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, worker_table

REPEATS = 4          # periods that a run holds at least
SHORTEST = 6         # words that it holds at least
BATCH_WORDS = 1 << 19


# ---- suffix array -----------------------------------------------------------

class Factors:
    """Suffix array of numbered words of several texts, with the ranks by 1, 2, 4, ... words.

    ``start`` are the first places of the texts. A suffix ends with its text, so factors
    of different texts are different.
    """

    def __init__(self, words: np.ndarray, start: np.ndarray):
        n = len(words)
        self.start, self.stop = start, np.append(start[1:], n)
        text = np.repeat(np.arange(len(start)), self.stop - start)
        end = self.stop[text]
        width = int(words.max(initial=0)) + 2
        if len(start) * float(width) ** 2 >= 2.0 ** 63:
            words = np.unique(words, return_inverse=True)[1]
            width = int(words.max(initial=0)) + 2
        one = text * width + words + 1
        behind = np.zeros(n, np.int64)
        behind[:-1] = words[1:] + 1
        behind[self.stop[self.stop > start] - 1] = 0
        self.sa = np.argsort(one * width + behind)
        key = (one * width + behind)[self.sa]
        rank = np.empty(n + 1, np.int64)
        rank[n] = -1
        first = np.flatnonzero(np.diff(key, prepend=-1))
        size = np.diff(np.append(first, n))
        rank[self.sa] = np.repeat(first, size)
        self.names = [np.append(one, -1), rank.copy()]
        self.groups = []  # per block length 2, 4, ...: (first, size) of the ranges with more than one suffix
        h = 2
        while True:
            many = size > 1
            first, size = first[many], size[many]
            self.groups.append((first, size))
            if not len(first):
                break
            at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            place = self.sa[at]
            ahead = place + h
            follow = np.where(ahead < end[place], rank[np.minimum(ahead, n)], -1)
            key = rank[place] * (n + 1) + follow + 1
            order = np.argsort(key)
            self.sa[at], key = place[order], key[order]
            new = np.flatnonzero(np.diff(key, prepend=-1))
            size = np.diff(np.append(new, len(key)))
            first = at[new]
            rank[self.sa[at]] = np.repeat(first, size)
            self.names.append(rank.copy())
            h *= 2

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at ``i`` and ``j`` > ``i``."""
        out = np.zeros(len(i), np.int64)
        last = len(self.names[0]) - 1
        for k in range(len(self.names) - 1, -1, -1):
            same = self.names[k][np.minimum(i + out, last)] == self.names[k][np.minimum(j + out, last)]
            out += same.astype(np.int64) << k
        return out

    def left(self, i: np.ndarray, j: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Length of the longest common suffix of what lies before ``i`` and ``j`` in a text from ``start`` on."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            a, b = i - out - (1 << k), j - out - (1 << k)
            inside = a >= start
            same = inside & (self.names[k][np.where(inside, a, 0)] == self.names[k][np.where(inside, b, 0)])
            out += same.astype(np.int64) << k
        return out


class WaveletTree:
    """Ranges of a sequence of numbers: how many are below a bound, and the k-th smallest."""

    def __init__(self, values: np.ndarray):
        self.bits = max(int(values.max(initial=0)).bit_length(), 1)
        self.levels = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            packed = np.zeros(len(ones) // 64 + 1, np.uint64)
            raw = np.packbits(ones, bitorder="little")
            packed.view(np.uint8)[:len(raw)] = raw
            before = np.cumsum(np.bitwise_count(packed), dtype=np.int64) - np.bitwise_count(packed)
            self.levels.append((bit, packed, before, int(len(ones) - ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return level[2][word] + np.bitwise_count(level[1][word] & mask)

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """Numbers of ``[lo, hi)`` that are less than ``bound``."""
        out = np.zeros(len(lo), np.int64)
        over = bound >= 1 << self.bits
        bound = np.where(over, 0, bound)
        size = hi - lo
        for level in self.levels:
            a, b = self._ones(level, lo), self._ones(level, hi)
            up = (bound >> level[0] & 1).astype(bool)
            out += np.where(up, (hi - b) - (lo - a), 0)
            lo, hi = np.where(up, level[3] + a, lo - a), np.where(up, level[3] + b, hi - b)
        return np.where(over, size, out)

    def smallest(self, lo: np.ndarray, hi: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The ``k``-th (from 0) smallest number of ``[lo, hi)``."""
        out = np.zeros(len(lo), np.int64)
        for level in self.levels:
            a, b = self._ones(level, lo), self._ones(level, hi)
            zeros = (hi - b) - (lo - a)
            up = k >= zeros
            k = np.where(up, k - zeros, k)
            out |= up.astype(np.int64) << level[0]
            lo, hi = np.where(up, level[3] + a, lo - a), np.where(up, level[3] + b, hi - b)
        return out


# ---- candidate periods --------------------------------------------------------

def _candidates(f: Factors, text: np.ndarray):
    """(place, period) pairs: blocks and the distances at which they may repeat in a run."""
    head, size = f.groups[0]
    if not len(head):
        return
    inner = np.repeat(head - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    tree = WaveletTree(f.sa[inner])  # only suffixes whose first two words occur again
    longest = int((f.stop - f.start).max())
    for k, (first, size) in enumerate(f.groups, start=1):
        b = 1 << k
        low, high = -(-(2 * b - 1) // 3), -(-(4 * b - 1) // 3) - 1
        if not len(first) or REPEATS * low > longest:
            return
        at = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        place = f.sa[at]
        whole = (place - f.start[text[place]]) % b == 0
        s = place[whole]
        lo = np.searchsorted(inner, np.repeat(first, size)[whole])
        hi = lo + np.repeat(size, size)[whole]
        n_low = tree.below(lo, hi, s + low)
        found = tree.below(lo, hi, s + high + 1) - n_low
        hit = found > 0
        s, lo, hi, n_low, found = s[hit], lo[hit], hi[hit], n_low[hit], found[hit]
        one = tree.smallest(lo, hi, n_low)
        few = found <= 2
        yield s[few], (one - s)[few]
        more = found > 1
        s, one = s[more], one[more]
        two = tree.smallest(lo[more], hi[more], n_low[more] + 1)
        pair = found[more] == 2
        yield s[pair], (two - s)[pair]
        s, one, p = s[~pair], one[~pair], (two - one)[~pair]
        if len(s):
            start = f.start[text[s]]
            ends = one + f.right(one, one + p) - (s + f.right(s, s + p))
            heads = one - f.left(one, one + p, start) - (s - f.left(s, s + p, start))
            for d in (ends, heads):
                fits = (d >= low) & (d <= high)
                yield s[fits], d[fits]


def runs_of(words: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first place, length, period) of all runs of the texts that begin at ``start``, in order."""
    empty = np.zeros(0, np.int64)
    if not len(words):
        return empty, empty, empty
    f = Factors(words, start)
    text = np.repeat(np.arange(len(start)), f.stop - f.start)
    found = [*_candidates(f, text)]
    if not found:
        return empty, empty, empty
    s, d = (np.concatenate(x) for x in zip(*found))
    head = s - f.left(s, s + d, f.start[text[s]])
    length = s + d + f.right(s, s + d) - head
    keep = (length >= SHORTEST) & (length >= REPEATS * d)
    head, length, d = head[keep], length[keep], d[keep]
    order = np.lexsort((d, length, head))
    head, length, d = head[order], length[order], d[order]
    new = np.ones(len(head), bool)
    new[1:] = (np.diff(head) != 0) | (np.diff(length) != 0)
    head, length, d = head[new], length[new], d[new]
    order = np.lexsort((d, head))
    return head[order], length[order], d[order]


# ---- texts ----------------------------------------------------------------------

class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _rows(texts: list[str], outputs: tuple[str, ...]):
    """The outputs of each text, in order."""
    split = [t.encode("utf-8", "surrogatepass").split() for t in texts]  # bytes split at ASCII white space only
    count = np.array([len(x) for x in split], np.int64)
    total = int(count.sum())
    numbers = _Numbers()
    words = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split)), np.int64, total)
    stop = np.cumsum(count)
    some = count > 0
    begin = (stop - count)[some]
    head, length, period = runs_of(words, begin)
    owner = np.flatnonzero(some)[np.searchsorted(begin, head, side="right") - 1] if len(head) else head
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, head + period, 1)
    np.add.at(cover, head + length, -1)
    kept = np.cumsum(cover[:-1]) == 0
    edge = np.searchsorted(owner, np.arange(len(texts) + 1))
    for t, x in enumerate(split):
        a, b = edge[t], edge[t + 1]
        at = int(stop[t] - count[t])
        row = {"n_words": len(x)}
        if "runs" in outputs:
            row["runs"] = [{"start": h - at, "length": n, "period": p} for h, n, p in zip(
                head[a:b].tolist(), length[a:b].tolist(), period[a:b].tolist())]
        if "kept" in outputs or "kept_sha256" in outputs:
            if b > a:
                x = [x[k] for k in np.flatnonzero(kept[at:at + len(x)]).tolist()]
            blob = b" ".join(x)
            if "kept" in outputs:
                row["kept"] = blob.decode("utf-8", "surrogatepass")
            if "kept_sha256" in outputs:
                row["kept_sha256"] = hashlib.sha256(blob).hexdigest()
        yield row


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_TYPES = {"n_words": ("long", pa.int64()), "kept": ("string", pa.string()), "kept_sha256": ("string", pa.string()),
          "runs": ("array<struct<start: long, length: long, period: long>>", pa.list_(_RUN))}


def periodic_runs(docs: DataFrame, outputs: tuple[str, ...] = ("n_words", "runs", "kept"), *,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and ``outputs``, in that order.

    ``runs`` are the runs of the text's words (``[^\\x20\\x09-\\x0D]+``, compared as they are, numbered
    from 0) by start, then period. ``kept`` are the words that no run holds after its first period,
    joined by a space, and ``kept_sha256`` its digest. Null and empty texts have no words and no runs;
    a null id stays null; repeated rows are read each for itself; a text of any length is read whole, in one task
    and in memory that grows with it (about 100 bytes a word); other columns are left out, so none can
    clash; an empty table gives no rows.
    """
    outputs = tuple(outputs)
    schema = ", ".join(["doc_id long", *(f"{o} {_TYPES[o][0]}" for o in outputs)])

    def run(batches):
        worker_table("periodic_runs")
        for batch in batches:
            texts = batch.column("text").to_pylist()
            ids, at = batch.column("doc_id"), 0
            while at < len(texts):
                stop, size = at, 0
                while stop < len(texts) and (stop == at or size + len(texts[stop]) <= 6 * BATCH_WORDS):
                    size += len(texts[stop])
                    stop += 1
                rows = [*_rows(texts[at:stop], outputs)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, stop - at), *(pa.array([r[o] for r in rows], _TYPES[o][1]) for o in outputs)],
                    names=["doc_id", *outputs])
                at = stop

    return id_text(docs, id_col, text_col).mapInArrow(run, schema)
