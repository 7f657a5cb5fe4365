"""Brown class-based bigram scores.

A word w behind a word of class h has probability p(class(w) | h) * p(w | class(w)).
Words are known by a 64-bit hash, so any length costs the same.

1. *Counts.* Tasks count their words and Spark sums them: every word of every
   training text is in the table, however rare.
2. *Vocabulary.* Every word that occurs at least twice gets a class, and the number of classes is the
   cube root of theirs. The counts of the ``LOCAL`` most frequent are sent to the tasks;
   rarer words get count and number by a join. Words that occur once form one class of their own, together with
   unseen ones, whose emissions are their add-one counts.
3. *Exchange clustering.* From the bigrams of all neighbouring words, unclassed ones and the end
   token included: each word moves to the class that raises the likelihood of the class bigrams most while the
   others stay. Where so many moves at once lower it, they are taken
   back, and half as many words, chosen by hash, may move in the turns that follow. A pass are turns that together give every word its chance on average; the exchange ends
   when a pass raised the likelihood by less than ``RISE``, or fewer than ``LEAST`` of the words may move. A turn is
   two Spark jobs over the bigrams: the moves, then the class grid, which Spark sums. Tasks
   count bigrams and shuffle them once, packed, in blocks of the words of a bucket. Tasks
   return the words that change; the label array (4 bytes a classed word) is sent to them.
4. *Scores.* Class transitions are smoothed towards the classes' shares. The history of a token is
   the class of the word before it, at the start that of the end token.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import delete_folder
from .common import id_text, materialize, scratch_path, worker_table

LOCAL = 1 << 18
RISE = 1e-3        # the exchange ends when a pass raised the likelihood by less than this share ...
LEAST = 1 / 16     # ... or when no more than this share of the words may move in a turn
ALPHA = 50.0       # weight of the classes' shares in a transition
RARE = -1          # the mark of a word that is not in the local table
HOT = 256          # words whose bigrams are dealt to all buckets
BUCKET = 1 << 20   # tokens whose bigrams are stored together, on average
CHUNK = 1 << 19    # bigrams that a task holds before it passes them on
MOST_WORDS = (1 << 30) - 4  # word and code share 64 bits
TOGETHER = 512     # words that are moved together in a task
FEW = 40           # counts up to this are looked up when a word is moved
PIECE = 4 << 20    # bytes of text hashed together

_SEP = np.zeros(256, bool)
_SEP[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C17)
_POWER = np.ones(1, np.uint64)
END = np.uint64(0x5851F42D4C957F2D)  # stands for the end token


# ---- words ----------------------------------------------------------------

def _powers(n: int) -> np.ndarray:
    global _POWER
    if len(_POWER) < n:
        grown = np.full(max(n, 1024), _BASE)
        grown[0] = 1
        _POWER = np.multiply.accumulate(grown)
    return _POWER


def _hash_blob(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of every word of a lower-cased blob."""
    a = np.frombuffer(blob, np.uint8)
    word = ~_SEP[a]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], word, [False]])))
    start, size = edge[::2], edge[1::2] - edge[::2]
    if not len(start):
        return start, np.zeros(0, np.uint64)
    offset = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(offset, size)
    h = np.add.reduceat(_BYTE[a[word]] * _powers(int(size.max()))[place], offset)
    h ^= size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for shift, mult in ((33, 0xFF51AFD7ED558CCD), (29, 0xC4CEB9FE1A85EC53)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(mult)
    return start, h ^ (h >> np.uint64(32))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, number of words of each text)."""
    lowered = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    count = np.zeros(len(lowered), np.int64)
    out, k = [], 0
    while k < len(lowered):
        j, size = k, 0
        while j < len(lowered) and (j == k or size + len(lowered[j]) < PIECE):
            size += len(lowered[j]) + 1
            j += 1
        if j == k + 1 and size > 2 * PIECE:  # a very long text, in pieces cut at a space
            text, at = lowered[k], 0
            while at < len(text):
                stop = min(len(text), at + PIECE)
                while stop < len(text) and text[stop] not in b" \t\n\r\x0b\x0c":
                    stop += 1
                h = _hash_blob(text[at:stop])[1]
                out.append(h)
                count[k] += len(h)
                at = stop
        else:
            start, h = _hash_blob(b" ".join(lowered[k:j]))
            edge = np.cumsum([len(x) + 1 for x in lowered[k:j]])
            count[k:j] = np.diff(np.searchsorted(start, edge), prepend=0)
            out.append(h)
        k = j
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), count


def count_words(train: DataFrame) -> DataFrame:
    """(h, c) over all texts of ``train``, the end token included."""
    def run(batches):
        worker_table("class_lm")
        held, size, docs = [], 0, 0

        def merge():
            h = np.concatenate([x[0] for x in held])
            c = np.concatenate([x[1] for x in held])
            key, at = np.unique(h, return_inverse=True)
            return key, np.bincount(at, c, len(key)).astype(np.int64)

        def emit(key, c):
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(c)], names=["h", "c"])

        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                texts = batch.column("text").slice(at, 2048).to_pylist()
                docs += len(texts)
                key, c = np.unique(word_hashes(texts)[0], return_counts=True)
                held.append((key, c))
                size += len(key)
            if size > 4_000_000:
                held = [merge()]
                size = len(held[0][0])
                if size > 2_000_000:  # few words repeat here: pass them on
                    yield emit(*held[0])
                    held, size = [], 0
        if docs:
            held.append((np.array([END]), np.array([docs], np.int64)))
            yield emit(*merge())

    return train.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def frequent(words: DataFrame, sizes: list[float]):
    """(hashes, counts, cutoffs, numbers, N, V): the words whose count reaches the first cutoff, most
    frequent first. A cutoff is the lowest count that at most ``size`` words reach, found from
    a histogram of counts: exact below 256, then in steps of 1/64 octave. The cutoffs after the
    first are 2 at least; ``numbers`` has how many words reach them."""
    c = F.col("c")
    step = F.when(c < 256, c).otherwise(F.floor(F.log2(c.cast("double")) * 64) - 256)
    rows = (words.groupBy(step.alias("step")).agg(F.min("c").alias("low"), F.count(F.lit(1)).alias("n"),
                                                  F.sum("c").alias("total"))
            .orderBy(F.desc("step")).collect())
    cutoffs = []
    for size in sizes:
        n, cutoff = 0, 1 << 62
        for r in rows:
            n += r.n
            if n > size:
                break
            cutoff = r.low
        cutoffs.append(max(cutoff, 2) if cutoffs else cutoff)
    top = words.where(c >= cutoffs[0]).orderBy(F.desc("c"), "h").toPandas()
    numbers = [sum(r.n for r in rows if r.low >= cutoff) for cutoff in cutoffs[1:]]
    return (top["h"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64), cutoffs, numbers,
            sum(r.total for r in rows), sum(r.n for r in rows))


# ---- texts as numbers -----------------------------------------------------

def number_rare(rare: DataFrame, floor: int, start: int) -> DataFrame:
    """(h, c, id) of the words that are not in the local table: from ``start`` on, most frequent
    first; no number for those below ``floor``."""
    row = F.monotonically_increasing_id()
    classed = materialize(rare.where(F.col("c") >= floor).orderBy(F.desc("c"), "h").withColumn("at", row), "numbers")
    part = F.shiftright("at", 33)
    found = classed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    first, at = [], start
    for r in found:  # one row for each partition
        first.append((r.part, at))
        at += r.n
    offset = rare.sparkSession.createDataFrame(first, "part long, first long")
    classed = (classed.withColumn("part", part).join(F.broadcast(offset), "part")
               .select("h", "c", (F.col("first") + F.col("at") - F.shiftleft("part", 33)).alias("id")))
    return classed.unionByName(rare.where(F.col("c") < floor).withColumn("id", F.lit(None).cast("long")))


def encode(docs: DataFrame, h: np.ndarray, c: np.ndarray, classed: int, other: int) -> DataFrame:
    """Per text: numbers of its words (``other`` for those without class, RARE for those not in the
    local table), hashes of the latter in order, and the sum of log10(c + 1) that the local table gives."""
    order = np.argsort(h)
    sent = docs.sparkSession.sparkContext.broadcast(
        (h[order], np.where(order < classed, order, other).astype(np.int32), np.log10(c[order] + 1.0)))

    def run(batches):
        key, number, log_c = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                words, count = word_hashes(part.column("text").to_pylist())
                place = np.minimum(np.searchsorted(key, words), max(len(key) - 1, 0))
                known = key[place] == words if len(key) else np.zeros(len(words), bool)
                ids = np.full(len(words), RARE, np.int32)
                gain = np.zeros(len(words))
                if len(key):
                    ids[known], gain[known] = number[place[known]], log_c[place[known]]
                edge = np.concatenate([[0], np.cumsum(count)])
                pairs = list(zip(edge[:-1].tolist(), edge[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x) for x in ("row", "doc_id", "held_out")), pa.array(count),
                     pa.array([int(known[a:b].sum()) for a, b in pairs], pa.int64()),
                     pa.array([float(gain[a:b].sum()) for a, b in pairs], pa.float64()),
                     pa.array([_planes(ids[a:b]) for a, b in pairs], pa.binary()),
                     pa.array([words[a:b][~known[a:b]].view(np.int64).tolist() for a, b in pairs],
                              pa.list_(pa.int64()))],
                    names=["row", "doc_id", "held_out", "n_words", "n_local", "log_local", "ids", "rare"])

    return docs.mapInArrow(run, "row long, doc_id long, held_out boolean, n_words long, n_local long, "
                                "log_local double, ids binary, rare array<long>")


def fill_rare(texts: DataFrame, rare: DataFrame, other: int) -> DataFrame:
    """(doc_id, held_out, n_words, n_known, log_sum, ids): the words that are not in the local
    table get their numbers by a join."""
    place = F.when(F.col("id").isNotNull(), F.struct("at", "id"))
    found = (texts.select("row", F.posexplode("rare").alias("at", "h")).join(rare, "h").groupBy("row")
             .agg(F.sum(F.log10(F.col("c") + 1)).alias("log_rare"), F.count(F.lit(1)).alias("n_rare"),
                  F.sort_array(F.collect_list(place)).alias("places")))

    def run(batches):
        for batch in batches:
            out = []
            for ids, at, number in zip(*(batch.column(x).to_pylist() for x in ("ids", "at", "id"))):
                x = _numbers(ids)
                gap = np.flatnonzero(x == RARE)
                x[gap] = other
                if at:
                    x[gap[at]] = number
                out.append(_planes(x))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("doc_id", "held_out", "n_words", "n_known", "log_sum")),
                 pa.array(out, pa.binary())],
                names=["doc_id", "held_out", "n_words", "n_known", "log_sum", "ids"])

    return (texts.drop("rare").join(found, "row", "left")
            .select("doc_id", "held_out", "n_words",
                    (F.col("n_local") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
                    (F.col("log_local") + F.coalesce("log_rare", F.lit(0.0))).alias("log_sum"), "ids",
                    F.col("places.at").alias("at"), F.col("places.id").alias("id"))
            .mapInArrow(run, "doc_id long, held_out boolean, n_words long, n_known long, log_sum double, "
                             "ids binary"))


def _planes(ids: np.ndarray) -> bytes:
    """32-bit numbers, bytes of equal weight together: what is mostly zero then compresses well."""
    return ids.view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view(np.int32).ravel()


def _sentences(part: list[np.ndarray], end: int) -> np.ndarray:
    """The texts one after another, each closed (and so the next one begun) by the end token."""
    stop = np.array([end], np.int32)
    return np.concatenate([stop, *(x for ids in part for x in (ids, stop))])


# ---- exchange clustering --------------------------------------------------

def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def _likelihood(grid: np.ndarray) -> float:
    """The part of the log likelihood that classes change: the pairs times the information that a class
    gives of the next one."""
    margins = _xlogx(grid.sum(axis=0)).sum() + _xlogx(grid.sum(axis=1)).sum()
    return float(_xlogx(grid).sum() - margins + _xlogx(grid.sum()))


def move_tables(grid: np.ndarray, classes: int):
    """For counts up to ``FEW`` what a cell gains in x log x: per direction [count, neighbour's class, own class]."""
    few = np.arange(min(FEW, (1 << 22) // max(grid.size, 1)) + 1.0)[:, None, None]
    return [(_xlogx(g[:classes].T[None] + few) - _xlogx(g[:classes].T)[None]).astype(np.float32) for g in (grid, grid.T)]


def best_classes(own: np.ndarray, succ: np.ndarray, pred: np.ndarray, loop: np.ndarray, grid: np.ndarray,
                 classes: int, tables=None) -> np.ndarray:
    """For each word the class below ``classes`` that raises the likelihood of the class bigrams
    ``grid`` most while all other words stay. A row of ``succ`` and ``pred`` has the word's counts
    by class behind and before it; ``loop`` are its pairs with itself, counted in both. Words
    of a class that is none of these get one in any case."""
    rows = np.arange(len(own))
    left, right, corner = grid.sum(axis=1), grid.sum(axis=0), np.diag(grid)
    gain, stay = np.zeros((len(own), classes)), np.zeros(len(own))
    tables = tables or move_tables(grid, classes)
    for counts, before, g, table in ((succ, pred, grid, tables[0]), (pred, succ, grid.T, tables[1])):
        logs = _xlogx(g)
        apart = counts.copy()
        apart[rows, own] = 0
        word, k = np.nonzero(apart)
        n = apart[word, k]
        for part in (n < len(table), n >= len(table)):
            at, to, m = word[part], k[part], n[part]
            if not len(at):
                continue
            more = (table[m.astype(np.int64), to] if m[0] < len(table)
                    else _xlogx(g.T[to, :classes] + m[:, None]) - logs.T[to, :classes])
            start = np.flatnonzero(np.diff(at, prepend=-1))
            gain[at[start]] += np.add.reduceat(more, start)
        if len(word):
            stay += np.bincount(word, logs[own[word], k] - _xlogx(g[own[word], k] - n), len(own))
        # the cells towards the word's own class lack what the word itself has there
        within = counts[rows, own] - loop
        at = np.flatnonzero(within)
        cell = g[:classes, own[at]].T - before[at, :classes]
        gain[at] += _xlogx(cell + within[at, None]) - _xlogx(cell)
    # the cell of a class with itself gets both sides; without any there nothing changes
    word, k = np.nonzero((succ[:, :classes] + pred[:, :classes] > 0) | (loop > 0)[:, None])
    d, s, p = corner[k], succ[word, k], pred[word, k]
    gain[word, k] += _xlogx(d + s + p + loop[word]) + _xlogx(d) - _xlogx(d + s) - _xlogx(d + p)
    stay += _xlogx(corner[own]) - _xlogx(corner[own] - succ[rows, own] - pred[rows, own] + loop)
    for margin, n in ((left, succ.sum(axis=1)), (right, pred.sum(axis=1))):
        total, which = np.unique(n, return_inverse=True)
        gain -= (_xlogx(margin[:classes] + total[:, None]) - _xlogx(margin[:classes]))[which]
        stay -= _xlogx(margin[own]) - _xlogx(margin[own] - n)
    inside = own < classes
    gain[rows[inside], own[inside]] = stay[inside]
    best = gain.argmax(axis=1)
    return np.where(~inside | (gain[rows, best] > stay + 1e-9), best, own)


def best_class(own: int, succ: np.ndarray, pred: np.ndarray, loop: float, grid: np.ndarray) -> int:
    """``best_classes`` of one word."""
    return int(best_classes(np.array([own]), succ[None].astype(float), pred[None].astype(float),
                            np.array([float(loop)]), grid, len(grid))[0])


def _packed(w: np.ndarray, code: np.ndarray, n: np.ndarray) -> bytes:
    """Rows sorted by word and code: differences, byte by byte of equal weight, compressed."""
    planes = [np.diff(x.astype(np.uint32), prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T for x in (w, code)]
    planes.append(n.astype(np.int64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(planes).tobytes())


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(16, -1)
    w, code = (np.cumsum(np.ascontiguousarray(planes[k:k + 4].T).view(np.uint32).ravel(), dtype=np.uint32).astype(np.int64)
               for k in (0, 4))
    return w, code, np.ascontiguousarray(planes[8:].T).view(np.int64).ravel()


def _merged(parts) -> tuple[np.ndarray, np.ndarray]:
    """(key, n) of several in order of the key, equal keys once with the sum of their n."""
    key, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(key)
    key, n = key[order], n[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    start = np.flatnonzero(new)
    return key[start], np.add.reduceat(n, start) if len(start) else n


def _mixed(x: np.ndarray) -> np.ndarray:
    h = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def bigrams(texts: DataFrame, size: int, tokens: int) -> DataFrame:
    """The bigrams of either word: rows (bucket, data), data holding w ascending, code = 2 * other + (1 if the
    other word is before w), and n. All rows of a word are in one bucket, but those of the HOT most
    frequent ones and of the two marks, which are dealt to all. A bucket has those of about ``BUCKET`` tokens."""
    base, buckets = size + 2, max(8, tokens // BUCKET)

    def count(batches):
        worker_table("class_lm")
        held, waiting = [], 0

        def emit():
            pair, n = _merged(held)
            first, second = pair // base, pair % base
            # word and code in one number, in order
            key, n = np.concatenate([first << 32 | second << 1, second << 32 | first << 1 | 1]), np.concatenate([n, n])
            order = np.argsort(key)
            key, n = key[order], n[order]
            w, code = key >> 32, key & 0xFFFFFFFF
            keep = (w <= size) | (code & 1 == 0)  # unclassed words do not move
            w, code, n = w[keep], code[keep], n[keep]
            dealt = (w < HOT) | (w >= size)
            bucket = (_mixed(np.where(dealt, code, w)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
            bucket, w, code, n = bucket[order], w[order], code[order], n[order]
            edge = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
            for at in range(0, len(edge) - 1, 256):
                spans = list(zip(edge[at:at + 256].tolist(), edge[at + 1:at + 257].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[[a for a, _ in spans]]),
                     pa.array([_packed(w[a:b], code[a:b], n[a:b]) for a, b in spans], pa.binary())],
                    names=["bucket", "data"])

        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                x = _sentences([_numbers(b) for b in batch.column("ids").slice(at, 2048).to_pylist()],
                               size).astype(np.int64)
                held.append(np.unique(x[:-1] * base + x[1:], return_counts=True))
                waiting += len(held[-1][0])
                if waiting > 2 * CHUNK:
                    held = [_merged(held)]
                    waiting = len(held[0][0])
                    if waiting > CHUNK:
                        yield from emit()
                        held, waiting = [], 0
        if held:
            yield from emit()

    def merge(batches):
        at, held = None, []

        def emit():
            key, n = _merged(held)
            return pa.RecordBatch.from_arrays([pa.array([at]), pa.array([_packed(key >> 32, key & 0xFFFFFFFF, n)], pa.binary())],
                                              names=["bucket", "data"])

        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist()):
                if held and bucket != at:
                    yield emit()
                    held = []
                at = bucket
                w, code, n = _unpacked(data)
                held.append((w << 32 | code, n))
        if held:
            yield emit()

    schema = "bucket long, data binary"
    rows = texts.select("ids").mapInArrow(count, schema).repartition("bucket").sortWithinPartitions("bucket")
    return materialize(rows.mapInArrow(merge, schema), "bigrams")


def _arrays(batches):
    for batch in batches:
        for data in batch.column("data").to_pylist():
            yield _unpacked(data)


def class_grid(stored: DataFrame, label: np.ndarray, kinds: int) -> np.ndarray:
    """Counts of (class, class of the next word), summed by Spark: ``kinds`` ** 2 numbers reach the driver."""
    sent = stored.sparkSession.sparkContext.broadcast(label)

    def run(batches):
        own, grid = sent.value, np.zeros(kinds * kinds, np.int64)
        for w, code, n in _arrays(batches):
            ahead = code & 1 == 0
            cell = own[w[ahead]].astype(np.int64) * kinds + own[code[ahead] >> 1]
            grid += np.bincount(cell, n[ahead], kinds * kinds).astype(np.int64)
        some = np.flatnonzero(grid)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(grid[some])], names=["cell", "n"])

    found = (stored.select("data").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
             .toArrow())
    sent.unpersist()
    grid = np.zeros(kinds * kinds)
    grid[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return grid.reshape(kinds, kinds)


def _class_sums(w, code, n, label, kinds):
    """(words, succ, pred, loop) of rows sorted by word."""
    new = np.diff(w, prepend=-1) != 0
    edge, row = np.flatnonzero(new), np.cumsum(new) - 1
    cell = row * (2 * kinds) + (code & 1) * kinds + label[code >> 1]
    sums = np.bincount(cell, n, len(edge) * 2 * kinds).reshape(-1, 2 * kinds)
    loop = np.bincount(row, n * (code == 2 * w), len(edge))
    return w[edge], sums[:, :kinds], sums[:, kinds:], loop


def moved(stored: DataFrame, label: np.ndarray, grid: np.ndarray, size: int, chosen) -> np.ndarray:
    """The labels after every word ``chosen(words)`` has moved to its best class, all against the same
    ``grid``. Tasks return the words that change, and partial sums of the HOT ones."""
    kinds = len(grid)
    sent = stored.sparkSession.sparkContext.broadcast((label, grid))

    def run(batches):
        own, grid = sent.value
        tables = move_tables(grid, kinds - 1)
        words, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        hot = {}
        for w, code, n in _arrays(batches):
            take = chosen(w)
            if not take.any():
                continue
            w, code, n = w[take], code[take], n[take]
            edge = np.append(np.flatnonzero(np.diff(w, prepend=-1)), len(w))
            for at in range(0, len(edge) - 1, TOGETHER):
                span = slice(edge[at], edge[min(at + TOGETHER, len(edge) - 1)])
                k, succ, pred, loop = _class_sums(w[span], code[span], n[span], own, kinds)
                dealt = (k < HOT) | (k >= size)
                for j in np.flatnonzero(dealt):
                    sums = np.concatenate([succ[j], pred[j], loop[j:j + 1]])
                    hot[int(k[j])] = hot.get(int(k[j]), 0) + sums
                k, succ, pred, loop = (x[~dealt] for x in (k, succ, pred, loop))
                was = own[k].astype(np.int64)
                to = best_classes(was, succ, pred, loop, grid, kinds - 1, tables)
                words.append(k[to != was])
                found.append(to[to != was])
        sums = np.array(list(hot.values()), float)
        yield pa.RecordBatch.from_arrays(
            [pa.array([x.tobytes()], pa.binary()) for x in
             (np.concatenate(words), np.concatenate(found), np.array(list(hot), np.int64), sums)],
            names=["w", "class", "hot", "sums"])

    out, hot = label.copy(), {}
    for r in stored.select("data").mapInArrow(run, "w binary, class binary, hot binary, sums binary").collect():
        out[np.frombuffer(r["w"], np.int64)] = np.frombuffer(r["class"], np.int64)
        for w, sums in zip(np.frombuffer(r.hot, np.int64).tolist(), np.frombuffer(r.sums).reshape(-1, 2 * kinds + 1)):
            hot[w] = hot.get(w, 0) + sums
    sent.unpersist()
    if hot:
        w, sums = np.array(list(hot)), np.array(list(hot.values()))
        out[w] = best_classes(label[w].astype(np.int64), sums[:, :kinds], sums[:, kinds:-1], sums[:, -1], grid, kinds - 1)
    return out


def exchange(stored: DataFrame, size: int, exchanged: int, classes: int,
             rounds: int | None) -> tuple[np.ndarray, np.ndarray]:
    """(labels of the words 0..size-1, of the end token ``size`` and of the unclassed words
    size + 1, class grid) from the stored ``bigrams``."""
    best = (np.arange(size + 2) % classes).astype(np.int32)
    best[exchanged:size] = best[size + 1] = classes
    best_grid = class_grid(stored, best, classes + 1)
    most = before = _likelihood(best_grid)
    share, had, still, turn = 1.0, 0.0, 0.0, 0
    while share >= LEAST and turn != rounds:
        turn += 1
        limit, salt = np.uint64(int(share * 1024)), np.uint64(turn * 0x632BE5AB)

        def chosen(w, limit=limit, salt=salt):
            here = _mixed(w.astype(np.uint64) ^ salt) >> np.uint64(7) & np.uint64(1023)
            return ((w < exchanged) | (w == size)) & (here < limit)

        label = moved(stored, best, best_grid, size, chosen)
        if (label == best).all():
            had, still = had + share, still + share
            if still >= 1:
                break  # no word has a better class
            continue
        still = 0.0
        grid = class_grid(stored, label, classes + 1)
        value = _likelihood(grid)
        if value <= most:  # too many words moved at once: back, and fewer from now on
            share /= 2
            continue
        best, best_grid, most, had = label, grid, value, had + share
        if had >= 1:
            if most - before < RISE * abs(most):
                break
            before, had = most, 0.0
    if exchanged < size:  # the others join the class that fits both their sides best
        best = moved(stored, best, best_grid, size, lambda w: (w >= exchanged) & (w < size))
        best_grid = class_grid(stored, best, classes + 1)
    return best, best_grid


# ---- model ----------------------------------------------------------------

def class_count(words: int) -> int:
    """The number of classes of a vocabulary: its cube root."""
    return max(2, round(words ** (1 / 3)))


def class_lm_scores(docs: DataFrame, *, parts: int = 7, part: int = 2, id_col: str = "doc_id",
                    text_col: str = "text", local: int = LOCAL, classed: float = math.inf,
                    exchanged: float = math.inf, rounds: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigram) and score (class model), both log10 of the text.

    The model learns from the rows whose crc32 of the id as text does not leave ``part``;
    a null id is not held out. Null and empty texts are one end token. Repeated
    rows are counted and scored each; words and texts of any length are read whole; other
    columns are left out. If all rows are held out, every count is 0 and the scores are
    those of the smoothing alone; an empty table gives no rows. ``classed`` and ``exchanged``
    bound the words that get a class and that exchange; by default all that occur twice do both. ``rounds`` bounds the turns of the exchange, by default it runs until it converges.
    """
    spark = docs.sparkSession
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == part, F.lit(False))
    docs = id_text(docs, id_col, text_col).withColumn("held_out", out)
    words = materialize(count_words(docs.where(~F.col("held_out"))), "words")
    end_hash = int(END.view(np.int64))
    ends = words.where(F.col("h") == end_hash).first()
    n_ends = ends.c if ends else 0
    words = words.where(F.col("h") != end_hash)
    # words that occur once stay without class, so that their class tells of unseen words
    h, c, cuts, (size, movable), total, kinds = frequent(words, [local, classed, exchanged])
    n_train, n_kinds = total + n_ends, kinds + (n_ends > 0)
    near = int((c >= cuts[1]).sum())  # the classed words of the local table
    movable = min(movable, size)
    classes = class_count(size)
    if size >= MOST_WORDS:
        raise ValueError(f"{size} words occur twice; numbers of words end at {MOST_WORDS}")

    docs = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    path = scratch_path(spark, "encoded")
    encode(docs, h, c, near, size + 1).write.parquet(path)
    coded = spark.read.parquet(path)
    rare = number_rare(words.where(F.col("c") < cuts[0]), cuts[1], near)
    texts = materialize(fill_rare(coded, rare, size + 1), "numbered")
    delete_folder(spark, path)

    label, grid = exchange(bigrams(texts.where(~F.col("held_out")), size, n_train), size, movable, classes, rounds)
    tokens = grid.sum(axis=0)
    share = (tokens + 1) / (grid.sum() + classes + 1)
    step = np.log10((grid + ALPHA * share) / (grid.sum(axis=1, keepdims=True) + ALPHA))
    # emissions: add-one within a class; the class of the other words also holds unseen ones
    mass = tokens + np.bincount(label[:size + 1], minlength=classes + 1)
    mass[classes] += kinds - size + 1
    step -= np.log10(np.maximum(mass, 1))  # a class may be empty
    sent = spark.sparkContext.broadcast((label, step))

    def run(batches):
        label, step = sent.value
        for batch in batches:
            score = []
            for ids in batch.column("ids").to_pylist():
                x = label[_sentences([_numbers(ids)], size)]
                score.append(float(step[x[:-1], x[1:]].sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in ("doc_id", "held_out", "n_words", "n_known", "log_sum")),
                 pa.array(score, pa.float64())],
                names=["doc_id", "held_out", "n_words", "n_known", "log_sum", "own"])

    n_tokens = F.col("n_words") + 1
    log_sum = F.col("log_sum") + math.log10(n_ends + 1)
    return (texts.mapInArrow(run, "doc_id long, held_out boolean, n_words long, n_known long, log_sum double, "
                                  "own double")
            .select("doc_id", "held_out", n_tokens.alias("n_tokens"),
                    (F.col("n_known") + int(n_ends > 0)).alias("n_known"),
                    F.lit(n_train).cast("long").alias("train_tokens"),
                    (log_sum - n_tokens * math.log10(n_train + n_kinds + 1)).alias("base_score"),
                    (F.col("own") + log_sum).alias("score")))
