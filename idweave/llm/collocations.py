"""Phrases whose words occur together more often than apart, by direct-address tiling.

1. *Words.* Tasks count the words of each language and Spark sums them. The ``RANKED`` most frequent ones
   that reach the least count are numbered by frequency; the key of any other word is a 62-bit hash of
   language and word, made negative. Words that share a hash with another one get a number
   of their own (or none, if too rare), so keys are exact.
2. *Pairs.* The square of (left number, right number) is cut into tiles of ``SIDE`` x ``SIDE`` cells. Numbers follow
   frequency, so the mass lies in few tiles: a task gives each of those a dense table that ``bincount`` adds to
   at the cell's address. Pairs of all other tiles are kept as sorted
   coordinates with counts (COO), those of unranked words by their keys. Spark sums the counts.
3. *Longer phrases.* The most frequent pairs that reach the least count are numbered anew by frequency
   and paired with the word behind them in the same way, and so on up to the longest phrase.
   Only phrases whose both shorter parts may be frequent are counted; a bitmap of fixed size tells
   tasks which may, and where it errs it costs a counted row, never a phrase.
4. *Scores.* A phrase joins its first words and its last words among the shorter phrases, from which it takes the
   counts of all parts. Arithmetic is decimal.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship, worker_table

RANKED = 1 << 17      # words, and phrases of each length, that are numbered
HASH_BITS = 62        # of the key of a word without number
REMEMBERED = 1 << 16  # words without number of a language whose key a worker remembers ...
LANGUAGES = 16        # ... of so many languages
FILTER_BITS = 25      # log2 of the bits of the map of frequent keys
SIDE = 256            # cells a side of a tile
TILES = 32            # dense tiles of a task, at most
CHUNK = 1 << 20       # pairs that a task gathers before it sorts them
PIECE = 4 << 20       # characters of text split together
WORDS_HELD = 400_000  # distinct words that a task holds before it passes their counts on
SHARES = 64           # in which the candidates of a language are ranked first
EMIT = 1 << 18        # counts that a task hands to Spark at a time
NONE = -1             # no word: the end of a piece, or a word that is too rare

_LOWERED = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_SEPARATOR = re.compile("[.,;:!?\n\x0b\x0c\r]")
_BREAK = b"\xff"      # a byte that no UTF-8 text holds
_TABLE = _LOWERED.translate(bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", _BREAK * 10 + b" "))


def _words(texts: list[str]) -> list[bytes]:
    """The words of all texts in order, a break behind each piece."""
    blob = _BREAK.join([t.encode("utf-8", "surrogatepass").translate(_TABLE) for t in texts]) + _BREAK
    return blob.replace(_BREAK, b" \xff ").split()


def _portions(batches):
    """(language, texts) of about ``PIECE`` characters. A longer text is cut behind separators, which no
    phrase crosses."""
    for batch in batches:
        by_lang: dict[str, list[str]] = {}
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if text:
                by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            part, size = [], 0
            for text in texts:
                at = 0
                while at < len(text):
                    cut = _SEPARATOR.search(text, at + PIECE) if len(text) - at > PIECE else None
                    stop = cut.end() if cut else len(text)
                    if part and size + stop - at > PIECE:
                        yield lang, part
                        part, size = [], 0
                    part.append(text[at:stop])
                    size += stop - at
                    at = stop
            yield lang, part


# ---- words ------------------------------------------------------------------

def count_words(texts: DataFrame) -> DataFrame:
    """(lang, word, a): occurrences of every word of every language."""
    def run(batches):
        worker_table("collocations")
        held: dict[str, Counter] = {}

        def emit():
            for lang, counts in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.binary()).cast(pa.string()),
                     pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "a"])
            held.clear()

        for lang, part in _portions(batches):
            counts = held.setdefault(lang, Counter())
            counts.update(_words(part))
            del counts[_BREAK]
            if sum(map(len, held.values())) > WORDS_HELD:
                yield from emit()
        yield from emit()

    return (texts.mapInArrow(run, "lang string, word string, a long")
            .groupBy("lang", "word").agg(F.sum("a").alias("a")))


def _least_count(table: DataFrame, size: int, floor: int) -> int:
    """The lowest count, ``floor`` or more, that at most ``size`` rows of ``table`` reach, from a histogram of
    counts: exact below 256, then in steps of 1/64 octave."""
    a = F.col("a")
    step = F.when(a < 256, a).otherwise(F.floor(F.log2(a.cast("double")) * 64) - 256)
    rows = (table.where(a >= floor).groupBy(step.alias("step"))
            .agg(F.min("a").alias("low"), F.count(F.lit(1)).alias("n")).orderBy(F.desc("low")).collect())
    n, least = 0, 1 << 62
    for r in rows:
        n += r.n
        if n > size:
            break
        least = r.low
    return least


def hash_key(bits: int) -> Column:
    """The key of a word that is not numbered: negative, and not ``NONE``."""
    return F.lit(-2) - F.xxhash64("lang", "word").bitwiseAND(F.lit((1 << bits) - 1))


class Vocabulary:
    """Keys of the frequent words: numbers by frequency for the top ones, hashes for the others."""

    def __init__(self, words: DataFrame, min_count: int, ranked: int, bits: int):
        least = _least_count(words, ranked, min_count)
        keyed = words.withColumn("key", hash_key(bits))
        # words that share their hash with a frequent one: as good as none with 62 bits
        shared = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("a").alias("most"))
                  .where((F.col("n") > 1) & (F.col("most") >= min_count)).select("key"))
        twins = keyed.where(F.col("a") < least).join(shared, "key", "left_semi").select("lang", "word", "a")
        # at most ``ranked`` words and the twins, numbered in one partition
        local = materialize(words.where(F.col("a") >= least).unionByName(twins).repartition(1)
                            .sortWithinPartitions(F.desc("a"), "lang", "word")
                            .withColumn("number", F.when(F.col("a") >= min_count, F.monotonically_increasing_id())
                                        .otherwise(F.lit(NONE))), "numbers")
        found = local.orderBy("lang", "word").toArrow()
        self.bits = bits
        number = found.column("number").to_numpy()
        self.size = int((number != NONE).sum())
        self.by_lang = {}
        langs = found.column("lang").to_pylist()
        edges = [k for k in range(len(langs)) if k == 0 or langs[k] != langs[k - 1]] + [len(langs)]
        for at, stop in zip(edges, edges[1:]):
            listed = found.column("word").slice(at, stop - at).to_pylist()
            self.by_lang[langs[at]] = " ".join(listed).encode(), number[at:stop]
        none = F.array().cast("array<long>")
        self.table = materialize(
            words.where(F.col("a") >= min_count).join(local.drop("a"), ["lang", "word"], "left")
            .select("lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a",
                    none.alias("first"), none.alias("rest"), F.coalesce("number", hash_key(bits)).alias("k1")), "words")


class _Keys(dict):
    """The key of each word of a language. ``learn`` adds those that are not numbered, in bounded number."""

    def __init__(self, lang: str, known: tuple[bytes, np.ndarray] | None, bits: int, frequent: np.ndarray):
        import xxhash

        super().__init__(zip(known[0].split(b" "), known[1].tolist()) if known else ())
        self[_BREAK] = NONE
        self.mask, self.frequent, self.others = (1 << bits) - 1, frequent, []
        self.digest, self.seed = xxhash.xxh64_intdigest, xxhash.xxh64_intdigest(lang.encode(), 42)

    def learn(self, words: list[bytes]) -> None:
        if len(self.others) > REMEMBERED:
            for word in self.others:
                del self[word]
            self.others = []
        new = [w for w in set(words) if w not in self]
        if new:
            key = np.array([-2 - (self.digest(w, self.seed) & self.mask) for w in new], np.int64)
            key[~_marked(self.frequent, key[:, None])] = NONE
            self.update(zip(new, key.tolist()))
            self.others += new


# ---- the bitmap of frequent keys ------------------------------------------------

def _mixed(keys: np.ndarray) -> np.ndarray:
    """One hash for each row of ``keys``."""
    h = np.zeros(len(keys), np.uint64)
    for column in keys.T:
        h = (h ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(32)
    return h


def _marked(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    h = _mixed(keys) & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[h >> np.uint64(6)] >> (h & np.uint64(63)) & np.uint64(1)).astype(bool)


def key_bitmap(table: DataFrame, columns: list[str], bits: int) -> np.ndarray:
    """A bit for the hash of every row's keys; 2 ** ``bits`` bits whatever the size of ``table``."""
    def run(batches):
        for batch in batches:
            h = _mixed(np.stack([batch.column(c).to_numpy() for c in columns], axis=1)) & np.uint64((1 << bits) - 1)
            h = np.unique(h)
            cell = (h >> np.uint64(6)).astype(np.int64)
            if len(cell):
                start = np.flatnonzero(np.diff(cell, prepend=-1))
                value = np.bitwise_or.reduceat(np.uint64(1) << (h & np.uint64(63)), start)
                yield pa.RecordBatch.from_arrays([pa.array(cell[start]), pa.array(value.view(np.int64))],
                                                 names=["cell", "value"])

    found = (table.select(*columns).mapInArrow(run, "cell long, value long")
             .groupBy("cell").agg(F.bit_or("value").alias("value")).toArrow())
    out = np.zeros(1 << max(bits - 6, 0), np.uint64)
    out[found.column("cell").to_numpy()] = found.column("value").to_numpy().view(np.uint64)
    return out


# ---- tiles ------------------------------------------------------------------------

class TileCounts:
    """Counts of (left, right) pairs of numbers: dense tables for tiles with many pairs, else sorted COO."""

    def __init__(self, lefts: int, rights: int):
        self.across = -(-rights // SIDE)
        self.size = max(-(-lefts // SIDE) * self.across, 1)
        self.slot: np.ndarray | None = None  # dense table of each tile, -1 for none
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        cell = (left % SIDE * SIDE + right % SIDE)
        code = (left // SIDE * self.across + right // SIDE) * (SIDE * SIDE) + cell
        if self.slot is None:
            tile, n = np.unique(code // (SIDE * SIDE), return_counts=True)
            dense = tile[np.argsort(-n)[:TILES]]
            dense = dense[np.sort(n)[::-1][:TILES] >= SIDE * SIDE // 8]
            self.slot = np.full(self.size, -1, np.int32)
            self.slot[dense] = np.arange(len(dense))
            self.tiles = dense
            self.cells = np.zeros(len(dense) * SIDE * SIDE, np.int64)
        slot = self.slot[code // (SIDE * SIDE)]
        inside = slot >= 0
        if inside.any():
            address = slot[inside].astype(np.int64) * (SIDE * SIDE) + cell[inside]
            self.cells += np.bincount(address, minlength=len(self.cells))
        coo = np.unique(code[~inside], return_counts=True)
        self.held.append(coo)
        self.waiting += len(coo[0])

    def full(self) -> bool:
        """Whether the COO entries, merged, are too many to hold."""
        if self.waiting > 2 * CHUNK:
            self.held = [_merged(self.held)]
            self.waiting = len(self.held[0][0])
        return self.waiting > CHUNK

    def take(self, last: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(left, right, count) of the COO entries, and at the ``last`` call of the dense tables."""
        if last and self.slot is not None and len(self.tiles):
            at = np.flatnonzero(self.cells)
            self.held.append((self.tiles[at // (SIDE * SIDE)] * (SIDE * SIDE) + at % (SIDE * SIDE), self.cells[at]))
        code, n = _merged(self.held) if self.held else (np.zeros(0, np.int64),) * 2
        self.held, self.waiting = [], 0
        tile, cell = code // (SIDE * SIDE), code % (SIDE * SIDE)
        return tile // self.across * SIDE + cell // SIDE, tile % self.across * SIDE + cell % SIDE, n


class RowCounts:
    """Counts of rows of keys, as sorted COO."""

    def __init__(self):
        self.held, self.waiting = [], 0

    def add(self, keys: np.ndarray) -> None:
        if len(keys):
            self.held.append(_merged_rows([(keys, np.ones(len(keys), np.int64))]))
            self.waiting += len(self.held[-1][1])

    def full(self) -> bool:
        if self.waiting > CHUNK // 2:
            self.held = [_merged_rows(self.held)]
            self.waiting = len(self.held[0][1])
        return self.waiting > CHUNK // 4

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys, n = _merged_rows(self.held) if self.held else (np.zeros((0, 1), np.int64), np.zeros(0, np.int64))
        self.held, self.waiting = [], 0
        return keys, n


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted COO of several: equal codes once, with the sum of their counts."""
    code, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    start = np.flatnonzero(np.diff(code, prepend=-1))
    return code[start], (np.add.reduceat(n, start) if len(start) else n)


def _merged_rows(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The same for rows of keys."""
    keys, n = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort(keys.T)
    keys, n = keys[order], n[order]
    start = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])) if len(keys) else []
    return keys[start], (np.add.reduceat(n, start) if len(start) else n)


class Numbered:
    """The most frequent phrases of a size, all of whose words are numbered, by the number of
    their first words and that of the last."""

    def __init__(self, counts: DataFrame, size: int, shorter, words: int, ranked: int, min_count: int):
        columns = [f"k{j + 1}" for j in range(size)]
        plain = counts.where(F.least(*columns, F.lit(1 << 62)) >= 0)
        least = _least_count(plain, ranked, min_count)
        top = plain.where(F.col("a") >= least).orderBy(F.desc("a"), *columns).select(*columns).toArrow().to_pandas()
        if shorter is not None:
            first = pd.DataFrame(shorter.keys, columns=columns[:-1]).assign(number=np.arange(len(shorter.keys)))
            top = top.merge(first, on=columns[:-1], how="inner")
        number = top["number"] if shorter is not None else top["k1"]
        code = number.to_numpy(np.int64) * words + top[columns[-1]].to_numpy(np.int64)
        self.keys = top[columns].to_numpy(np.int64).reshape(-1, size)
        self.by_code = np.argsort(code)
        self.code = code[self.by_code]

    def find(self, code: np.ndarray) -> np.ndarray:
        """The number of the phrase with each ``code``, -1 for none."""
        if not len(self.code):
            return np.full(len(code), -1)
        place = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[place] == code, self.by_code[place], -1)


def count_phrases(texts: DataFrame, size: int, vocabulary: Vocabulary, maps: list[np.ndarray],
                  numbered: list[Numbered], min_count: int) -> DataFrame:
    """(k1 ... k``size``, a) of the phrases of ``size`` words that occur ``min_count`` times.

    ``maps`` are the bitmaps of the frequent words and phrases below that size, ``numbered`` the
    numbered phrases of each size from 2 below it."""
    words = vocabulary.size
    sent = texts.sparkSession.sparkContext.broadcast((vocabulary.by_lang, vocabulary.bits, maps, numbered))
    columns, name = [f"k{j + 1}" for j in range(size)], uuid.uuid4().hex

    def run(batches):
        by_lang, bits, maps, numbered = sent.value
        memory = worker_table("collocations")
        if memory.get(NONE) != name:
            memory.clear()
            memory[NONE] = name
        tiles = TileCounts(len(numbered[-1].keys) if numbered else words, words)
        rows = RowCounts()

        def count(w: np.ndarray):
            may, number = w != NONE, np.maximum(w, -1)
            for j in range(2, size):
                may = may[:-1] & may[1:]
                at = np.flatnonzero(may)
                may[at] = _marked(maps[j - 1], np.stack([w[at + x] for x in range(j)], axis=1))
                left, right = number[:len(may)], w[j - 1:]
                plain = may & (left >= 0) & (right >= 0)
                number = np.full(len(may), -1)
                number[plain] = numbered[j - 2].find(left[plain] * words + right[plain])
            may = may[:-1] & may[1:]
            left, right = number[:len(may)], w[size - 1:]
            plain = may & (left >= 0) & (right >= 0)
            tiles.add(left[plain], right[plain])
            at = np.flatnonzero(may & ~plain)
            rows.add(np.stack([w[at + x] for x in range(size)], axis=1))

        def emit(last: bool):
            if last or tiles.full():
                left, right, n = tiles.take(last)
                first = numbered[-1].keys if numbered else np.arange(words)[:, None]
                for a in range(0, len(n), EMIT):
                    part = slice(a, a + EMIT)
                    yield _batch(np.concatenate([first[left[part]], right[part, None]], axis=1), n[part], columns)
            if last or rows.full():
                keys, n = rows.take()
                for a in range(0, len(n), EMIT):
                    yield _batch(keys[a:a + EMIT], n[a:a + EMIT], columns)

        held, waiting = [], 0
        for lang, part in _portions(batches):
            if lang not in memory:
                for other in list(memory)[LANGUAGES:]:
                    del memory[other]
                memory[lang] = _Keys(lang, by_lang.get(lang), bits, maps[0])
            found = _words(part)
            memory[lang].learn(found)
            held.append(np.fromiter(map(memory[lang].__getitem__, found), np.int64, len(found)))
            waiting += len(found)
            if waiting >= CHUNK:
                count(np.concatenate(held))
                held, waiting = [], 0
                yield from emit(False)
        if waiting >= size:
            count(np.concatenate(held))
        yield from emit(True)

    return (texts.mapInArrow(run, ", ".join(f"{c} long" for c in [*columns, "n"]))
            .groupBy(*columns).agg(F.sum("n").alias("a")).where(F.col("a") >= min_count))


def _batch(keys: np.ndarray, n: np.ndarray, columns: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in keys.T), pa.array(n)],
                                      names=[*columns, "n"])


# ---- scores ---------------------------------------------------------------------------

def _with_parts(counts: DataFrame, size: int, shorter: DataFrame) -> DataFrame:
    """Phrases of ``size`` words with language, text and the counts of all their first and last words:
    (lang, phrase, last, a, first, rest, k1 ...); ``shorter`` has the same of the phrases a word shorter."""
    span = range(size - 1)
    out = counts
    for side, fields, offset in (("head", ("lang", "phrase", "a", "first"), 1), ("tail", ("last", "a", "rest"), 2)):
        part = shorter.select(*(F.col(c).alias(f"{side}_{c}") for c in fields),
                              *(F.col(f"k{j + 1}").alias(f"{side}_k{j + 1}") for j in span))
        on = [F.col(f"k{j + offset}") == F.col(f"{side}_k{j + 1}") for j in span]
        if size == 2:
            # numbered words may be hot, but they are few and sent to the tasks; hashes spread the others
            numbered, own = F.col(f"k{offset}") >= 0, F.col(f"{side}_k1") >= 0
            out = (out.where(numbered).join(F.broadcast(part.where(own)), on)
                   .unionByName(out.where(~numbered).join(part.where(~own), on)))
        else:
            out = out.join(part, on)
    return out.select(F.col("head_lang").alias("lang"), F.concat_ws(" ", "head_phrase", "tail_last").alias("phrase"),
                      F.col("tail_last").alias("last"), "a", F.concat("head_first", F.array("head_a")).alias("first"),
                      F.concat(F.array("tail_a"), "tail_rest").alias("rest"), *(f"k{j + 1}" for j in range(size)))


def _without_contained(phrases: DataFrame, size: int, longer: DataFrame, share: int) -> DataFrame:
    """The phrases that no phrase of one word more holds in ``share`` percent of their occurrences. A longer one
    cannot occur more often than those of its parts that hold the phrase, so it need not be asked."""
    keys = [f"k{j + 1}" for j in range(size)]
    parts = longer.select(F.explode(F.array(*(
        F.struct(*(F.col(f"k{j + 1 + at}").alias(keys[j]) for j in range(size))) for at in (0, 1)))).alias("part"), "a")
    most = parts.groupBy(*(F.col(f"part.{k}").alias(k) for k in keys)).agg(F.max("a").alias("most"))
    return (phrases.join(most, keys, "left")
            .where(F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * share)).drop("most"))


def _scored(phrases: DataFrame, size: int) -> DataFrame:
    """(lang, phrase, a, l, r, score) by the cut with the lowest score, the first of several."""
    def exact(c) -> Column:
        return c.cast("decimal(15,0)")

    a = exact(F.col("a"))
    cuts = [F.struct(F.call_function("div", F.lit(1000000).cast("decimal(7,0)") * (a * a),
                                     exact(F.col("first")[k]) * exact(F.col("rest")[k])).alias("score"),
                     F.lit(k).alias("k"), F.col("first")[k].alias("l"), F.col("rest")[k].alias("r"))
            for k in range(size - 1)]
    return (phrases.withColumn("cut", F.array_min(F.array(*cuts)))
            .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, share: int = 50, top: int = 2000, *,
                 lang_col: str = "lang", text_col: str = "text", ranked: int = RANKED,
                 hash_bits: int = HASH_BITS, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank (from 1), phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and these into words at spaces and
    tabs. A phrase of 2 to ``max_words`` words that occurs ``min_count`` times (a) is a candidate; the cut with the lowest
    ``floor(1000000 * a * a / (l * r))`` gives its score, l and r being the counts of its two parts. Candidates go whose words
    lie in a longer one that has ``share`` percent of their occurrences. n counts the words of the language. Order:
    score, then a, descending, then the phrase.

    A null language counts as ``und``, a null text as empty; repeated rows count each; texts are read whole,
    whatever their length; ids are not read and other columns left out, so none can clash. A table without
    candidates, an empty one among them, gives no rows. Counts up to 10^15 are exact. ``ranked``, ``hash_bits`` and ``filter_bits`` bound what
    is sent to the tasks and change no result.
    """
    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    words = materialize(count_words(texts), "word-counts")
    vocabulary = Vocabulary(words, min_count, ranked, hash_bits)
    maps, numbered, counts = [key_bitmap(vocabulary.table, ["k1"], filter_bits)], [], {}
    for size in range(2, max_words + 1):
        keys = [f"k{j + 1}" for j in range(size)]
        counts[size] = materialize(count_phrases(texts, size, vocabulary, maps, numbered, min_count), f"phrases-{size}")
        if size < max_words:
            maps.append(key_bitmap(counts[size], keys, filter_bits))
            numbered.append(Numbered(counts[size], size, numbered[-1] if numbered else None, vocabulary.size,
                                     ranked, min_count))
    found, shorter = None, vocabulary.table
    for size in range(2, max_words + 1):
        shorter = _with_parts(counts[size], size, shorter)
        if size < max_words:
            shorter = materialize(shorter, f"parts-{size}")
            kept = _without_contained(shorter, size, counts[size + 1], share)
        else:
            kept = shorter
        scored = _scored(kept, size)
        found = scored if found is None else found.unionByName(scored)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold most candidates: the first ones of each share of them, then of the language
    shares = Window.partitionBy("lang", "share").orderBy(*order)
    best = (found.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
            .withColumn("place", F.row_number().over(shares)).where(F.col("place") <= top)
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= top))
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
