"""Benchmark decontamination by a distributed positional inverted index.

1. *Index.* Every task cuts its documents into blocks of bounded size and stores, for
   each block, the postings of the test terms: ``term * span + position``, sorted,
   so a term's list is one contiguous run. Positions number the words of the block,
   with a gap between documents, so no phrase crosses a document. Terms that no
   test item holds are not stored. The blocks are written once under
   the checkpoint folder.
2. *Search.* A window of the test set starts from the block's list of its rarest
   term; the lists of the other terms, rarest first, are shifted by their offset
   and intersected with it. What is left are the exact phrase matches.
   For proximity every term may be off by up to ``slop`` words from its place, seen from the
   window's *anchor*: its longest term (in bytes), the first of several, which tends to be
   rare. So what is near depends neither on the blocks nor on the shards.

A block holds whole documents, so the search needs no shuffle. The test set is sent
to the tasks in shards of about ``shard_words`` words, one pass for each; an item longer than an
eighth of that is dealt out in pieces that share ``width - 1`` words, so no window is lost.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, materialize, worker_table

SHARD_WORDS = 2_000_000    # words of the test set sent to the tasks at a time
BLOCK_WORDS = 500_000    # a block ends with the document that reaches this
WINDOWS_AT_ONCE = 1024     # windows searched together, for bounded memory

# A-Z to a-z, every other byte that is no word byte to a space
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 97 <= b <= 122 or 48 <= b <= 57
               else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """Maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


@dataclass
class TestSet:
    """Distinct windows as rows of term numbers (-1 fills), and who holds them."""
    terms: dict[bytes, int]
    windows: np.ndarray
    items: list[list[str]]
    anchor: np.ndarray  # for each window, the place of its anchor

    @classmethod
    def of(cls, rows: list[tuple], width: int) -> "TestSet":
        terms: dict[bytes, int] = {}
        found: dict[tuple, set[str]] = {}
        for item, text in rows:
            w = [terms.setdefault(x, len(terms)) for x in words_of(text)]
            for i in range(max(1, len(w) - width + 1) if w else 0):
                found.setdefault(tuple(w[i:i + width]), set()).add(str(item))
        windows = np.full((len(found), width), -1, np.int32)
        for k, w in enumerate(found):
            windows[k, :len(w)] = w
        size = np.array([len(x) for x in terms] + [-1], np.int64)  # the last one serves the fills
        return cls(terms, windows, [sorted(x) for x in found.values()], size[windows].argmax(axis=1))


def build_index(docs: DataFrame, test: TestSet, slop: int = 0) -> DataFrame:
    """Blocks of documents with the postings of the test terms."""
    terms = docs.sparkSession.sparkContext.broadcast(test.terms)
    gap = _gap(test.windows, slop)

    def block(ids, lengths, found):
        lengths = np.array(lengths, np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths + gap)[:-1]])
        span = int(starts[-1] + lengths[-1] + gap)
        own = np.fromiter((t for d in found for t in d[1]), np.int64)
        at = np.fromiter((p for d in found for p in d[0]), np.int64)
        at += np.repeat(starts, [len(d[0]) for d in found])
        return {"doc_ids": ids, "lengths": lengths.tolist(), "span": span,
                "postings": np.sort(own * span + at).tobytes()}

    def run(batches):
        worker_table("decontaminate")
        number = terms.value.get
        ids, lengths, found, held = [], [], [], 0
        schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                            ("span", pa.int64()), ("postings", pa.binary())])
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").to_pylist()):
                t = np.array([number(w, -1) for w in words_of(text)], np.int32)
                at = np.flatnonzero(t >= 0)
                ids.append(doc_id)
                lengths.append(len(t))
                found.append((at, t[at]))
                held += len(t) + gap
                if held >= BLOCK_WORDS or len(ids) >= 4096:
                    yield pa.RecordBatch.from_pylist([block(ids, lengths, found)], schema)
                    ids, lengths, found, held = [], [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([block(ids, lengths, found)], schema)

    return docs.mapInArrow(
        run, "doc_ids array<long>, lengths array<long>, span long, postings binary")


def _gap(windows: np.ndarray, slop: int) -> int:
    """Places between two documents of a block: no match reaches from one to the other, its terms being off
    by ``slop`` on either side."""
    return windows.shape[1] + 2 * slop


def matches(postings: np.ndarray, span: int, windows: np.ndarray, n_terms: int, slop: int,
            anchor: np.ndarray | None = None):
    """(window, position) of every match, exact for ``slop`` 0. The lists are intersected from
    the rarest in the block, or from that of the ``anchor``."""
    first = np.searchsorted(postings, np.arange(n_terms + 1) * span)
    count = np.diff(first)
    out_w, out_p = [], []
    for lo in range(0, len(windows), WINDOWS_AT_ONCE):
        win = windows[lo:lo + WINDOWS_AT_ONCE]
        n = np.where(win >= 0, count[win], np.iinfo(np.int64).max)  # a fill never is the rarest
        alive = np.flatnonzero(n.min(axis=1) > 0)
        if anchor is not None:
            n[np.arange(len(win)), anchor[lo:lo + len(win)]] = -1
        order = np.argsort(n, axis=1, kind="stable")
        if not len(alive):
            continue
        rare = win[alive, order[alive, 0]]
        w = np.repeat(alive, count[rare])
        step = np.arange(len(w)) - np.repeat(np.cumsum(count[rare]) - count[rare], count[rare])
        p = postings[first[win[w, order[w, 0]]] + step] % span - order[w, 0]
        for k in range(1, win.shape[1]):
            offset = order[w, k]
            term = win[w, offset].astype(np.int64)
            lowest = np.maximum(p + offset - slop, 0)
            key = term * span + lowest
            hit = np.searchsorted(postings, key)
            found = postings[np.minimum(hit, len(postings) - 1)]
            ok = (term < 0) | ((hit < len(postings)) & (found >= key)
                               & (found <= term * span + np.minimum(p + offset + slop, span - 1))
                               & (p + offset + slop >= 0))
            w, p = w[ok], p[ok]
            if not len(w):
                break
        out_w.append(w + lo)
        out_p.append(p)
    empty = np.zeros(0, np.int64)
    return (np.concatenate(out_w) if out_w else empty), (np.concatenate(out_p) if out_p else empty)


def search_index(index: DataFrame, test: TestSet, slop: int = 0) -> DataFrame:
    """One row per document: doc_id, n_words, hit ranges, items (and near matches)."""
    sent = index.sparkSession.sparkContext.broadcast((test.windows, test.items, len(test.terms), test.anchor))

    def run(batches):
        windows, items, n_terms, anchor = sent.value
        size = (windows >= 0).sum(axis=1)
        schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()),
                            ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())),
                            ("items", pa.list_(pa.string())), ("n_near", pa.int64())])
        for batch in batches:
            for row in batch.to_pylist():
                postings = np.frombuffer(row["postings"], np.int64)
                span, lengths = row["span"], np.array(row["lengths"])
                base = np.concatenate([[0], np.cumsum(lengths + _gap(windows, slop))[:-1]])
                w, p = matches(postings, span, windows, n_terms, 0)
                doc = np.searchsorted(base, p, side="right") - 1
                near = np.zeros(len(lengths), np.int64)
                if slop:
                    nw, np_ = matches(postings, span, windows, n_terms, slop, anchor)
                    exact = np.isin(nw * (span + 1) + np_, w * (span + 1) + p)
                    # a match may begin up to ``slop`` places before its document
                    nd = np.searchsorted(base, np_[~exact] + slop, side="right") - 1
                    near = np.bincount(np.maximum(nd, 0), minlength=len(lengths))
                order = np.lexsort((p, doc))
                w, p, doc = w[order], p[order] - base[doc[order]], doc[order]
                edge = np.searchsorted(doc, np.arange(len(lengths) + 1))
                out = []
                for k, doc_id in enumerate(row["doc_ids"]):
                    own = slice(edge[k], edge[k + 1])
                    found = sorted({x for i in w[own].tolist() for x in items[i]})
                    out.append({"doc_id": doc_id, "n_words": int(lengths[k]),
                                "starts": p[own].tolist(), "ends": (p[own] + size[w[own]]).tolist(),
                                "items": found, "n_near": int(near[k])})
                yield pa.RecordBatch.from_pylist(out, schema)

    return index.mapInArrow(run, "doc_id long, n_words long, starts array<long>, "
                                 "ends array<long>, items array<string>, n_near long")


def _summary(found: DataFrame) -> DataFrame:
    """Merged hit ranges and the digest of the items, in column expressions."""
    spans = F.array_sort(F.arrays_zip("starts", "ends"))
    # sorted by start: a range adds what reaches beyond the furthest end before it
    covered = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["ends"] - F.greatest(s["starts"], a["end"]), F.lit(0).cast("long")))
            .alias("n"), F.greatest(a["end"], s["ends"]).alias("end")),
        lambda a: a["n"])
    return (found.withColumn("items", F.array_sort(F.array_distinct("items")))
            .select("doc_id", "n_words", covered.alias("n_hit"),
                    F.size("items").cast("long").alias("n_items"), "items",
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    (F.size("starts") > 0).alias("contaminated"),
                    F.arrays_zip("starts", "ends").alias("spans"), "n_near"))


def _pieces(tests: DataFrame, step: int, width: int) -> DataFrame:
    """Items of more than ``step`` windows in pieces, each window in one of them."""
    word = F.regexp_replace("text", r"[\x00-/:-@\[-`{-\x7f]+", " ")
    words = F.filter(F.split(word, " "), lambda w: w != "")
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - width, F.lit(0)), F.lit(step))
    return (tests.withColumn("words", words).withColumn("start", F.explode(starts))
            .select("item_id", F.array_join(F.expr(f"slice(words, start + 1, {step + width - 1})"), " ").alias("text")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, width: int = 10, slop: int = 0,
                  shard_words: int = SHARD_WORDS, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items,
    items_sha256, contaminated, spans (word ranges) and n_near (proximity matches
    that are not exact, for ``slop`` > 0: places of a window's anchor with every other term at most
    ``slop`` words off its place in the same document).

    Windows are ``width`` consecutive words of an item, or the whole item if it is
    shorter. Null and empty texts have no words: such documents have no hit, such
    items no window. Items of null id are left out, and items that share an id
    count as one. A null doc_id stays null, repeated documents are judged
    each, an empty benchmark marks nothing; other columns are left out.
    """
    spark = docs.sparkSession
    docs = id_text(docs, id_col, text_col)
    tests = benchmark.select(F.col(f"`{item_col}`").alias("item_id"),
                             F.col(f"`{item_text_col}`").cast("string").alias("text")).dropna()
    # words are apart by a byte at least, so a text of n bytes has at most n / 2 + 1
    size = int(tests.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0)
    shards = max(1, -(-size // shard_words))
    if shards > 1:
        tests = _pieces(tests, max(shard_words // 8, width), width)
    found = None
    for k in range(shards):
        own = tests.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == k)
        test = TestSet.of([tuple(r) for r in own.collect()], width)
        if shards > 1:  # repeated rows stay apart from others by their text
            part = docs.withColumn("text_id", F.xxhash64("text"))
            keys = part.groupBy("doc_id", "text_id").agg(F.count(F.lit(1)).alias("copies"),
                                                         F.first("text").alias("text"))
            keys = keys.select(F.monotonically_increasing_id().alias("row"), "doc_id", "copies", "text")
            if k == 0:
                keys = materialize(keys, "decontam_docs")
                whole = keys
            hits = search_index(materialize(build_index(
                whole.select(F.col("row").alias("doc_id"), "text"), test, slop), "postings"), test, slop)
        else:
            hits = search_index(materialize(build_index(docs, test, slop), "postings"), test, slop)
        found = hits if found is None else found.unionByName(hits)
    if shards > 1:
        merged = found.groupBy("doc_id").agg(
            F.max("n_words").alias("n_words"), F.flatten(F.collect_list("starts")).alias("starts"),
            F.flatten(F.collect_list("ends")).alias("ends"),
            F.flatten(F.collect_list("items")).alias("items"), F.sum("n_near").alias("n_near"))
        rows = whole.select(F.col("row"), F.col("doc_id").alias("own_id"), "copies")
        found = (merged.join(rows, merged.doc_id == rows.row)
                 .withColumn("doc_id", F.explode(F.expr("array_repeat(own_id, int(copies))")))
                 .drop("row", "own_id", "copies"))
    return _summary(found)
