"""Exact top-k inner-product search: columnar branch and bound.

Vectors are scaled to integers and packed into blocks. A candidate block is
stored vertically, one run per dimension, dimensions of greatest mass first, with the
norm of what remains after every group of dimensions. Scores of a query against
a block accumulate group by group; a candidate whose score so far plus the bound on the rest
(Cauchy-Schwarz on the remaining norms) cannot reach the query's k-th best is
dropped, and the survivors are compacted before the next group.

The query blocks are dealt to every slice of the candidate blocks, a slice keeps only
its k best per query, and a ranked window merges the slices. No row pairs arise. Blocks
meet by a shuffle: copies of the query blocks for all slices, which grow with the product of
both, never pass through the driver as a broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, ship

BLOCK = 4096      # candidates of a block
QUERIES = 512     # queries of a block
GROUP = 16        # dimensions accumulated at a time
SEEDS = 64        # candidates scored in full first, for a first bound
STATES = 256      # query blocks whose best are held by a task at a time
WIDTHS = (np.int16, np.int32, np.float64)
EXACT = float(1 << 53)


def clean_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): vectors with an id and only finite components."""
    bad = F.exists("v", lambda x: F.coalesce(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(True)))
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
            .dropna().where(~bad))


def narrow(data: np.ndarray) -> bytes:
    """Whole numbers in the narrowest of ``WIDTHS`` that holds all of them."""
    low, high = (data.min(), data.max()) if data.size else (0, 0)
    for t in WIDTHS[:-1]:
        if np.iinfo(t).min <= low and high <= np.iinfo(t).max:
            return data.astype(t).tobytes()
    return data.tobytes()


def widen(data: bytes, n: int, dims: int) -> np.ndarray:
    """The numbers of ``narrow`` as float64, a row for each vector."""
    kind = next((t for t in WIDTHS if np.dtype(t).itemsize * n * dims == len(data)))
    return np.frombuffer(data, kind).reshape(n, dims).astype(np.float64)


def pack(vectors: DataFrame, scale: float, size: int) -> DataFrame:
    """Blocks (n, dims, ids, data) of floor(scale * v), row after row, ``data`` as ``narrow`` gives it."""
    schema = pa.schema([("n", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()),
                        ("data", pa.binary())])

    def block(ids, rows):
        dims = max(map(len, rows))
        data = np.zeros((len(rows), dims))
        for k, r in enumerate(rows):
            data[k, :len(r)] = r
        return pa.RecordBatch.from_pylist([{
            "n": len(ids), "dims": dims, "ids": np.array(ids, np.int64).tobytes(),
            "data": narrow(np.floor(scale * data))}], schema)

    def run(batches):
        ids, rows = [], []
        for batch in batches:
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                ids.append(i)
                rows.append(v)
                if len(ids) == size:
                    yield block(ids, rows)
                    ids, rows = [], []
        if ids:
            yield block(ids, rows)

    return vectors.mapInArrow(run, "n int, dims int, ids binary, data binary")


class Block:
    """A candidate block in vertical layout with remaining norms."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, dims = ids, rows.shape[1]
        self.order = np.argsort(-np.square(rows).sum(axis=0), kind="stable")
        self.columns = np.ascontiguousarray(rows[:, self.order].T)
        self.cuts = list(range(0, dims, GROUP)) + [dims]
        square = np.square(self.columns)
        self.rest = [np.sqrt(square[c:].sum(axis=0)) for c in self.cuts]
        self.top = float(np.abs(rows).max()) if rows.size else 0.0

    def search(self, queries: np.ndarray, own: np.ndarray, best: list, k: int) -> None:
        """Merge this block's candidates into ``best``: per query a list (scores, ids)."""
        dims = self.columns.shape[0]
        q = np.zeros((len(queries), dims))
        q[:, :min(dims, queries.shape[1])] = queries[:, :dims]
        q = q[:, self.order]
        if self.top * (np.abs(q).max() if q.size else 0) * max(dims, 1) >= EXACT:
            return self._exact(q, own, best, k)
        head = self.cuts[min(1, len(self.cuts) - 1)]
        first = q[:, :head] @ self.columns[:head]
        for r in range(len(q)):
            scores, ids = best[r]
            at = np.flatnonzero(self.ids != own[r])
            part = first[r, at]
            bound = scores[k - 1] if len(scores) >= k else -np.inf
            if len(at) > SEEDS:  # the k-th best of some full scores is a bound for all
                some = at[np.argpartition(-part, SEEDS)[:SEEDS]]
                full = np.sort(q[r] @ self.columns[:, some])[::-1]
                if len(full) >= k:
                    bound = max(bound, full[k - 1])
            for c in range(1, len(self.cuts)):
                lo = self.cuts[c]
                if c > 1:
                    part = part + q[r, self.cuts[c - 1]:lo] @ self.columns[self.cuts[c - 1]:lo, at]
                rest = np.sqrt(np.square(q[r, lo:]).sum()) * self.rest[c][at]
                keep = part + rest * (1 + 1e-9) + 0.5 >= bound
                if not keep.all():
                    at, part = at[keep], part[keep]
            self._merge(best, r, part, self.ids[at], k)

    def _exact(self, q, own, best, k):
        """Components so large that float64 sums are not exact: Python integers."""
        columns = [[int(x) for x in c] for c in self.columns.T]
        limit = 1 << 63
        for r in range(len(q)):
            row = [int(x) for x in q[r]]
            score = [max(-limit, min(limit - 1, sum(a * b for a, b in zip(row, c)))) for c in columns]
            ok = self.ids != own[r]
            self._merge(best, r, np.array(score, object)[ok], self.ids[ok], k)

    @staticmethod
    def _merge(best, r, score, ids, k):
        if not len(ids):
            return
        score, ids = np.concatenate([best[r][0], score]), np.concatenate([best[r][1], ids])
        order = sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))[:k] \
            if score.dtype == object else np.lexsort((ids, -score))[:k]
        best[r] = (score[order], ids[order])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, *,
          id_col: str = "vec_id", vector_col: str = "embedding", slices: int | None = None,
          block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` highest integer inner products
    of floor(scale * component) for every row of ``queries`` among the rows of
    ``vectors`` with another id; ties go to the smaller vec_id.

    Rows with a null id or vector, or a null, NaN or infinite component, take no part.
    Of vectors of unequal length the shorter counts as filled with zeros. Repeated
    rows are candidates each, and a repeated query row is answered each time.
    A score beyond a long is held at its limit. Fewer than k candidates
    give fewer rows; empty tables none; other columns are left out.
    """
    spark = vectors.sparkSession
    ship(spark)
    own, blocks = materialize(pack(clean_vectors(vectors, id_col, vector_col), scale, block), "vectors", count=True)
    ask, asked = materialize(pack(clean_vectors(queries, id_col, vector_col), scale, QUERIES)
                             .withColumn("q", F.monotonically_increasing_id()), "queries", count=True)
    # more slices than blocks would only copy the queries; a task holds the queries of one part
    slices = max(1, min(slices or int(spark.conf.get("spark.sql.shuffle.partitions")), blocks))
    parts = max(1, -(-2 * asked // STATES))

    def each(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    left = own.select(F.pmod(F.xxhash64("ids"), F.lit(slices)).cast("int").alias("slice"), each(parts, "part"), "n",
                      "dims", "ids", "data")
    right = ask.select(each(slices, "slice"), F.pmod(F.xxhash64("q"), F.lit(parts)).cast("int").alias("part"), "q",
                       F.col("n").alias("qn"), F.col("dims").alias("qdims"),
                       F.col("ids").alias("qids"), F.col("data").alias("qdata"))

    def run(batches):
        state: dict[int, tuple] = {}
        held: tuple = (None, None)

        def flush():
            q, n, i, v, s = [], [], [], [], []
            for key, (own_ids, best) in state.items():
                for r, (score, ids) in enumerate(best):
                    q += [key] * len(ids)
                    n += [r] * len(ids)
                    i += [int(own_ids[r])] * len(ids)
                    v += ids.tolist()
                    s += [int(x) for x in score]
            state.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (q, n, i, v, s)],
                names=["q", "place", "query_id", "vec_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if held[0] != (row["ids"], row["data"]):
                    rows = widen(row["data"], row["n"], row["dims"])
                    held = ((row["ids"], row["data"]), Block(np.frombuffer(row["ids"], np.int64), rows))
                ids = np.frombuffer(row["qids"], np.int64)
                if row["q"] not in state:
                    if len(state) >= STATES:
                        yield flush()
                    state[row["q"]] = (ids, [(np.zeros(0), np.zeros(0, np.int64))] * len(ids))
                held[1].search(widen(row["qdata"], row["qn"], row["qdims"]), ids, state[row["q"]][1], k)
        yield flush()

    found = left.join(right.hint("merge"), ["slice", "part"]).drop("slice", "part").mapInArrow(
        run, "q long, place long, query_id long, vec_id long, score long")
    order = Window.partitionBy("q", "place").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
