"""Token counts without tokens: heap-and-linked-list byte-pair merging.

The vocabulary is a byte-pair model with byte fallback (sentencepiece
``.model``). A text is cut into units ``▁*[^▁]*``: no piece of such a model has a
space mark after another character, which ``load`` verifies, so no merge crosses
a unit's start. In a unit every character is a symbol of a doubly linked
list; a heap holds the adjacent pairs that form a piece, lowest rank first and
leftmost first among equals. Popping a pair that is still whole merges it.
The count is *initial symbols - merges*; a character that is no piece
and was never merged counts its UTF-8 bytes. Identifiers are never made.

Units repeat, so each worker keeps the counts of short units in a bounded table.
Nothing is shuffled.
"""

from __future__ import annotations

import heapq
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text, worker_table

MARK = "▁"
CACHE_UNITS = 500_000   # short units whose count a worker remembers
CACHE_CHARS = 48        # a longer unit is counted anew each time
NORMAL, USER_DEFINED = 1, 4

_UNITS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class UnitCounter(dict):
    """``counter[unit]`` = tokens of ``MARK + unit``; the dict is the memory."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, spec = model.normalizer_spec, model.trainer_spec
        pieces = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        plain = (spec.model_type == 2 and spec.byte_fallback and norm.name == "identity"
                 and norm.add_dummy_prefix and norm.escape_whitespaces
                 and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
                 and not spec.treat_whitespace_as_suffix
                 and not any(p.type == USER_DEFINED for p in model.pieces))
        if not plain or any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("expected a byte-pair model with byte fallback, identity "
                             "normalisation and space marks only at the start of a piece")
        super().__init__()
        self.rank = pieces

    def __missing__(self, unit: str) -> int:
        n = count_symbols(MARK + unit, self.rank)
        if len(unit) <= CACHE_CHARS:
            if len(self) >= CACHE_UNITS:
                self.clear()
            self[unit] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if MARK * 2 not in marked and marked[0] != MARK and marked[-1] != MARK:
            return sum(map(self.__getitem__, marked.split(MARK)))
        return sum(self[u[1:]] for u in _UNITS.findall(MARK + marked))


def count_symbols(s: str, rank: dict[str, float]) -> int:
    """Symbols left of ``s`` after all merges, an unknown character as its bytes."""
    n = len(s)
    if n == 1:
        return 1 if s in rank else len(s.encode())
    sym = list(s)
    prev = list(range(-1, n - 1))
    nxt = list(range(1, n + 1))
    heap = []
    for i in range(n - 1):
        r = rank.get(s[i:i + 2])
        if r is not None:
            heap.append((r, i, 2))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, size = heapq.heappop(heap)
        left = sym[i]
        j = nxt[i]
        if left is None or j >= n or len(left) + len(sym[j]) != size:
            continue  # one side was merged meanwhile
        sym[i] = left = left + sym[j]
        sym[j] = None
        merges += 1
        k = nxt[i] = nxt[j]
        if k < n:
            prev[k] = i
            r = rank.get(left + sym[k])
            if r is not None:
                heapq.heappush(heap, (r, i, len(left) + len(sym[k])))
        p = prev[i]
        if p >= 0:
            r = rank.get(sym[p] + left)
            if r is not None:
                heapq.heappush(heap, (r, p, len(sym[p]) + len(left)))
    extra = sum(len(c.encode()) - 1 for c in sym if c is not None and len(c) == 1 and c not in rank)
    return n - merges + extra


def load(path: str) -> UnitCounter:
    models = worker_table("token_counts")
    if path not in models:
        models[path] = UnitCounter(path)
    return models[path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, *,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.

    Null and empty texts have 0 bytes and 0 tokens; a null id stays null;
    repeated rows are counted each; any other column is left out, so none can
    clash. An empty table gives no rows. Texts of any length are counted whole.
    ``model_path`` must be readable where the tasks run.
    """
    @F.arrow_udf("long")
    def n_tokens(texts: pa.Array) -> pa.Array:
        counter = load(model_path)
        return pa.array([counter.count(t) for t in texts.to_pylist()], pa.int64())

    return (id_text(docs, id_col, text_col)
            .select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                    n_tokens("text").alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > F.lit(limit)))
