"""Sentencepiece ids and texts from a table of last tokens.

For byte-pair merging every prefix of a text has one encoding, and that of a longer prefix is the
encoding of a shorter one with one token behind it. So a table with the last token of every
prefix holds the encoding of all of them.

1. An automaton over the pieces reports which of them end at a place.
2. A piece is the last token of the prefix if it can stand behind the last token of the
   prefix before it: ``PieceModel.together`` takes both apart in the reverse order of their
   merges and asks at each step whether merging across their border would have come first. Exactly one
   piece passes.
3. The ids are read off the table from its end backwards.

A character that no piece holds stays alone and gives its UTF-8 bytes. Texts are cut into units
``▁*[^▁]*`` (no piece has a space mark behind another character, which ``PieceModel`` verifies, so
no token crosses a unit's start), and each worker keeps the ids of short units in a bounded memory.
Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_text, worker_table

MARK = "▁"
MEMORY_UNITS = 250_000  # short units in each of two generations that a worker remembers
MEMORY_PAIRS = 200_000  # pairs of tokens whose compatibility it remembers
UNIT_CHARS = 48         # a longer unit is encoded anew each time
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6  # kinds of pieces in the model file, fixed values
NEVER = float("inf")

_UNITS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class PieceModel:
    """The pieces of a byte-pair model, how each is merged, and which may be neighbours."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm, spec = model.normalizer_spec, model.trainer_spec
        kinds = [p.type for p in model.pieces]
        self.number = {p.piece: k for k, p in enumerate(model.pieces) if p.type == NORMAL}
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        words = [p for p in self.rank if p.strip(MARK)]
        if (spec.model_type != 2 or not spec.byte_fallback or norm.name != "identity"
                or not norm.add_dummy_prefix or not norm.escape_whitespaces
                or norm.remove_extra_whitespaces or norm.precompiled_charsmap
                or spec.treat_whitespace_as_suffix or {*kinds} - {NORMAL, UNKNOWN, CONTROL, BYTE}
                or any(re.search(f"[^{MARK}]{MARK}", p) for p in self.rank)
                or len({self.rank[p] for p in words}) != len(words)
                or {c for p in self.rank for c in p} - self.rank.keys()):
            raise ValueError("expected a byte-pair model with byte fallback and identity normalisation, with "
                             "different scores of words, space marks only at the start of a piece and every "
                             "character of a piece a piece itself")
        byte = {p.piece: k for k, p in enumerate(model.pieces) if p.type == BYTE}
        self.byte = [byte[f"<0x{b:02X}>"] for b in range(256)]
        self.bos, self.eos = spec.bos_id, spec.eos_id
        # what an id adds to a decoded text; control ids add nothing
        self.surface = [p.piece.replace(MARK, " ").encode() if p.type == NORMAL
                        else bytes([int(p.piece[3:5], 16)]) if p.type == BYTE
                        else spec.unk_surface.encode() if p.type == UNKNOWN else b"" for p in model.pieces]
        self.words = frozenset(self.number.values())
        self.parts = {}  # piece -> the two tokens whose merge makes it
        for piece in self.rank:
            if len(piece) > 1:
                halves = self._last_merge(piece)
                if halves:
                    self.parts[piece] = halves
        self.formed = {p: self.rank[p] if len(p) > 1 else -NEVER for p in self.rank
                       if len(p) == 1 or p in self.parts}
        # runs of space marks may share a score: of equal merges the one further left comes first
        if any(self.formed[h] > self.formed[p] or (self.formed[h] == self.formed[p] and p.strip(MARK))
               for p, halves in self.parts.items() for h in halves):
            raise ValueError("expected every piece to be merged after its parts")
        self.automaton = ahocorasick.Automaton()
        for piece in self.formed:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.known: dict[tuple[str, str], bool] = {}

    def _last_merge(self, piece: str) -> tuple[str, str] | None:
        """The two symbols that merging ``piece`` alone joins last, None if it never becomes one."""
        symbols = list(piece)
        while len(symbols) > 1:
            ranks = [self.rank.get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
            k = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[k] == NEVER:
                return None
            if len(symbols) == 2:
                return symbols[0], symbols[1]
            symbols[k:k + 2] = [symbols[k] + symbols[k + 1]]
        return None

    def together(self, left: str, right: str) -> bool:
        """Whether ``left`` and ``right`` as neighbours both survive all merges."""
        key = (left, right)
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= MEMORY_PAIRS:
                self.known.clear()
            found = self.known[key] = self._together(left, right)
        return found

    def _together(self, left: str, right: str) -> bool:
        formed, rank = self.formed, self.rank
        left_used = right_used = NEVER  # when the symbol at the border goes into a larger one
        while True:
            across = rank.get(left + right)
            # of equal merges the one further left comes first
            if across is not None and across < left_used and across <= right_used:
                return False
            a, b = formed[left], formed[right]
            if a == b == -NEVER:
                return True
            if a > b:
                left_used, left = a, self.parts[left][1]
            else:
                right_used, right = b, self.parts[right][0]

    def last_tokens(self, s: str) -> list[str]:
        """For each prefix of ``s`` (from the first character on) the last token of its encoding."""
        last: list[str | None] = [None] * len(s)
        formed, together = self.formed, self.together
        for end, piece in self.automaton.iter(s):
            if last[end] is not None:
                continue
            before = end - len(piece)
            if before < 0:
                last[end] = piece
                continue
            token = last[before]
            if token is None:  # no piece ends there: a character without one
                token = last[before] = s[before]
            if token not in formed or together(token, piece):
                last[end] = piece
        return [c if t is None else t for t, c in zip(last, s)]

    def tokens(self, s: str) -> list[str]:
        last = self.last_tokens(s)
        out, at = [], len(s) - 1
        while at >= 0:
            out.append(last[at])
            at -= len(last[at])
        out.reverse()
        return out

    def ids(self, s: str) -> list[int]:
        out = []
        for token in self.tokens(s):
            k = self.number.get(token)
            if k is None:
                out.extend(self.byte[b] for b in token.encode())
            else:
                out.append(k)
        return out


class PieceCodec(dict):
    """``codec[unit]`` = ids of ``MARK + unit``, 4 bytes each, little-endian; the dict and ``old`` are the memory."""

    def __init__(self, path: str):
        super().__init__()
        self.model = PieceModel(path)
        self.old: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.old.get(unit)
        if ids is None:
            ids = np.array(self.model.ids(MARK + unit), "<u4").tobytes()
        if len(unit) <= UNIT_CHARS:
            if len(self) >= MEMORY_UNITS:
                self.old = dict(self)
                self.clear()
            self[unit] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """All ids of ``text`` between the begin and the end id."""
        marked = text.replace(" ", MARK)
        if not text:
            inner = b""
        elif MARK * 2 not in marked and marked[0] != MARK and marked[-1] != MARK:
            inner = b"".join(map(self.__getitem__, marked.split(MARK)))
        else:
            inner = b"".join([self[u[1:]] for u in _UNITS.findall(MARK + marked)])
        ends = np.array([self.model.bos, self.model.eos], "<u4").tobytes()
        return ends[:4] + inner + ends[4:]

    def decode(self, ids: bytes) -> str:
        """The text of ids: the space before it goes, bytes that are no UTF-8 become U+FFFD each."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        blob = b"".join(map(self.model.surface.__getitem__, numbers))
        if blob[:1] == b" " and next(k for k in numbers if self.model.surface[k]) in self.model.words:
            blob = blob[1:]
        try:
            return blob.decode()
        except UnicodeDecodeError:
            return _each_replaced(blob)


def _each_replaced(blob: bytes) -> str:
    out, at = [], 0
    while at < len(blob):
        try:
            out.append(blob[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(blob[at:at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


def load(path: str) -> PieceCodec:
    codecs = worker_table("piece_codec")
    if path not in codecs:
        codecs[path] = PieceCodec(path)
    return codecs[path]


_TYPES = {"n_tokens": ("long", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32())),
          "ids_sha256": ("string", pa.string()), "decoded": ("string", pa.string()),
          "decoded_sha256": ("string", pa.string())}


def piece_codec(docs: DataFrame, model_path: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"), *,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and ``outputs``, in that order.

    ``ids`` are those of the sentencepiece library with begin and end ids, ``decoded`` is the text
    that they decode to; the ``*_sha256`` columns digest them where they arise (ids as little-endian
    unsigned 32-bit integers). Null and empty texts have the begin and the end id and
    decode to the empty string; a null id stays null; repeated rows and texts of any length are
    encoded whole, in memory that grows with the longest unit; other columns are left out, so none can clash; an
    empty table gives no rows. ``model_path`` must be readable where the tasks run.
    """
    outputs = tuple(outputs)
    want_text = any(o.startswith("decoded") for o in outputs)
    schema = ", ".join(["doc_id long", *(f"{o} {_TYPES[o][0]}" for o in outputs)])

    def one(codec: PieceCodec, text: str) -> dict:
        ids = codec.encode(text)
        row = {"n_tokens": len(ids) // 4}
        if "ids" in outputs:
            row["ids"] = np.frombuffer(ids, "<i4")
        if "ids_sha256" in outputs:
            row["ids_sha256"] = hashlib.sha256(ids).hexdigest()
        if want_text:
            row["decoded"] = codec.decode(ids)
            if "decoded_sha256" in outputs:
                row["decoded_sha256"] = hashlib.sha256(row["decoded"].encode()).hexdigest()
        return row

    def run(batches):
        codec = load(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [one(codec, t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array([r[o] for r in rows], _TYPES[o][1]) for o in outputs)],
                    names=["doc_id", *outputs])

    return id_text(docs, id_col, text_col).mapInArrow(run, schema)
