"""BPE encoding and decoding by content-defined chunk reuse.

1. A rolling hash over the last 16 characters cuts every text where its low
   bits are zero. The cuts depend on content only, so a passage that
   documents share is cut alike in each, whatever stands before it.
2. A chunk's interior runs from its first to its last *agreement point*: a place
   behind ASCII white space. Each distinct interior is encoded once per
   worker (bounded table) and reused for every document that holds it. A new one is put
   together at the agreement points within it, so that only words new to
   the worker reach the tokenizer.
3. The joins are then repaired: what lies between two interiors is encoded anew together with
   the nearest word of either. Where its ids begin and end with those that the interiors have there,
   both sides agree exactly and the ids between are those of the join. Where they do not, the
   context grows to 2, 4, ... words; if even the whole interiors do not agree, the
   text is encoded whole. A chunk without an agreement point belongs to the join.

A tokenizer is refused unless no token, special token or normalisation of it can reach over
white space, which is what makes an interior's encoding independent of its surroundings.

Documents are never shuffled: a worker's table is the only thing they share.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import os

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import id_text, worker_table

CUT_BITS = 9              # a cut every 2**9 = 512 characters on average
MEMORY_WORDS = 400_000    # words in a generation of a worker's memory, which keeps two;
CHUNK_CHARS = 32          # and for each, characters of chunk interiors it remembers
WORD_CHARS = 40           # a longer word is not remembered
_MULT = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(128, bool)
_SPACE[[9, 10, 13, 32]] = True
_SPLITS = {"Whitespace", "WhitespaceSplit", "BertPreTokenizer"}
_NORMAL = {"NFC", "NFD", "NFKC", "NFKD", "Lowercase", "StripAccents"}


def rolling_cuts(cp: np.ndarray, bits: int = CUT_BITS) -> np.ndarray:
    """Places where the hash of the 16 characters before is 0 in its top bits."""
    n = len(cp)
    if n <= 16:
        return np.zeros(0, np.int64)
    h = cp.astype(np.uint64) * _MULT
    h ^= h >> np.uint64(29)
    mult = _MULT
    for step in (1, 2, 4, 8):  # hash of the last 2, 4, 8, 16 characters
        h = h[step:] * mult + h[:-step]
        with np.errstate(over="ignore"):
            mult = mult * mult
    return np.flatnonzero(h >> np.uint64(64 - bits) == 0) + 16


def _parts(step: dict | None, many: str) -> list[dict]:
    if step is None:
        return []
    return step[many] if step["type"] == "Sequence" else [step]


def _holds_no_space(pattern: str) -> bool:
    """Whether no match of ``pattern`` holds white space, in any string of up to four characters
    of every kind. What looks around itself is not judged, and so refused."""
    if "(?" in pattern or "\\b" in pattern.lower():
        return False
    find = regex.compile(pattern)
    for size in range(1, 5):
        for text in itertools.product("ast'1._ \n\t\r" if size < 4 else "s'1. \n", repeat=size):
            if any(c in " \t\r\n" for m in find.finditer("".join(text)) for c in m[0]):
                return False
    return True


def check_tokenizer(spec: dict) -> None:
    """Raise ValueError unless texts may be taken apart behind ASCII white space."""
    model = spec["model"]
    if model["type"] != "BPE" or model.get("dropout"):
        raise ValueError("the model is not a plain BPE")
    for n in _parts(spec.get("normalizer"), "normalizers"):
        # a run of spaces may become one: it yields no token either way
        if n["type"] not in _NORMAL and not (n["type"] == "Replace" and n["pattern"] == {"Regex": "\\s+"}
                                             and n["content"] == " "):
            raise ValueError(f"a normalizer may reach over white space: {n['type']}")
    split = _parts(spec.get("pre_tokenizer"), "pretokenizers")
    first, rest = (split[0], split[1:]) if split else ({"type": None}, [])
    pattern = first.get("pattern", {}).get("Regex")
    if first["type"] not in _SPLITS and not (
            first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]
            and pattern and _holds_no_space(pattern)):
        raise ValueError(f"tokens may reach over white space: {first['type']}")
    if any(p["type"] not in _SPLITS | {"Split", "Digits", "Punctuation", "ByteLevel"} or p.get("add_prefix_space")
           for p in rest):
        raise ValueError("a pre-tokenizer may add to words")
    for t in spec.get("added_tokens") or ():
        if t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(" \t\r\n"):
            raise ValueError(f"an added token may reach over white space: {t['content']!r}")


def _words(text: str) -> list[str]:
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def _tail(text: str, k: int) -> str:
    """The last ``k`` words of an interior, with the white space it ends with."""
    near = 64 * k
    while True:
        part = text[-near:]
        words = _words(part)
        if len(words) > k + 1:
            return part[-sum(map(len, words[-k - 1:])) - k:]
        if len(part) == len(text):
            return text
        near *= 8


def _head(text: str, k: int) -> str:
    """The first ``k`` words of an interior, with the white space behind them."""
    near = 64 * k
    while True:
        words = _words(text[:near])
        if len(words) > k:
            return text[:sum(map(len, words[:k])) + k]
        if near >= len(text):
            return text
        near *= 8


def _begins(ids: str, part: str) -> bool:
    return not part or ids == part or ids.startswith(part + " ")


def _ends(ids: str, part: str) -> bool:
    return not part or ids == part or ids.endswith(" " + part)


def _between(left: str, right: str, before: str, behind: str, ids: str) -> str | None:
    """The ids of a join, of ``ids`` for it and its context, which has ``before`` and ``behind``
    alone; None if they do not agree with the interiors' ids ``left`` and ``right`` in at least one id on either side."""
    if (left and not before) or (right and not behind) or len(before) + len(behind) > len(ids):
        return None
    if not (_ends(left, before) and _begins(right, behind) and _begins(ids, before) and _ends(ids, behind)):
        return None
    return ids[len(before):len(ids) - len(behind)].strip(" ")


class ChunkCodec:
    def __init__(self, path: str, memory_words: int = MEMORY_WORDS):
        self.memory_words = memory_words
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tk = Tokenizer.from_file(path)
        self.tk.no_truncation()
        self.tk.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        check_tokenizer(spec)
        self.plain = spec.get("decoder") is None
        size = max(self.tk.get_vocab(with_added_tokens=True).values()) + 1
        self.number = [str(i) for i in range(size)]
        self.token = {str(i): self.tk.id_to_token(i) for i in range(size)}
        self.cache: dict[str, str] = {}  # chunk interior -> its ids as text
        self.joins: dict[tuple[str, str, str], str] = {}  # word, join, word -> ids of the three
        self.held = 0
        self.young: dict[str, str] = {}  # word -> its ids as text, in two generations
        self.old: dict[str, str] = {}

    def pieces(self, text: str) -> list[str]:
        """Interiors and the joins between them, in turn; together they are the text. A join is
        empty where the cut is an agreement point itself."""
        cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        cuts = rolling_cuts(cp)
        agree = np.flatnonzero(_SPACE[np.minimum(cp, 127)]) + 1 if len(cuts) else cuts
        if not len(agree):
            return [text]
        # the agreement points next to each cut; a join reaches from one to the other
        at = np.searchsorted(agree, cuts, side="right")
        first = np.where(at > 0, agree[np.maximum(at - 1, 0)], 0)
        last = np.where(at < len(agree), agree[np.minimum(at, len(agree) - 1)], len(cp))
        last = np.where(first == cuts, first, last)
        # joins that meet are one
        new = np.flatnonzero(np.diff(first, prepend=-1) * (np.append(-1, last[:-1]) < first))
        edges = np.column_stack([first[new], last[np.append(new[1:], len(first)) - 1]]).ravel().tolist()
        return [text[a:b] for a, b in zip([0, *edges], [*edges, len(text)])]

    def encode(self, texts: list[str]) -> list[str]:
        """The ids of each text, as decimals joined by a space."""
        split = [self.pieces(t) for t in texts]
        new = dict.fromkeys(p for ps in split for p in ps[::2] if p not in self.cache)
        cut = [_words(p) for p in new]
        near = [[(_tail(a, 1), w, _head(b, 1)) for a, w, b in zip(ps[::2], ps[1::2], ps[2::2])] for ps in split]
        joins = list(dict.fromkeys(j for js in near for j in js if j not in self.joins))
        context = {x for js in near for j in js for x in (j[0], j[2])}
        self._learn(set().union(*cut, *map(_words, context)))
        ids = self.young.__getitem__
        context = {x: _spaced(map(ids, _words(x))) for x in context}
        fresh = {p: _spaced(map(ids, words)) for p, words in zip(new, cut)}
        number = self.number
        anew = {j: " ".join([number[i] for i in e.ids]) for j, e in zip(
            joins, self.tk.encode_batch_fast(["".join(j) for j in joins], add_special_tokens=False))}
        out = []
        for text, ps, js in zip(texts, split, near):
            done = [fresh[p] if p in fresh else self.cache[p] for p in ps[::2]]
            found = [_between(done[k], done[k + 1], context[j[0]], context[j[2]],
                              anew[j] if j in anew else self.joins[j])
                     for k, j in enumerate(js)]
            for k, x in enumerate(found):
                if x is None:
                    found[k] = self._grown(*ps[2 * k:2 * k + 3], *done[k:k + 2])
            if None in found:
                out.append(" ".join([number[i] for i in self.tk.encode(text, add_special_tokens=False).ids]))
                continue
            order = [done[0]]
            for x, y in zip(found, done[1:]):
                order += (x, y)
            out.append(_spaced(order))
        for table, more, size in ((self.cache, fresh, len), (self.joins, anew, lambda j: sum(map(len, j)))):
            for p, v in more.items():
                n = size(p)
                if n <= 4096:
                    if self.held > self.memory_words * CHUNK_CHARS:
                        self.cache.clear()
                        self.joins.clear()
                        self.held = 0
                    table[p] = v
                    self.held += n
        return out

    def _grown(self, before: str, join: str, behind: str, left: str, right: str) -> str | None:
        """The ids of a join with as much context as agrees; None if the whole interiors do not."""
        k, context = 1, None
        while context != (before, behind):
            k *= 2
            context = (_tail(before, k), _head(behind, k))
            self._learn({w for x in context for w in _words(x)})
            ids = self.tk.encode(context[0] + join + context[1], add_special_tokens=False).ids
            found = _between(left, right, *(_spaced(map(self.young.__getitem__, _words(x))) for x in context),
                             " ".join([self.number[i] for i in ids]))
            if found is not None:
                return found
        return None

    def _learn(self, words: set[str]) -> None:
        """Bring ``words`` into the young generation, new ones by the tokenizer."""
        if len(self.young) > self.memory_words:
            self.old = {w: v for w, v in self.young.items() if len(w) <= WORD_CHARS}
            self.young = {}
        missing = words - self.young.keys()
        known = missing & self.old.keys()
        for w in known:
            self.young[w] = self.old[w]
        new, number = list(missing - known), self.number
        for w, e in zip(new, self.tk.encode_batch_fast(new, add_special_tokens=False)):
            self.young[w] = " ".join([number[i] for i in e.ids])

    def decode(self, ids: str) -> str:
        """The decoded text of ids as text, special tokens kept."""
        if not self.plain:
            return self.tk.decode([int(i) for i in ids.split()], skip_special_tokens=False)
        # without a decoder the library joins the tokens by a space
        return " ".join(map(self.token.__getitem__, ids.split(" "))) if ids else ""


def _spaced(parts) -> str:
    """``parts`` joined by one space, empty ones left out; no token holds a space."""
    text = " ".join(parts)
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return " ".join(filter(None, text.split(" ")))
    return text


def load(path: str, memory_words: int = MEMORY_WORDS) -> ChunkCodec:
    codecs = worker_table("bpe_codec")
    if (path, memory_words) not in codecs:
        codecs[path, memory_words] = ChunkCodec(path, memory_words)
    return codecs[path, memory_words]


_TYPES = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string",
          "decoded": "string", "decoded_sha256": "string"}
_ARROW = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32()), "ids_sha256": pa.string(),
          "decoded": pa.string(), "decoded_sha256": pa.string()}


def bpe_codec(docs: DataFrame, tokenizer_path: str,
              outputs: tuple[str, ...] = ("n_tokens", "ids", "decoded"), *,
              memory_words: int = MEMORY_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and ``outputs``, in that order.

    ``ids`` are those of the tokenizers library without special tokens added,
    ``decoded`` is its decoding with special tokens kept; the ``*_sha256``
    columns digest them where they arise (ids as decimals joined by a space), so
    that a caller who needs digests only moves no ids. Null and empty texts have no
    ids and decode to the empty string; a null id stays null; repeated rows and
    very long texts are encoded whole; other columns are left out. ``memory_words``
    bounds what a worker remembers (about 600 bytes for each) and changes no result.
    """
    outputs = tuple(outputs)
    want_text = any(o.startswith("decoded") for o in outputs)
    schema = ", ".join(["doc_id long", *(f"{o} {_TYPES[o]}" for o in outputs)])

    def run(batches):
        codec = load(tokenizer_path, memory_words)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                cols = {o: [] for o in outputs}
                for ids in codec.encode(part.column("text").to_pylist()):
                    text = codec.decode(ids) if want_text else None
                    for o in outputs:
                        cols[o].append(
                            (ids.count(" ") + 1 if ids else 0) if o == "n_tokens"
                            else np.array(ids.split(), np.int32) if o == "ids"
                            else hashlib.sha256(ids.encode()).hexdigest() if o == "ids_sha256"
                            else text if o == "decoded"
                            else hashlib.sha256(text.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(cols[o], _ARROW[o]) for o in outputs)],
                    names=["doc_id", *outputs])

    return id_text(docs, id_col, text_col).mapInArrow(run, schema)
