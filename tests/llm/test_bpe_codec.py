import hashlib
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from idweave.llm import bpe_codec as b

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def check(docs, library):
    rows = b.bpe_codec(docs, PATH, ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")).collect()
    by_text = {}
    for r in docs.collect():
        by_text.setdefault(r.doc_id, []).append(r.text or "")
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append(r)
    assert {i: len(x) for i, x in got.items()} == {i: len(x) for i, x in by_text.items()}
    for i, texts in by_text.items():
        want = []
        for t in texts:
            ids = library.encode(t, add_special_tokens=False).ids
            text = library.decode(ids, skip_special_tokens=False)
            want.append((len(ids), ids, text, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest()))
        assert sorted(want) == sorted(tuple(r)[1:] for r in got[i])


def test_ids_and_texts_are_the_librarys(documents, edge, library):
    check(documents, library)
    check(edge, library)


def test_random_texts(library):
    random.seed(2)
    codec = b.ChunkCodec(PATH)
    parts = ["the ", "<|endoftext|>", "don't\n", " ", "é", "é", "Ça va ", "'re", "\t", "日本", "x" * 30, " ", "1 2"]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 600))) for _ in range(200)]
    for text, got in zip(texts, codec.encode(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert got == " ".join(map(str, ids)), repr(text)
        assert codec.decode(got) == library.decode(ids, skip_special_tokens=False)


def test_shared_passages_share_chunks():
    random.seed(4)
    words = ["".join(random.choice("abcdefgh") for _ in range(random.randint(2, 9))) for _ in range(3000)]
    passage = " ".join(words)
    codec = b.ChunkCodec(PATH)
    one, two = set(codec.pieces("start " + passage)), set(codec.pieces("another, longer start " + passage))
    assert len(one & two) > 0.8 * len(one)


def test_empty_table(edge):
    assert b.bpe_codec(edge.where("false"), PATH).count() == 0


def test_pieces_are_the_text_and_joins_lie_between():
    random.seed(5)
    codec = b.ChunkCodec(PATH)
    for chars in ("ab \n", "abcdefgh", "a  ", "xyz\t\r é"):
        text = "".join(random.choice(chars) for _ in range(20_000))
        pieces = codec.pieces(text)
        assert "".join(pieces) == text and len(pieces) % 2 == 1
        assert all(p and p[-1] in " \n\t\r" for p in pieces[2:-1:2])  # interiors end at agreement points


def test_a_join_that_does_not_agree_is_repaired(library):
    """A wrong id in the memory of words is noticed wherever such a word is next to a join."""
    random.seed(6)
    text = " ".join("".join(random.choice("abcdefgh") for _ in range(random.randint(2, 9))) for _ in range(3000))
    codec = b.ChunkCodec(PATH)
    pieces = codec.pieces(text)
    word = pieces[0].split()[-1]
    codec.young[word] = "7 7 7"
    assert codec.encode([text])[0] == " ".join(map(str, library.encode(text, add_special_tokens=False).ids))


def changed(**parts):
    with open(PATH, encoding="utf-8") as f:
        return json.load(f) | parts


@pytest.mark.parametrize("parts", [
    {"pre_tokenizer": None},
    {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}},
    {"pre_tokenizer": {"type": "Metaspace", "replacement": "_", "prepend_scheme": "always", "split": True}},
    {"pre_tokenizer": {"type": "Split", "pattern": {"Regex": " ?[a-z]+"}, "behavior": "Removed", "invert": True}},
    {"pre_tokenizer": {"type": "Split", "pattern": {"Regex": r"\S+(?=\s)"}, "behavior": "Removed", "invert": True}},
    {"normalizer": {"type": "Replace", "pattern": {"String": " "}, "content": "_"}},
    {"normalizer": {"type": "Prepend", "prepend": "_"}},
    {"added_tokens": [{"id": 1, "content": "<a b>", "single_word": False, "lstrip": False, "rstrip": False,
                       "normalized": False, "special": True}]},
    {"added_tokens": [{"id": 1, "content": "<a>", "single_word": False, "lstrip": True, "rstrip": False,
                       "normalized": False, "special": True}]}])
def test_tokenizers_that_reach_over_white_space_are_refused(parts):
    b.check_tokenizer(changed())
    with pytest.raises(ValueError):
        b.check_tokenizer(changed(**parts))
