import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from idweave.llm import piece_codec as c

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return c.PieceCodec(MODEL)


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def agree(codec, library, text):
    ids = library.encode(text, add_bos=True, add_eos=True)
    assert codec.encode(text) == as_bytes(ids), repr(text)
    assert codec.decode(as_bytes(ids)) == library.decode(ids), repr(text)


def test_ids_and_texts_are_the_librarys(spark, documents, edge, library):
    outputs = ("n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256")
    for docs in (documents, edge):
        got = sorted((tuple(r) for r in c.piece_codec(docs, MODEL, outputs).collect()), key=repr)
        want = []
        for r in docs.collect():
            ids = library.encode(r.text or "", add_bos=True, add_eos=True)
            text = library.decode(ids)
            want.append((r.doc_id, len(ids), ids, text, hashlib.sha256(as_bytes(ids)).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest()))
        assert got == sorted(want, key=repr)


def test_random_texts(codec, library):
    random.seed(7)
    odd = list(" ▁  abcthe é́\n\t!'日本\U0001F600\x00 ſ") + ["<s>", "</s>", "<unk>", "<0x0A>", "    ", " " * 17, "aaaa", "===="]
    pieces = list(codec.model.rank)
    for _ in range(1500):
        agree(codec, library, "".join(random.choice(odd) for _ in range(random.randint(0, 50))))
        agree(codec, library, "".join(random.choice(pieces) for _ in range(random.randint(0, 12))))
        agree(codec, library, "".join(random.choice("aeinrst") for _ in range(random.randint(0, 60))))


def test_any_ids_decode_as_the_library_does(codec, library):
    random.seed(8)
    for _ in range(1000):
        ids = [random.choice([random.randint(0, 31999), random.randint(0, 260)]) for _ in range(random.randint(0, 12))]
        assert codec.decode(as_bytes(ids)) == library.decode(ids), ids


def merged(symbols, rank):
    """Byte-pair merging as it is defined, one merge after another."""
    while True:
        ranks = [rank.get(a + b) for a, b in zip(symbols, symbols[1:])]
        if not any(r is not None for r in ranks):
            return symbols
        k = min((r, k) for k, r in enumerate(ranks) if r is not None)[1]
        symbols = symbols[:k] + [symbols[k] + symbols[k + 1]] + symbols[k + 2:]


def test_last_tokens_of_all_prefixes(codec):
    rank = codec.model.rank
    for s in ("▁international", "▁aaaaaaaa", "▁▁▁the▁", "▁don't", "▁éèabc", "▁" * 40, "▁x日y"):
        assert codec.model.last_tokens(s) == [merged(list(s[:k]), rank)[-1] for k in range(1, len(s) + 1)]


def test_neighbours_stay_exactly_if_merging_keeps_them(codec):
    random.seed(9)
    short = [p for p in codec.model.rank if len(p) <= 4 and p.isascii()]
    for _ in range(4000):
        a, b = random.choice(short), random.choice(short)
        assert codec.model.together(a, b) == (merged(list(a + b), codec.model.rank) == [a, b]), (a, b)


def test_memory_may_be_small(codec, library, monkeypatch):
    monkeypatch.setattr(c, "MEMORY_UNITS", 3)
    monkeypatch.setattr(c, "MEMORY_PAIRS", 3)
    small = c.PieceCodec(MODEL)
    for text in ("one two three four one two five", "six seven one eight", "one two"):
        agree(small, library, text)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        c.PieceModel(str(path))


def test_empty_table(edge):
    assert c.piece_codec(edge.where("false"), MODEL).count() == 0
