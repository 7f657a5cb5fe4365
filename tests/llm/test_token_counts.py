import random

import public_tokenizers
import pytest
import sentencepiece

from idweave.llm.token_counts import count_symbols, load, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_counts_are_the_librarys(spark, documents, edge, library):
    for docs in (documents, edge):
        rows = token_counts(docs, MODEL, limit=100).collect()
        texts = sorted((r.doc_id, r.text or "") for r in docs.fillna(-1, ["doc_id"]).collect())
        want = sorted((i, len(t.encode()), len(library.encode(t))) for i, t in texts)
        assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_tokens) for r in rows) == want
        assert all(r.over_limit == (r.n_tokens > 100) for r in rows)


def test_random_texts(library):
    random.seed(5)
    alphabet = list(" ▁  abcthe é́\n\t!'日本\U0001F600\x00 ſ") + ["<s>", "<0x0A>", "ing"]
    counter = load(MODEL)
    for _ in range(1500):
        text = "".join(random.choice(alphabet) for _ in range(random.randint(0, 50)))
        assert counter.count(text) == len(library.encode(text)), repr(text)


def test_lowest_rank_and_leftmost_first():
    assert count_symbols("aaa", {"a": 0, "aa": 1.0}) == 2
    assert count_symbols("abc", {"a": 0, "b": 0, "c": 0, "bc": 1.0, "ab": 2.0}) == 2
    assert count_symbols("é", {}) == 2


def test_empty_table(spark, edge):
    assert token_counts(edge.where("false"), MODEL).count() == 0
