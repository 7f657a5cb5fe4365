import random
import re
from collections import Counter

import numpy as np
import pytest

from idweave.llm import collocations as c


def brute(rows, max_words=3, min_count=10, share=50, top=2000):
    n, f = Counter(), {}
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(ch.lower() if "A" <= ch <= "Z" else ch for ch in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for m in range(1, max_words + 1):
                for k in range(len(w) - m + 1):
                    f.setdefault(lang, Counter())[tuple(w[k:k + m])] += 1
    out = []
    for lang, counts in f.items():
        found = []
        often = {x: a for x, a in counts.items() if len(x) > 1 and a >= min_count}
        for x, a in often.items():
            m = len(x)
            if any(len(y) > m and 100 * b >= share * a and any(y[k:k + m] == x for k in range(len(y) - m + 1))
                   for y, b in often.items()):
                continue
            score, k = min((10 ** 6 * a * a // (counts[x[:k]] * counts[x[k:]]), k) for k in range(1, m))
            found.append((-score, -a, " ".join(x).encode(), counts[x[:k]], counts[x[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed=1, size=150):
    random.seed(seed)
    common = ["The", "of", "a", "new", "york", "city", "hot", "dog", "é", "日本", "\x1c", "a-b", "O'x"]
    rows = []
    for _ in range(size):
        parts = []
        for _ in range(random.randint(0, 30)):
            parts.append(random.choice(["new york city", "hot dog", "San Francisco", random.choice(common),
                                        f"w{random.randint(0, 60)}"]))
            parts.append(random.choice([" ", " ", " ", "\t ", ". ", ",", "\n", "\x0b", "\r"]))
        rows.append((random.choice(["en", "de", None, "und"]), "".join(parts)))
    return rows + [("en", None), ("fr", ""), ("en", "hot dog " * 2000), (None, "x" * 5000), ("de", " . ! "),
                   ("en", rows[0][1]), ("en", rows[0][1])]


def run(spark, rows, **options):
    docs = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows],
                                 "lang string, text string, doc_id int, k1 int, a int, rank int")
    return sorted(tuple(r) for r in c.collocations(docs, **options).collect())


@pytest.mark.parametrize("options", [
    {}, {"ranked": 5, "filter_bits": 8, "hash_bits": 6}, {"ranked": 0}, {"ranked": 20, "hash_bits": 3, "filter_bits": 6}],
    ids=["all numbered", "few numbered, hashes shared", "none numbered", "most hashes shared"])
def test_against_brute_force(spark, options):
    rows = texts()
    want = brute(rows)
    assert len(want) > 30 and run(spark, rows, **options) == want


@pytest.mark.parametrize("ranked", [1 << 18, 7])
def test_longer_phrases_and_other_bounds(spark, ranked):
    rows = texts(2)
    want = brute(rows, max_words=4, min_count=5, share=80, top=25)
    assert run(spark, rows, max_words=4, min_count=5, share=80, top=25, ranked=ranked) == want


def test_small_chunks_change_nothing(spark, monkeypatch):
    rows = texts(3)
    want = brute(rows)
    small = {"CHUNK": 64, "PIECE": 40, "EMIT": 8, "SIDE": 2, "TILES": 2, "WORDS_HELD": 3, "REMEMBERED": 2, "LANGUAGES": 2}
    usual = {k: getattr(c, k) for k in small}
    real = c.DataFrame.mapInArrow

    def in_task(fn, batches):
        # a task takes the sizes from its own import of the module
        try:
            for k, v in small.items():
                setattr(c, k, v)
            yield from fn(batches)
        finally:
            for k, v in usual.items():
                setattr(c, k, v)

    for k, v in small.items():
        monkeypatch.setattr(c, k, v)
    monkeypatch.setattr(c.DataFrame, "mapInArrow", lambda df, fn, schema: real(df, lambda b: in_task(fn, b), schema))
    assert run(spark, rows, ranked=30) == want


def test_tiles_against_counting():
    rng = np.random.default_rng(4)
    tiles, want = c.TileCounts(2000, 3000), Counter()
    got = Counter()
    for k in range(6):
        left, right = (np.minimum(rng.zipf(1.3, 60_000), n) - 1 for n in (2000, 3000))
        tiles.add(left, right)
        want.update(zip(left.tolist(), right.tolist()))
        if k == 3:
            for a, b, n in zip(*(x.tolist() for x in tiles.take(False))):
                got[a, b] += n
    assert len(tiles.tiles) > 0
    for a, b, n in zip(*(x.tolist() for x in tiles.take(True))):
        got[a, b] += n
    assert got == want


def test_exact_beyond_64_bits(spark):
    phrases = spark.createDataFrame([("x", "p q", 3_000_000_000, [3_000_000_001], [3_000_000_007])],
                                    "lang string, phrase string, a long, first array<long>, rest array<long>")
    a = 3_000_000_000
    assert c._scored(phrases, 2).first().score == 10 ** 6 * a * a // ((a + 1) * (a + 7)) == 999999


def test_no_rows_without_candidates(spark):
    assert run(spark, [("en", "once only"), (None, None)]) == []
    assert run(spark, [("en", "x y " * 50)], min_count=1000) == []
    assert c.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
