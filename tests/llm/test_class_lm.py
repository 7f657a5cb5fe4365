import collections
import math
import zlib

import numpy as np
import pytest

from idweave.llm import class_lm as m


def brute_base(rows):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    count = collections.Counter()
    split = [((t or "").encode().lower().split() + [None]) for _, t in rows]
    for (i, _), words in zip(rows, split):
        if not held[i]:
            count.update(words)
    n, v = sum(count.values()), len(count)
    return sorted(((i, held[i], len(w), sum(count[x] > 0 for x in w), n,
                    round(sum(math.log10((count[x] + 1) / (n + v + 1)) for x in w), 6))
                   for (i, _), w in zip(rows, split)), key=repr)


def got_base(out):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                   for r in out), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"local": 300, "classed": 100, "exchanged": 30}])
def test_base_scores_and_a_better_model(documents, sizes):
    out = m.class_lm_scores(documents, rounds=6, **sizes).collect()
    assert got_base(out) == brute_base([(r.doc_id, r.text) for r in documents.collect()])
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_edges(edge, spark):
    out = m.class_lm_scores(edge, rounds=2).collect()
    assert got_base(out) == brute_base([(r.doc_id, r.text) for r in edge.collect()])
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    assert m.class_lm_scores(edge.where("false")).count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    held = spark.createDataFrame([(only, "a b c")], "doc_id long, text string")
    row = m.class_lm_scores(held).first()  # nothing to learn from
    assert (row.n_known, row.train_tokens, row.n_tokens) == (0, 0, 4) and row.score < 0


def test_probabilities_sum_to_one(spark):
    """Over all continuations of length one: every known word, unseen ones, and the end."""
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 7 != 2]
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    train = [(i, t) for i, t in zip(ids, ["a b", "b a c", "a", "c c d", "e"] * 9)]
    probe = [(held, w) for w in ("a", "b", "c", "d", "e", "unseen", "")]
    docs = spark.createDataFrame(train + probe, "doc_id long, text string")
    out = {}
    for r in m.class_lm_scores(docs, local=3, classed=2, exchanged=1, rounds=1).collect():
        if r.doc_id == held:
            out.setdefault(r.n_tokens, []).append(10 ** r.score)
    # each one-word text also pays for its end: the first word's probabilities sum to less than 1
    assert 0 < sum(out[2]) < 1 - out[1][0] + 1e-9


def test_hashes_do_not_depend_on_the_neighbourhood():
    texts = ["The quick  brown\tfox", "brown", "", "fox quick THE", "é" * 40 + " x" * 9]
    together, count = m.word_hashes(texts)
    alone = [m.word_hashes([t])[0] for t in texts]
    assert (together == np.concatenate(alone)).all() and count.tolist() == [4, 1, 0, 3, 10]
    big = "word another " * 800_000  # cut into pieces
    h, n = m.word_hashes([big, "word"])
    assert n.tolist() == [1_600_000, 1] and (h[::2] == h[0]).all() and len(np.unique(h)) == 2


def test_one_move_raises_the_likelihood_as_computed():
    rng = np.random.default_rng(0)
    pairs = rng.integers(0, 9, (12, 12)).astype(float)
    label = rng.integers(0, 4, 12)

    def grid(lab):
        g = np.zeros((4, 4))
        np.add.at(g, (lab[:, None].repeat(12, 1), lab[None].repeat(12, 0)), pairs)
        return g

    def value(lab):
        g = grid(lab)
        return m._xlogx(g).sum() - m._xlogx(g.sum(0)).sum() - m._xlogx(g.sum(1)).sum()

    for w in range(12):
        succ, pred = (np.bincount(label, x, 4) for x in (pairs[w], pairs[:, w]))
        best = m.best_class(label[w], succ, pred, pairs[w, w], grid(label))
        values = [value(np.where(np.arange(12) == w, c, label)) for c in range(4)]
        assert values[best] == pytest.approx(max(values))


def repeated(spark):
    """Texts of 240 words that occur twice or more, few of them often, and of some that occur once."""
    ids = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 != 2][:120]
    texts = [f"w{k % 3} r{k} v{k % 40} s{k} w{k % 2}" + (f" once{k}" if k % 5 == 0 else "") for k in range(120)]
    return spark.createDataFrame([*zip(ids, texts), *zip(ids, texts[60:] + [f"r{k} s{k}" for k in range(60)])],
                                 "doc_id long, text string")


def test_words_beyond_the_local_table_have_classes(spark):
    docs = repeated(spark)
    few, all_ = (sorted((r.doc_id, r.n_known, round(r.score, 6)) for r in m.class_lm_scores(
        docs, rounds=3, **local).collect()) for local in ({"local": 5}, {}))
    assert few == all_
    assert [m.class_count(n) for n in (0, 1000, 29_507, 166_347)] == [2, 10, 31, 55]


def captured(monkeypatch, docs, **options):
    """What the exchange was given and what it found."""
    seen, exchange = [], m.exchange

    def spy(stored, *rest):
        found = exchange(stored, *rest)
        rows = [m._unpacked(r.data) for r in stored.collect()]
        seen.append((sorted(int(x) for w, code, n in rows for x in n[code % 2 == 0]), found))
        return found

    monkeypatch.setattr(m, "exchange", spy)
    m.class_lm_scores(docs, **options).count()
    return seen[0]


def test_bigrams_are_those_of_the_corpus(spark, monkeypatch):
    docs = repeated(spark)
    texts = [r.text.split() for r in docs.collect()]
    count = collections.Counter(w for t in texts for w in t)
    known = [["", *(w if count[w] > 1 else None for w in t), ""] for t in texts]
    pairs = collections.Counter(p for t in known for p in zip(t, t[1:]))
    for options in ({}, {"exchanged": 4}):
        assert captured(monkeypatch, docs, rounds=1, **options)[0] == sorted(pairs.values())
        monkeypatch.undo()


def test_exchange_ends_when_the_likelihood_stays(spark, monkeypatch):
    docs = repeated(spark)
    value = []
    for options in ({"rounds": 1}, {"rounds": None}):
        value.append(m._likelihood(captured(monkeypatch, docs, **options)[1][1]))
        monkeypatch.undo()
    assert value[1] > value[0]


def test_words_outside_the_exchange_fit_both_sides():
    grid = np.array([[40., 2, 3], [1, 30, 4], [5, 2, 9]])  # the last class is the unclassed one
    succ, pred = np.array([[0., 5, 0], [4, 0, 0]]), np.array([[0., 5, 0], [4, 0, 0]])
    own = np.array([2, 2])
    assert m.best_classes(own, succ, pred, np.zeros(2), grid + 5, 2).tolist() == [1, 0]


def test_scores_are_those_of_a_plain_class_model(spark, monkeypatch):
    """Transitions and emissions counted in plain Python for the classes that were found."""
    found, exchange = [], m.exchange
    monkeypatch.setattr(m, "exchange", lambda *a: found.append(exchange(*a)) or found[0])
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    docs = repeated(spark).unionByName(spark.createDataFrame(
        [(held, "w1 R3 nowhere v2"), (held, "once0 w0 elsewhere elsewhere"), (held, None)], "doc_id long, text string"))
    got = sorted((r.n_tokens, round(r.score, 6)) for r in m.class_lm_scores(docs).collect())
    texts = [(r.doc_id, [*(r.text or "").lower().split(), None]) for r in docs.collect()]
    train = [t for i, t in texts if i != held]
    count = collections.Counter(w for t in train for w in t)
    often = [w for w in count if w is not None and count[w] > 1]
    often.sort(key=lambda w: (-count[w], int(m.word_hashes([w])[0].view(np.int64)[0])))
    label, classes = found[0][0].tolist(), m.class_count(len(often))
    of = dict(zip([*often, None], label))  # the end token is numbered after the words
    pairs = collections.Counter((of.get(a, classes), of.get(b, classes)) for t in train for a, b in zip([None, *t], t))
    ahead, tokens, kinds = (collections.Counter() for _ in range(3))
    for (a, b), n in pairs.items():
        ahead[a] += n
        tokens[b] += n
    for w in {*count, "a word never seen"}:
        kinds[of.get(w, classes)] += 1
    total = sum(tokens.values())

    def chance(a, b):
        a, k = of.get(a, classes), of.get(b, classes)
        share = (tokens[k] + 1) / (total + classes + 1)
        step = (pairs[a, k] + m.ALPHA * share) / (ahead[a] + m.ALPHA)
        return step * (count[b] + 1) / (tokens[k] + kinds[k])

    want = sorted((len(t), round(sum(math.log10(chance(a, b)) for a, b in zip([None, *t], t)), 6)) for _, t in texts)
    assert [n for n, _ in got] == [n for n, _ in want]
    assert np.allclose([x for _, x in got], [x for _, x in want], atol=2e-6)
    for before in (None, often[0], "a word never seen"):
        mass = sum(chance(before, w) for w in {*count, "a word never seen"})
        empty = set(range(classes + 1)) - {of.get(w, classes) for w in count}
        assert mass <= 1 + 1e-9 and (empty or mass == pytest.approx(1))
