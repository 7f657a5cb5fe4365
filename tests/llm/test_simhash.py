import numpy as np
import pytest
import xxhash
from llm_helpers import rows_of

from idweave.llm import simhash as s


def brute_fingerprint(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def brute_labels(fp, bits, names):
    """Smallest name reachable by links."""
    label = list(names)
    near = np.array([np.bitwise_count(f ^ fp) <= bits for f in fp])
    while True:
        new = [min(label[j] for j in np.flatnonzero(near[i])) for i in range(len(fp))]
        if new == label:
            return label
        label = new


@pytest.mark.parametrize("cell", [s.CELL, 4])
def test_documents(documents, cell):
    rows = s.simhash_components(documents, 4, 4, cell=cell).orderBy("doc_id").collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    fp = [brute_fingerprint(texts[r.doc_id], 4) for r in rows]
    assert [r.fingerprint for r in rows] == [f"{f:016x}" for f in fp]
    assert [r.component_id for r in rows] == brute_labels(np.array(fp, np.uint64), 4, [r.doc_id for r in rows])


def test_edges(edge):
    rows = s.simhash_components(edge).collect()
    assert len(rows) == edge.count()
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert {r.component_id for r in zero} == {0} and len(zero) == 4  # null, empty, blank, null without id


def test_native_hash_is_the_same(spark):
    got = spark.sql("SELECT xxhash64('one two three four') AS h").first().h
    assert got % (1 << 64) == s.fingerprint("One two\nthree FOUR", 4)


@pytest.mark.parametrize("seed", range(8))
def test_index_against_all_pairs(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 500))
    fp = rng.integers(0, 2**63, 4, dtype=np.uint64)[rng.integers(0, 4, n)]
    for _ in range(int(rng.integers(1, 7))):
        fp ^= np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
    fp = np.unique(fp)
    a, b = s.spanning_links(np.zeros(len(fp), int), fp, 4)
    labels = brute_labels(fp, 4, range(len(fp)))
    assert len(a) == len(fp) - len(set(labels))
    place = {int(f): k for k, f in enumerate(fp)}
    assert all(labels[place[int(x)]] == labels[place[int(y)]] for x, y in zip(a, b))


def test_patterns_cover_every_pair():
    rng = np.random.default_rng(1)
    for bits, blocks in ((4, 5), (4, 6), (3, 4), (4, 7)):
        masks = [m % (1 << 64) for m in s.pattern_masks(bits, blocks)]
        for _ in range(200):
            diff = sum(1 << int(k) for k in rng.choice(64, bits, replace=False))
            assert any(diff & m == 0 for m in masks)


def test_chain_links_through_others(spark):
    base = 0x0123456789ABCDEF
    chain = [base ^ ((1 << 3 * k) - 1) for k in range(12)]
    fps = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in chain], "fp long")
    roots = s.connected_components(s.near_links(fps, 4))
    assert len({r.root for r in roots.collect()}) == 1 and roots.count() == 11


def test_search_for_links_is_planned_once(spark, monkeypatch):
    from idweave.llm import graph

    plans, store = [], graph.materialize
    monkeypatch.setattr(graph, "materialize", lambda df, name: (
        plans.append(df._jdf.queryExecution().optimizedPlan().toString()), store(df, name))[1])
    fps = spark.createDataFrame([(1,), (3,), (7,), (255 << 40,)], "fp long")
    assert s.connected_components(s.near_links(fps, 2)).count() == 2
    assert sum(p.count("MapInArrow") for p in plans) == 1


def test_empty_table(edge):
    assert rows_of(s.simhash_components(edge.where("false"))) == []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_keys_are_dealt_and_joined_once(spark, how):
    from pyspark.sql import functions as F

    from idweave.llm.common import join_counted
    rows = spark.range(3000).select(F.col("id").alias("row"), F.when(F.col("id") < 1000, 7).otherwise(
        F.col("id") % 400).cast("long").alias("k"))
    table = rows.where("k <> 9").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("row").alias("most"))
    got = join_counted(rows, table, ["k"], 3000, ["row"], how)
    assert sorted(got.columns) == ["k", "most", "row"]
    assert rows_of(got.select("row", "k", "most")) == rows_of(rows.join(table.drop("n"), "k", how).select("row", "k", "most"))
    assert join_counted(rows.where("false"), table, ["k"], 0, ["row"]).count() == 0
