import hashlib

import public_tokenizers
import pytest
from test_decontaminate import brute as brute_windows
from test_simhash import brute_fingerprint, brute_labels
from test_substring_dedup import brute as brute_repeats
from tokenizers import Tokenizer

import corpus_pipeline as p
import numpy as np
from idweave.llm.quality import quality_scores

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in p.STAGES:
        path = p.scratch_path(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_columns_and_names(steps):
    assert [n for n, _ in p.STAGES] == ["quality", "near_duplicates", "repeated_passages", "benchmark", "tokens"]
    for before, after in steps[:-1]:
        assert after.schema == before.schema
        assert all(r.n_chars == len(r.text) for r in after.collect())


def test_quality(steps, spark):
    before, after = steps[0]
    scores = quality_scores(before, spark.read.parquet(f"{SF}/labels.parquet"))
    assert sorted(r.doc_id for r in scores.collect() if r.predicted) == sorted(i for i, _ in texts(after))


def test_near_duplicates(steps):
    before, after = steps[1]
    rows = sorted(texts(before))
    fp = np.array([brute_fingerprint(t, 4) for _, t in rows], np.uint64)
    keep = set(brute_labels(fp, 4, [i for i, _ in rows]))
    assert sorted(texts(after)) == [r for r in rows if r[0] in keep]


def test_repeated_passages(steps):
    before, after = steps[2]
    want = {r[0]: r[4] for r in brute_repeats(texts(before), 200)}
    rows = texts(after)
    assert sorted(want) == sorted(i for i, _ in rows)
    exact = sum(hashlib.sha256(t.encode()).hexdigest() == want[i] for i, t in rows)
    assert exact >= len(rows) - 5  # a cut may go through a character, which then is dropped


def test_benchmark(steps, spark):
    before, after = steps[3]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in brute_windows(texts(before), items) if not r[-1]}
    assert sorted(texts(after)) == sorted(r for r in texts(before) if r[0] in clean)


def test_tokens(steps):
    before, after = steps[4]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r.doc_id: r for r in after.collect()}
    for i, t in texts(before):
        want = library.encode(t, add_special_tokens=False).ids
        assert ids[i].ids == want and ids[i].n_tokens == len(want)


def test_run_is_the_stages(steps, spark):
    assert sorted(map(tuple, p.run(spark, SF).select("doc_id", "ids_sha256").collect())) == sorted(
        map(tuple, steps[-1][1].select("doc_id", "ids_sha256").collect()))


def test_edge_rows_pass_every_stage(spark, edge, tmp_path):
    docs = edge.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "cast(length(text) AS long) AS n_chars")
    for name, stage in p.STAGES:
        empty = stage(spark, docs.where("false"), SF)
        assert empty.count() == 0
        out = stage(spark, docs, SF)
        rows = out.collect()
        if name != "tokens":
            assert out.columns == docs.columns and len(rows) <= docs.count()
        else:
            assert len(rows) == docs.count()


def test_clashing_columns_pass_every_stage(spark, edge):
    docs = edge.selectExpr("*", "'en' AS lang", "'s' AS source", "cast(length(text) AS long) AS n_chars",
                           "1 AS `a.b`", "2 AS carry_", "map('k', 1) AS tags")
    for name, stage in p.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and all(r.tags == {"k": 1} and r["a.b"] == 1 for r in out.collect())
    assert p.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_of_repeated_rows_the_first_by_its_other_columns_stays(spark):
    rows = [(1, "one and the same text here", s) for s in "cab"] + [(2, "some other words of no likeness", "z")]
    for order in (rows, rows[::-1]):
        out = p.near_duplicates(spark, spark.createDataFrame(order, "doc_id long, text string, source string").repartition(3), SF)
        assert sorted(map(tuple, out.select("doc_id", "source").collect())) == [(1, "a"), (2, "z")]
