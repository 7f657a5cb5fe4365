import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from idweave.llm import quality as q

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return q.quality_scores(docs, labels).join(labels, "doc_id").toPandas(), docs, labels


def test_held_out_accuracy(scored):
    rows = scored[0]
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows.doc_id]).all()
    out = rows[rows.held_out]
    good, bad = out.score[out.quality == 1].to_numpy(), out.score[out.quality == 0].to_numpy()
    auc = (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2
    assert auc > 0.97 and (out.predicted == out.quality).mean() > 0.95
    assert ((rows.score >= 0) & (rows.score <= 1)).all() and (rows.predicted == (rows.score >= 0.5)).all()


def test_held_out_labels_are_not_read(scored):
    rows, docs, labels = scored
    flip = labels.withColumn("quality", F.when(q.held_out(F.col("doc_id"), 3, 1), 1 - F.col("quality"))
                             .otherwise(F.col("quality")))
    again = q.quality_scores(docs, flip).toPandas().set_index("doc_id").score
    assert np.allclose(again[rows.doc_id].to_numpy(), rows.score.to_numpy())


def test_stage_keeps_what_is_predicted(scored):
    rows, docs, labels = scored
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    all_scores = q.quality_scores(docs, labels).where("predicted = 1")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in all_scores.collect())


def test_rules_are_the_trees_paths():
    debug = """RandomForestClassificationModel: numTrees=2
  Tree 0 (weight 1.0):
    If (feature 0 <= 1.5)
     If (feature 1 <= 0.25)
      Predict: 0.0
     Else (feature 1 > 0.25)
      Predict: 1.0
    Else (feature 0 > 1.5)
     Predict: 1.0
  Tree 1 (weight 1.0):
    If (feature 1 <= 0.5)
     Predict: 0.0
    Else (feature 1 > 0.5)
     Predict: 1.0
"""
    assert q.tree_rules(debug, ["a", "b"]) == [
        "a <= 1.5D", "a <= 1.5D AND b <= 0.25D", "a <= 1.5D AND b > 0.25D", "a > 1.5D", "b <= 0.5D", "b > 0.5D"]


def test_statistics():
    got = dict(zip(q.FEATURES, q.statistics("AB! ab ab\n")))
    assert got["upper"] == 0.2 and got["bang"] == 0.1 and got["newline"] == 0.1
    assert got["repeat_next"] == pytest.approx(1 / 3) and got["top_word"] == pytest.approx(2 / 3)
    assert all(np.isfinite(q.statistics(t)).all() for t in ("", " \n", "é" * 9, "x" * 100_000))


@pytest.mark.parametrize("rows", [[], [(1, 1), (2, 1), (2, 0), (None, 0), (4, None)], [(1, 0), (2, 0)]])
def test_edges(spark, edge, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    out = q.quality_scores(edge, labels).collect()
    assert len(out) == edge.count() and all(0 < r.score < 1 for r in out)
    assert q.quality_scores(edge.where("false"), labels).count() == 0
    assert set(q.keep_good(edge, labels).columns) == set(edge.columns)


def test_scores_are_those_of_the_rules_in_plain_python(spark, documents, monkeypatch):
    found, fit = [], q.fit_quality
    monkeypatch.setattr(q, "fit_quality", lambda *a: found.append(fit(*a)) or found[0])
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    scores = {r.doc_id: r.score for r in q.quality_scores(documents, labels).collect()}
    intercept, weights = found[0]
    assert weights

    def holds(rule, values):
        parts = [p.split() for p in rule.split(" AND ")]
        return all(values[f] <= float(x[:-1]) if op == "<=" else values[f] > float(x[:-1]) for f, op, x in parts)

    for r in documents.collect():
        values = dict(zip(q.FEATURES, q.statistics(r.text or "")))
        total = intercept + sum(w for rule, w in weights if holds(rule, values))
        assert scores[r.doc_id] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-9)
