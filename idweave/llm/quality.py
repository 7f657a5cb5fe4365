"""Quality classifier: a sparse rule ensemble over text statistics.

1. Every whole text gives a row of statistics (shares of character classes, word
   lengths, repetition). They are the only inputs; they are written once.
2. A random forest is grown on a bounded sample of labelled rows
   (``sample_rows``, chosen by a hash of the id). Every path from a root to a node is a
   rule: a conjunction of comparisons.
3. A logistic regression with an L1 penalty weighs the rules; most weights become 0.
4. The rules left are compiled into one Spark column expression, so scoring is a
   projection over the statistics.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_text, materialize, worker_table

SAMPLE_ROWS = 20_000
FEATURES = ["log_bytes", "log_words", "word_bytes", "long_words", "short_words", "upper", "lower",
            "digit", "non_ascii", "space", "newline", "stop", "bang", "bar", "symbol", "other_mark",
            "repeat_next", "distinct", "top_word", "line_repeat", "word_bytes_dev", "bare_words"]

_CLASS = np.zeros(256, np.int64)  # classes by byte; 0: other marks
for _k, _bytes in enumerate([b"", bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)),
                             bytes(range(128, 256)), b" \t\r\x0b\x0c", b"\n", b".,;:?", b"!", b"|",
                             b"#$%&*+<=>@^_~/\\"]):
    _CLASS[list(_bytes)] = _k


def statistics(text: str) -> list[float]:
    """The statistics of one text, in the order of FEATURES; an empty text has zeros."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, w = max(len(raw), 1), max(len(words), 1)
    kind = np.bincount(_CLASS, np.bincount(np.frombuffer(raw, np.uint8), minlength=256), 11) / n
    size = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    # distinct words over the square root of all: does not fall with length alone
    return [math.log1p(len(raw)), math.log1p(len(words)), float(size.mean()),
            float((size > 14).sum() / w), float((size < 4).sum() / w), kind[1], kind[2], kind[3],
            kind[4], kind[5], kind[6], kind[7], kind[8], kind[9], kind[10], kind[0],
            sum(map(eq, words, words[1:])) / w, len(seen) / math.sqrt(w),
            max(seen.values(), default=0) / w, 1 - len(set(lines)) / max(len(lines), 1),
            float(size.std()), sum(map(bytes.isalpha, words)) / w]


def statistics_of(text: Column) -> Column:
    """A struct with one double per statistic of a text column."""
    @F.arrow_udf("struct<" + ", ".join(f"{f}: double" for f in FEATURES) + ">")
    def stats(texts: pa.Array) -> pa.Array:
        worker_table("quality")
        rows = np.zeros((len(texts), len(FEATURES)))
        for k, t in enumerate(texts):
            rows[k] = statistics(t.as_py() or "")
        return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(FEATURES))], FEATURES)

    return stats(text)


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves remainder ``part``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def tree_rules(debug: str, names: list[str]) -> list[str]:
    """Every root-to-node path of a forest's printed trees as an SQL condition."""
    rules, path = {}, []
    line = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([^)]+)\)")
    for text in debug.splitlines():
        if "Tree " in text:
            path = []
        m = line.match(text)
        if not m:
            continue
        depth, _, feature, op, value = len(m[1]), *m.groups()[1:]
        path = [p for p in path if p[0] < depth] + [(depth, f"{names[int(feature)]} {op} {value}D")]
        rules[" AND ".join(sorted(p[1] for p in path))] = None
    return list(rules)


def fit_rules(train: DataFrame, *, trees: int = 24, depth: int = 3, penalty: float = 0.002,
              seed: int = 7) -> tuple[float, list[tuple[str, float]]]:
    """(intercept, [(condition, weight)]) of ``train`` (statistics and ``label``).

    Without both labels there is nothing to separate: the intercept alone
    is the smoothed log odds of the labels that are there."""
    good, n = train.agg(F.sum("label"), F.count("label")).first()
    good = int(good or 0)
    if good in (0, n):
        return math.log((good + 1) / (n - good + 1)), []
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(train)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, maxBins=64, seed=seed,
                                    minInstancesPerNode=10, featureSubsetStrategy="sqrt").fit(rows)
    rules = tree_rules(forest.toDebugString, FEATURES)
    if not rules:
        return math.log((good + 1) / (n - good + 1)), []
    x = array_to_vector(F.array(*(F.expr(r).cast("double") for r in rules)))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60,
                               standardization=False).fit(train.select("label", x.alias("features")))
    weights = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]
    return float(lasso.intercept), weights


def rule_score(intercept: float, weights: list[tuple[str, float]], prefix: str = "") -> Column:
    """The ensemble as a column expression: probability of label 1. ``prefix`` stands before
    the names of the statistics."""
    total = F.lit(intercept)
    for rule, w in weights:
        rule = re.sub(r"\b(\w+) (<=|>) ", rf"{prefix}\1 \2 ", rule)
        total = total + F.when(F.expr(rule), F.lit(w)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def fit_quality(stats: DataFrame, labels: DataFrame, label_col: str, id_col: str, parts: int,
                part: int, sample_rows: int) -> tuple[float, list[tuple[str, float]]]:
    """The rule ensemble of the labelled rows of ``stats`` (doc_id and statistics)."""
    known = (labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                           F.col(f"`{label_col}`").cast("int").alias("mark")).dropna()
             .where(~held_out(F.col("doc_id"), parts, part))
             .groupBy("doc_id").agg((F.avg("mark") >= 0.5).cast("double").alias("label")))
    sample = (stats.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES)
              .limit(sample_rows))
    return fit_rules(materialize(sample, "quality_sample"))


def quality_scores(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality",
                   parts: int = 3, part: int = 1, sample_rows: int = SAMPLE_ROWS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Labels of held-out ids (crc32 of the id as text leaves ``part``) are never
    read for fitting, nor are null labels or ids; a document with several labels counts as
    1 if at least half of them are. At most ``sample_rows`` labelled rows are used for
    fitting, those with the smallest id hashes. Null and empty texts have zero
    statistics and a score like any other; a null doc_id is scored and not held
    out; repeated rows are kept; other columns are left out. With no usable
    label every score is 0.5.
    """
    stats = id_text(docs, id_col, text_col).select("doc_id", statistics_of(F.col("text")).alias("s"))
    stats = materialize(stats.select("doc_id", "s.*"), "statistics")
    model = fit_quality(stats, labels, label_col, id_col, parts, part, sample_rows)
    return (stats.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"),
                         rule_score(*model).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", parts: int = 3,
              part: int = 1, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier predicts to be good, columns unchanged. Scores
    are computed in the row, so nothing is joined back; the edge cases are those of
    ``quality_scores``."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    stats = id_text(docs, id_col, text_col).select("doc_id", statistics_of(F.col("text")).alias("s"))
    labelled = stats.join(labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id")).distinct(),
                          "doc_id", "left_semi")
    labelled = materialize(labelled.select("doc_id", "s.*"), "statistics")
    model = fit_quality(labelled, labels, label_col, id_col, parts, part, sample_rows)
    own = "statistics of the text"  # no other column has this name
    return (docs.withColumn(own, statistics_of(text))
            .where(rule_score(*model, prefix=f"`{own}`.") >= 0.5).drop(own))
