import math
import re

import numpy as np
import pytest

from idweave.llm import topk as t


def brute(rows, queries, k):
    def ok(i, v):
        return i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)

    def ints(v):
        return [math.floor(256 * np.float64(x)) for x in v]

    own = [(i, ints(v)) for i, v in rows if ok(i, v)]
    out = []
    for q, v in queries:
        if ok(q, v):
            score = sorted(((-max(-2**63, min(2**63 - 1, sum(a * b for a, b in zip(ints(v), c)))), i)
                            for i, c in own if i != q))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(score)]
    return sorted(out)


def run(spark, rows, queries, **more):
    schema = "vec_id long, embedding array<double>, score int, q int, slice int"
    frames = [spark.createDataFrame([(*r, 1, 2, 3) for r in x], schema) for x in (rows, queries)]
    return sorted(tuple(r) for r in t.top_k(*frames, k=5, **more).collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(12, 40))
    out = [(i, (base[i % 12] + 0.2 * rng.normal(size=40)).tolist()) for i in range(400)]
    out += [(400 + i, base[0].tolist()) for i in range(30)]  # ties
    out += [(None, [1.0]), (501, None), (502, [1.0, None]), (503, [float("nan")]), (504, [float("inf")]),
            (505, []), (506, [0.5, 0.5]), (3, out[3][1]), (507, [-0.001] * 40)]
    return out


@pytest.mark.parametrize("block", [t.BLOCK, 64])
def test_brute_force(spark, rows, block):
    queries = [r for r in rows if r[0] is None or r[0] % 10 == 0 or r[0] > 500]
    assert run(spark, rows, queries, block=block, slices=3) == brute(rows, queries, 5)


def test_components_beyond_exact_doubles(spark):
    rows = [(i, [1e14 * (i + 1), -3.0, 2.5 * i]) for i in range(6)] + [(9, [1e300, 1.0, 1.0])]
    assert run(spark, rows, rows) == brute(rows, rows, 5)


def test_few_and_no_candidates(spark):
    rows = [(1, [1.0]), (2, [2.0])]
    assert run(spark, rows, rows) == [(1, 1, 2, 131072), (2, 1, 1, 131072)]
    assert run(spark, rows[:1], rows[:1]) == [] == run(spark, rows, []) == run(spark, [], rows)


def test_queries_meet_the_blocks_by_a_shuffle(spark):
    """Copies of the query blocks for every slice are no broadcast, however small the tables are, and there are no more
    slices than blocks."""
    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(90)], "vec_id long, embedding array<double>")
    plan = t.top_k(df, df, block=40, slices=1000)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Broadcast" not in text and "SortMergeJoin [slice" in text
    slices = int(re.search(r"pmod\(xxhash64\(ids#\d+, 42\), (\d+)\)", plan.optimizedPlan().toString()).group(1))
    assert 3 <= slices <= 90


def test_blocks_of_every_width(spark):
    """Whole numbers up to the limits of the packed types and beyond, and blocks of the same ids with other vectors."""
    edge = [32767, -32768, 32768, -32769, 2**31 - 1, -2**31, 2**31, 0, -1, 2**40]
    rows = [(i, [x / 256, 1.0, -0.0]) for i, x in enumerate(edge)]
    for some in (rows[:2], rows[:4], rows[:6], rows):
        assert run(spark, some, some, block=2, slices=2) == brute(some, some, 5)
    twice = [(i, [float(i + 5 * j), 2.0 - j]) for j in range(6) for i in range(4)]
    assert run(spark, twice, twice[:4], block=4, slices=2) == brute(twice, twice[:4], 5)
