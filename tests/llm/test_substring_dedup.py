import collections
import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from llm_helpers import rows_of

from idweave.llm.substring_dedup import phrases, remove_repeats, repeated_windows

COLUMNS = ("n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(r[i:i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (i, _), r in zip(rows, raws):
        hit = np.zeros(len(r) + 1, np.int8)
        for j in range(len(r) - length + 1):
            if seen[r[j:j + length]] > 1:
                hit[j:j + length] = 1
        kept = bytes(c for c, h in zip(r, hit) if not h)
        out.append((i, len(r), int(hit.sum()), int((np.diff(hit, prepend=0) == 1).sum()),
                    hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def mixed(spark):
    random.seed(3)
    rows = [(None, None), (1, ""), (2, "a" * 1000), (3, "ab" * 300), (3, "ab" * 300), (4, "é" * 150),
            (5, "é" * 150 + "x"), (6, "a" * 199), (None, "q" * 50)]
    common = "".join(random.choice("abcdefgh ") for _ in range(2500))
    for k in range(25):
        a, b = sorted(random.sample(range(2500), 2))
        pad = ["".join(random.choice("abcdefgh ") for _ in range(random.randint(0, 300))) for _ in (0, 1)]
        rows.append((10 + k, pad[0] + common[a:b] + pad[1]))
    return rows


@pytest.mark.parametrize("length,group", [(200, 2000), (200, 2), (40, 2)])
def test_brute_force(spark, mixed, length, group):
    docs = spark.createDataFrame(mixed, "doc_id long, text string")
    assert rows_of(remove_repeats(docs, length, COLUMNS, group=group)) == brute(mixed, length)


def test_documents_and_edges(documents, edge):
    for docs in (documents, edge):
        rows = [(r.doc_id, r.text) for r in docs.collect()]
        assert rows_of(remove_repeats(docs, 200, COLUMNS)) == brute(rows, 200)


def test_kept_text_and_carried_columns(spark):
    same = "é" * 101  # 202 bytes; the cut before the second copy goes through no character
    docs = spark.createDataFrame([(1, "A " + same + " B", "x"), (2, same, "y")], "doc_id long, text string, kept string")
    out = remove_repeats(docs, 200, ("kept", "spans"), carry=("doc_id", "kept")).orderBy("doc_id").collect()
    assert [(r.kept, r.spans, r.carry.kept) for r in out] == [("A  B", [[2, 204]], "x"), ("", [[0, 202]], "y")]


def test_equal_windows_have_the_same_trigger():
    random.seed(1)
    passage = bytes(random.choice(b"abc ") for _ in range(900))
    places = []
    for pad in (b"", b"zz" * 77, bytes(random.choice(b"abc ") for _ in range(333))):
        at, first, last = phrases(pad + passage, 200)
        own = np.repeat(at, last - first + 1) - len(pad)
        places.append(own[len(pad):])
    assert all((p == places[0]).all() for p in places)


def test_empty_table(edge):
    assert remove_repeats(edge.where("false")).count() == 0


def test_sorting_a_group_holds_only_windows_that_may_repeat():
    rng = random.Random(3)
    contexts = [rng.randbytes(311) for _ in range(300)] + [b"x" * 150 + rng.randbytes(100)]
    contexts += [contexts[0][40:], contexts[1][:250]]
    plain = collections.Counter(c[i:i + 200] for c in contexts for i in range(len(c) - 199))
    tracemalloc.start()
    got = repeated_windows(contexts, 200)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [g.tolist() for g in got] == [[plain[c[i:i + 200]] > 1 for i in range(len(c) - 199)] for c in contexts]
    assert most < 100 * sum(len(c) - 199 for c in contexts)  # bytes; every window itself takes over 200
