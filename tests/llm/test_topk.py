import math

import pytest

from goldrec.llm import topk
from goldrec.llm.common import table
from llm.conftest import found


def brute(rows, every=50, k=5):
    vectors = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            vectors.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = []
    for q in sorted(i for i in vectors if i % every == 0):
        for query in vectors[q]:
            scores = [(-sum(a * b for a, b in zip(query, v)), i) for i, many in vectors.items() if i != q for v in many if len(v) == len(query)]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 60])
def test_equals_brute_force(spark, sf, monkeypatch, block):
    monkeypatch.setattr(topk, "VECTORS", block)
    rows = table(spark, sf, "embeddings")
    assert sorted(map(tuple, topk.nearest(rows).collect())) == brute([(r["vec_id"], r["embedding"]) for r in rows.collect()])


def test_odd_vectors(spark):
    rows = [(0, [1.0, -1.0]), (1, [1.0, -1.0]), (2, [1.0, -1.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 0.0]),
            (7, []), (None, [1.0, 1.0]), (8, [0.001, -0.001]), (9, [1.0, 2.0, 3.0]), (50, [-2.0, 0.5]), (50, [-2.0, 0.5])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, id int, v string")
    got = found(topk.nearest(df))
    once = [r for r in brute(rows) if r[0] == 0]
    assert [r for r in got if r[0] == 0] == [tuple(map(int, r)) for r in once]
    assert topk.nearest(df.limit(0)).collect() == []


def test_very_large_components_count_as_the_largest(spark):
    rows = [(0, [1e17, 1.0]), (1, [1e300, 0.0]), (2, [-1e17, 5.0]), (3, [2.0, 0.0])]
    got = found(topk.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")))
    assert [r[2] for r in got] == [1, 3, 2] and got[0][3] == topk.LARGEST and got[2][3] == -topk.LARGEST


def test_large_numbers_stay_exact():
    import numpy as np

    ids, vectors = np.arange(3), np.array([[2**40, 1], [2**40, 2], [0, 5]])
    assert topk.block_top(ids, vectors, np.array([9]), np.array([[2**40, 1]]), 2) == [(9, 1, 2**80 + 2), (9, 0, 2**80 + 1)]
