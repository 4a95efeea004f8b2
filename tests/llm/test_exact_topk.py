"""Exact top-k search against sums of Python's whole numbers."""

import math
import random

import numpy as np
import pytest

from vigil.llm import exact_topk as K

SCHEMA = "vec_id long, embedding array<float>, row string, score double, block int"


def brute(rows, k=5, every=50):
    """Sorted (query id, rank, id, score) rows; every row is a vector of its own."""
    use = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            use.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for n, (i, q) in enumerate(use):
        if i is None or i % every:
            continue
        found = []
        for m, (j, c) in enumerate(use):
            if m != n:
                s = sum(a * b for a, b in zip(q, c, strict=False))
                found.append((-max(min(s, K.LIMIT - 1), -K.LIMIT), j is None, j or 0, j))
        found.sort(key=lambda x: x[:3])
        out += [(i, r + 1, f[3], -f[0]) for r, f in enumerate(found[:k])]
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, "x", 0.5, 3) for i, v in rows], SCHEMA)
    return sorted((tuple(r) for r in K.search(df, **{"k": 5, "every": 50, **kw}).collect()), key=str)


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(11)

    def vec(n=8):
        return [rng.gauss(0, 1) for _ in range(n)]
    rows = [(i, vec()) for i in range(400)]
    same = vec()
    rows += [(1000 + i, same) for i in range(150)] + [(-50, same), (-100, [0.0] * 8)]       # ties, a group of copies
    rows += [(None, same), (None, vec()), (50, vec()), (50, rows[50][1]), rows[7], rows[7]]
    rows += [(5000, None), (5050, []), (5100, [1.0] * 3), (5150, [float("nan")] + vec(7)),
             (5200, [float("inf")] * 8), (5250, [None] + vec(7)), (5300, [5.0] * 12)]
    return rows


@pytest.mark.parametrize("cells,scores,digits", [(1 << 19, 1 << 21, 12), (256, 1000, 3), (64, 1, 5)])
def test_topk_against_brute_force(spark, vectors, monkeypatch, cells, scores, digits):
    monkeypatch.setattr(K, "BLOCK_CELLS", cells)
    monkeypatch.setattr(K, "SLICE_SCORES", scores)
    monkeypatch.setattr(K, "DIGIT_BITS", digits)
    assert run(spark, vectors) == brute(vectors)


def test_all_equal_vectors_go_to_the_smallest_ids(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK_CELLS", 128)
    rows = [(i, [0.5, -0.25]) for i in range(300, -1, -1)]
    got = run(spark, rows, every=100)
    assert got == brute(rows, every=100)
    assert [r[2] for r in sorted(got) if r[0] == 0] == [1, 2, 3, 4, 5]


def test_few_candidates_and_nothing(spark):
    assert run(spark, []) == run(spark, [(50, [1.0])]) == run(spark, [(1, [1.0]), (2, [2.0])]) == []
    rows = [(50, [1.0]), (1, [2.0]), (2, [-3.0]), (100, None)]
    assert run(spark, rows) == brute(rows) and len(run(spark, rows)) == 2


def test_products_beyond_floating_point(spark):
    rows = [(50 * i, [1e6 * (i + 1), 1.5e5, 3.0 + i]) for i in range(6)]
    rows += [(7, [3e9, 1.0, 1.0]), (8, [-3e9, 1.0, 2.0]), (9, [3e9, 1.0, 1.0 + 2 ** -8]), (10, [3e38, 0.0, 0.0])]
    assert run(spark, rows) == brute(rows)


def test_exact_scores_are_whole():
    rng = np.random.default_rng(3)
    q, b = np.floor(rng.normal(0, 1e9, (4, 6))), np.floor(rng.normal(0, 1e9, (9, 6)))
    b[3:] = np.floor(b[3:] / 1e8)
    want = [[sum(int(x) * int(y) for x, y in zip(u, v, strict=True)) for v in b] for u in q]
    assert K.exact_scores(q, b).tolist() == [[min(max(x, -K.LIMIT), K.LIMIT - 1) for x in r] for r in want]
