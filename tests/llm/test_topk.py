"""Exact top-k search against all scores."""

import math
import random

import numpy as np
import pytest

from dimweave.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5):
    ok = []
    for at, (i, v) in enumerate(rows):
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ok.append((at, i, [math.floor(256 * float(np.float32(x))) for x in v]))
    want = []
    for at, i, q in ok:
        if i % 50 == 0:
            scores = [(-sum(a * b for a, b in zip(q, v)), j) for other, j, v in ok if other != at]
            want += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k])]
    return sorted(want)


def answered(spark, tables, rows):
    folder = tables(embeddings=([(i, v, 0) for i, v in rows], SCHEMA))
    found = topk.op6_exact_top_k(spark, folder).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)


def vectors(rng, n, width):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    return [(i, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("blocks", [(32_768, 2048), (70, 3)])
def test_clusters(spark, tables, monkeypatch, blocks):
    monkeypatch.setattr(topk, "ROWS", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    monkeypatch.setattr(topk, "STEP", 8)
    rows = vectors(random.Random(1), 500, 12)
    assert answered(spark, tables, rows) == brute(rows)


def test_odd_vectors(spark, tables):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0])]
    rows += [(None, [9.0, 9.0]), (6, []), (7, [0.5]), (8, [-1.0, -2.0]), (50, [0.0, 0.0]), (9, [3000.0, -1e6]), (100, [1e6, 1e6])]
    assert answered(spark, tables, rows) == brute(rows)


def test_ties_go_to_the_smaller_id(spark, tables):
    rows = [(i, [1.0, 0.0]) for i in range(200)]
    assert answered(spark, tables, rows) == brute(rows)


def test_few_or_no_vectors(spark, tables):
    assert answered(spark, tables, []) == []
    assert answered(spark, tables, [(0, [1.0])]) == []
    assert answered(spark, tables, [(0, [1.0]), (3, [2.0])]) == [(0, 1, 3, 131_072)]


def test_bounds_leave_most_rows_unscored(monkeypatch):
    rng = np.random.default_rng(4)
    rows = np.concatenate([rng.normal(c, 1, (500, 8)) for c in (-300, 0, 300, 900)]).astype(np.int64)
    lift = np.sqrt(((rows**2).sum(axis=1).max() - (rows**2).sum(axis=1)).astype(float))
    wide = np.column_stack((rows, lift))
    longest = float((rows**2).sum(axis=1).max())
    pivots = topk.choose_pivots(wide, 8)
    to = np.sqrt(np.maximum(0, ((wide[:, None] - pivots) ** 2).sum(axis=2)))
    query = np.column_stack((rows[:3], np.zeros(3)))
    of = np.sqrt(((query[:, None] - pivots) ** 2).sum(axis=2))
    ids = np.column_stack((np.arange(len(rows)), np.arange(len(rows))))
    scored = []
    monkeypatch.setattr(topk, "STEP", 16)

    class Counting(np.ndarray):
        def __matmul__(self, other):
            scored.append(len(self))
            return np.asarray(self) @ np.asarray(other)

    found = topk.search_block(rows[:3], rows.view(Counting), to, of, longest, np.arange(3), ids, 5)
    for i, (best, scores) in enumerate(found):
        want = sorted((-int(rows[j] @ rows[i]), j) for j in range(len(rows)) if j != i)[:5]
        assert [(-int(s), int(b)) for b, s in zip(best, scores)] == want
    assert sum(scored) < 3 * len(rows)
