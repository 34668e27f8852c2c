"""Top-k search and hard negatives against plain Python over all rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import blocks, negatives, topk

SCHEMA = "vec_id long, embedding array<float>, label int, id string, q string, score string, `rank` string, block string, vector string, copies string"
CLASHING = ("id", "q", "score", "rank", "block", "vector", "copies")


def vectors(llm, rows):
    return llm.createDataFrame([(i, v, c, *CLASHING) for i, v, c in rows], SCHEMA)


def whole(rows, scale, labelled=False):
    """(id, label, integers) of the rows that take part."""
    out = []
    for i, v, c in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v) or labelled and c is None:
            continue
        out.append((i, c, [math.floor(scale * float(np.float32(x))) for x in v]))
    return out


def score(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def order(hit):
    return (-hit[1], hit[0] is None, hit[0] or 0)


def plain_search(rows, k, scale):
    rows, out = whole(rows, scale), []
    for r, (i, _, v) in enumerate(rows):
        if i is not None and i % 100 == 0:
            hits = sorted(((j, score(v, w)) for s, (j, _, w) in enumerate(rows) if s != r), key=order)[:k]
            out += [(i, n, j, x) for n, (j, x) in enumerate(hits, 1)]
    return sorted(out, key=str)


def plain_mine(rows, scale):
    rows, out = whole(rows, scale, labelled=True), []
    for r, (i, c, v) in enumerate(rows):
        if i is None or i % 100:
            continue
        others = [(j, score(v, w), d) for s, (j, d, w) in enumerate(rows) if s != r]
        for j, p, _ in sorted((h for h in others if h[2] == c), key=order)[:5]:
            window = sorted((h for h in others if h[2] != c and 30 * p <= 100 * h[1] <= 90 * p), key=order)[:10]
            out += [(i, j, n, m, p, x) for n, (m, x, _) in enumerate(window, 1)]
    return sorted(out, key=str)


def random_rows(seed, n, d, spread=1.0):
    draw = random.Random(seed)
    return [(i, [draw.gauss(0, spread) for _ in range(d)], draw.randrange(3)) for i in range(n)]


ODD_VECTORS = [
    (0, [1.0, 2.0, -1.5], 1), (0, [1.0, 2.0, -1.5], 1), (0, [1.0, 2.0, -1.5], 2), (0, [9.0, 0.0, 0.0], 1), (100, [1.0, 2.0, -1.5], 1), (200, [], 1), (300, None, 1),
    (400, [1.0, None, 2.0], 1), (500, [float("nan"), 1.0, 1.0], 1), (600, [float("inf"), 1.0, 1.0], 1), (700, [0.5, 0.5], 2), (800, [0.25] * 900, None),
    (None, [3.0, 3.0, 3.0], 2), (None, [3.0, 3.0, 3.0], 2), (None, None, None), (-100, [-1.0, -2.0, 1.5], 1), (7, [2.0, 1.0, 0.0], 1), (8, [2.0, 1.0, 0.0], 2),
    (9, [2.0, 1.0, 0.0], 2), (900, [-0.0, 0.0, 0.0], 2),
]


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def searched(llm, rows, k=10, scale=16):
    return found(topk.search(vectors(llm, rows), F.col("vec_id") % 100 == 0, k, scale))


def mined(llm, rows, scale=16):
    return found(negatives.mine(vectors(llm, rows), F.col("vec_id") % 100 == 0, scale=scale))


@pytest.mark.parametrize("rows", [random_rows(1, 900, 5), random_rows(2, 300, 70), ODD_VECTORS, ODD_VECTORS + random_rows(3, 200, 3)], ids=["narrow", "wide", "odd", "mixed"])
def test_search_and_negatives_equal_brute_force(llm, rows):
    assert searched(llm, rows) == plain_search(rows, 10, 16)
    assert mined(llm, rows) == plain_mine(rows, 16)


def test_one_vector_may_hold_a_third_of_all_rows(llm):
    rows = random_rows(4, 600, 4)
    rows += [(1000 + i, [0.5, -0.25, 1.0, 0.0], i % 2) for i in range(300)]
    assert searched(llm, rows) == plain_search(rows, 10, 16)
    assert mined(llm, rows) == plain_mine(rows, 16)


def test_many_blocks_pass_bounds_on(llm, monkeypatch):
    rows = random_rows(5, 700, 6)
    cut = vectors(llm, rows).repartition(40)
    got = found(topk.search(cut, F.col("vec_id") % 50 == 0, 3, 16))
    double = [(2 * i, v, c) for i, v, c in rows]
    assert [(2 * a, n, 2 * b, s) for a, n, b, s in got] == [tuple(r) for r in sorted(plain_search(double, 3, 16), key=lambda r: str((r[0] // 2, r[1], r[2] // 2, r[3])))]


def test_nothing(llm):
    assert searched(llm, []) == [] and mined(llm, []) == []
    assert searched(llm, [(1, [1.0], 1)]) == [] and searched(llm, [(100, [1.0], 1)]) == []


def test_large_numbers_stay_exact_and_overflow_is_an_error(llm):
    rows = [(100, [3e7, 1.0], 1), (1, [3e7, -1.0], 1), (2, [2.9e7, 5.0], 2)]
    assert searched(llm, rows, scale=1) == plain_search(rows, 10, 1)
    with pytest.raises(Exception, match="(?i)overflow|too large"):
        searched(llm, [(100, [1e30], 1), (1, [1e30], 1)])


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 0, 3), (33, 17, 64), (64, 64, 64), (40, 100, 70)])
@pytest.mark.parametrize("size", [10, 1 << 24, 1 << 40])
def test_strassen_is_exact(shape, size):
    draw = np.random.default_rng(sum(shape))
    a, b = draw.integers(-size, size, shape[:2]), draw.integers(-size, size, shape[1:])
    assert (negatives.strassen(a, b) == a.astype(object) @ b.astype(object)).all()


def test_strassen_takes_seven_products(monkeypatch):
    calls = []
    monkeypatch.setattr(blocks, "multiply", lambda a, b, bound: calls.append(a.shape) or a @ b)
    one = np.ones((64, 64), dtype=np.int64)
    assert (negatives.strassen(one, one) == 64).all()
    assert calls == [(16, 16)] * 49


@pytest.mark.parametrize("n", [1, 64, 65, 500, 4096])
def test_trees_prune_and_stay_exact(n):
    draw = np.random.default_rng(n)
    matrix = draw.integers(-50, 50, (n, 2))
    order, low, high = topk.build_tree(matrix)
    assert sorted(order.tolist()) == list(range(n)) and len(low) == len(high) == (2 << topk.depth(n)) - 1
    for level, cuts in enumerate(topk.segments(n, topk.depth(n))):
        for node, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True), (1 << level) - 1):
            assert (low[node] == matrix[order[a:b]].min(axis=0)).all() and (high[node] == matrix[order[a:b]].max(axis=0)).all()
    queries, rank = draw.integers(-50, 50, (30, 2)), draw.permutation(n)
    keys, _, _ = topk.search_tree(queries, matrix[order], rank, (low, high), [None] * 30, 5)
    wanted = np.sort((queries @ matrix[order].T) * blocks.BLOCK_ROWS + blocks.BLOCK_ROWS - 1 - rank, axis=1)[:, -5:]
    assert (keys[:, -wanted.shape[1] :] == wanted).all()


def test_bounds_leave_most_leaves_out(monkeypatch):
    draw = np.random.default_rng(9)
    matrix = draw.integers(-500, 500, (4096, 2))
    order, low, high = topk.build_tree(matrix)
    scored, multiply = [], blocks.multiply
    monkeypatch.setattr(blocks, "multiply", lambda a, b, bound: scored.append(len(a) * b.shape[1]) or multiply(a, b, bound))
    topk.search_tree(draw.integers(-500, 500, (50, 2)), matrix[order], np.arange(4096), (low, high), [None] * 50, 10)
    assert sum(scored) < 50 * 4096 / 4
