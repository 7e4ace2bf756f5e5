"""Hard negatives against all pairs in plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from cohortlens.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<double>, label int, score long, akey string"


def rows_of(seed=3, n=700, dims=12, labels=4):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = r.choice(centres)
        rows.append((i, [x + r.gauss(0, 0.4) for x in c], r.randrange(labels)))
    rows += [(n + i, rows[5][1], 1) for i in range(60)]  # a crowd of equal vectors
    rows += [(n + 100, rows[0][1], 2)] * 3  # a repeated row
    rows += [(300, rows[7][1], 3), (200, [1.0, 2.0], 1), (201, [1.0, 3.0], 1), (202, [1.0, 2.9], 2), (100, None, 1),
             (400, [float("nan")] * dims, 1), (500, [float("inf")] * dims, 1), (401, [None] + [1.0] * (dims - 1), 1),
             (402, [1.0] * dims, None), (None, [1.0] * dims, 2), (600, [], 1), (601, [], 1), (602, [], 2), (7, [0.0] * dims, 0)]
    return rows


def brute(rows, scale=256, lower=80, upper=100, k=5, anchor=lambda i: i % 100 == 0):
    import math
    held = set()
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held.add((i, (y + 1) % 10 if i % 7 == 0 else y, tuple(math.floor(scale * x) for x in v)))
    out = []
    for a, y, q in held:
        if not anchor(a):
            continue
        score = sorted((-sum(p * s for p, s in zip(q, v)), i, z) for i, z, v in held if i != a and len(v) == len(q))
        for s, i, z in [t for t in score if t[2] == y][:k]:
            hard = [t for t in score if t[2] != y and lower * -s <= 100 * -t[0] <= upper * -s][:k]
            out += [(a, i, rank, j, -s, -t) for rank, (t, j, _) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, scale=256, **kw):
    table = spark.createDataFrame([(i, v, y, 1, "clash") for i, v, y in rows], SCHEMA).repartition(3)
    label = "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END"
    return sorted(tuple(r) for r in H.mine_hard_negatives(
        H.vectors_of(table, "vec_id", label, "embedding", scale), "id % 100 = 0", **kw).collect())


def test_all_rows_are_those_of_brute_force(spark):
    assert mined(spark, rows_of()) == brute(rows_of())


def test_small_cells_and_leaves_change_nothing(spark, monkeypatch):
    for name, size in (("CELL_ROWS", 40), ("GROUP_ROWS", 3), ("LEAF_ROWS", 8), ("FANOUT", 4)):
        monkeypatch.setattr(H, name, size)
    assert mined(spark, rows_of(9)) == brute(rows_of(9))
    assert mined(spark, rows_of(9), sample_rows=30) == brute(rows_of(9))


def test_scores_beyond_the_exact_range_of_doubles(spark):
    rows = [(i, [(i * 7919 % 1000) * 1e3 + i, 1e5 + i, -3.0], i % 3) for i in range(300)]
    assert 1 << 53 < max(abs(r[4]) for r in brute(rows)) < 1 << 62
    assert mined(spark, rows) == brute(rows)


def test_huge_components_take_part(spark):
    rows = [(100, [1e17, 1.0], 1), (1, [1e17, 5.0], 1), (2, [9e16, 1.0], 2), (3, [1.0, 1.0], 2)]
    (got,) = mined(spark, rows)
    assert got[:4] == (100, 1, 1, 2)


def test_empty_tables(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == []


def test_the_tree_leaves_out_subtrees():
    """On clustered rows most leaves are never scored, and what is left out has no row in a window."""
    r = np.random.default_rng(0)
    x = np.floor(256 * np.concatenate([c + 0.02 * r.normal(size=(300, 8)) for c in r.normal(size=(20, 8))]))
    node = H.build_lower(x, np.arange(len(x)))
    leaves = lambda n: [n] if n.rows is not None else [m for s in n.subtrees for m in leaves(s)]
    a = x[:1]
    a2 = H._square(a)
    low, high = np.array([0.97 * a2[0]]), np.array([1.05 * a2[0]])
    seen = []

    def visit(n):
        if n.rows is not None:
            seen.extend(n.rows)
            return
        for s, ok in zip(n.subtrees, n.alive(a, a2, low, high)[0], strict=True):
            if ok:
                visit(s)

    visit(node)
    score = x @ a[0]
    inside = set(np.flatnonzero((score >= low[0]) & (score <= high[0])))
    assert inside <= set(seen) and len(seen) < len(x) / 2 and len(leaves(node)) > 10


@pytest.mark.parametrize("dims", [0, 1])
def test_a_part_of_short_vectors(dims):
    cand = pa.table({"id": pa.array([1, 2], pa.int64()), "label": pa.array([1, 2], pa.int64()),
                     "v": pa.array([[3.0] * dims] * 2, pa.list_(pa.float64()))})
    window = {"tag": 0, "same": True, "top": None, "top_over": None, "least": None, "least_over": None}
    query = pa.table({"akey": pa.array([9], pa.int64()), "id": pa.array([5], pa.int64()), "label": pa.array([1], pa.int64()),
                      "v": pa.array([[2.0] * dims], pa.list_(pa.float64())), "windows": pa.array([[window]])})
    got = H.search_part(cand, query, dims, 5, 80, 100)
    assert got.column("id").to_pylist() == [1] and got.column("score").to_pylist() == [6 * dims]
