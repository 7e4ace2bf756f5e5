"""Ranked lexical search against a plain Python ranking."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from cohortlens.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def brute(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, total = len(held), sum(s for _, _, s in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in {(i, t) for i, t in items}:
        rows = []
        for doc, c, size in held:
            m = 100 - 90 + (90 * size * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in set(terms(text)) if t in c)
            if score > 0:
                rows.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=repr)


ITEMS = [(1, "one Two THREE ñó7 other"), (2, "the1 on2 er3 in4 ea5"), (3, None), (4, ""), (5, "..."), (1, "another item of one id"),
         (6, "changed one"), (6, "changed one"), (None, "no id x a"), (7, "is nowhere"), (8, "a")]


def ranked(docs, items, k=10, **kw):
    return sorted((tuple(r) for r in L.rank_documents(docs, items, k, **kw).collect()), key=repr)


@pytest.fixture(scope="module")
def items(spark):
    rows = [(i, t, "clash", 1) for i, t in ITEMS]
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string, score int").repartition(2)


@pytest.mark.parametrize("k", [1, 3, 10])
def test_ranks_are_those_of_brute_force(docs, items, k):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert ranked(docs, items, k) == brute(rows, ITEMS, k)


def test_many_groups_and_tiles_change_nothing(docs, items, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    monkeypatch.setattr(L, "ITEM_TILE", 2)
    monkeypatch.setattr(L, "DOC_TILE", 3)
    assert ranked(docs, items, 4, group_terms=5) == brute(rows, ITEMS, 4)


def test_ties_go_to_smaller_ids(frame, spark):
    docs = frame([(i, "same words here") for i in range(700, 0, -1)] + [(None, "same words here"), (900, "filler text")])
    items = spark.createDataFrame([(5, "words")], "item_id long, text string")
    assert [r[2] for r in sorted(ranked(docs, items), key=lambda r: r[1])] == list(range(1, 11))


def test_empty_sides(docs, empty, items):
    assert ranked(empty, items) == [] and ranked(docs, items.limit(0)) == []
    assert L.rank_documents(empty, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_a_text_of_several_megabytes(frame, spark):
    long = " ".join(f"w{i}" for i in range(600_000)) + " needle"
    docs = frame([(1, long), (2, "needle " * 3), (3, "hay")])
    items = spark.createDataFrame([(1, "needle w599999")], "item_id long, text string")
    assert ranked(docs, items) == brute([(1, long), (2, "needle " * 3), (3, "hay")], [(1, "needle w599999")], 10)


def test_columns_are_cut_where_sums_could_pass_the_exact_range():
    """Weights so large that one product's sum would pass 2^53: the cuts keep it whole."""
    weight = np.full(40, 10**9, np.int64)
    tile = L._Tile([np.arange(40)], 0, weight)
    impact = np.full(40, 999_983, np.int64)
    got = tile.scores(np.zeros(40, np.int64), np.arange(40), impact, 1)
    assert int(got[0, 0]) == 40 * 10**9 * 999_983


def test_impacts_beyond_64_bits_are_whole():
    tf, n = np.array([3, 10**11]), np.array([10**12, 10**12])
    got = L._impacts(tf, n, 10**11, 10**14)
    assert got.tolist() == [10**9 * t // (1000 * t + 8 * (10 + 90 * 10**11 * k // 10**14)) for t, k in zip(tf.tolist(), n.tolist())]
