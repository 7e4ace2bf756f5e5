"""Hard negatives by a multiway hyperplane tree with distance ranges between siblings.

A node has split points, and each row belongs to the nearest one: its subtree.  For every pair of
split points the node stores the range of distances from the first to the rows of the second's
subtree, and for each subtree the range of squared norms.  A search looks for rows whose inner
product with an anchor lies in a window.  With the norms of a subtree the window is an annulus
around the anchor, and by the triangle inequality an interval of distances from every split point;
a subtree whose stored range misses one of them is left out.  Leaves are scored exactly.

The upper tree is fitted on a bounded sample, then every row goes down it and the ranges are
grouped minima and maxima over all rows.  Its leaves are cells, dealt in parts of bounded size by
hash, so that a crowd of equal vectors is many parts; anchors visit the cells that survive.  A task
has one part and a bounded group of anchors, and builds the lower tree of its part.

Four searches follow each other: the best same-label rows of an anchor's own cell give a bound,
within which all cells are searched; the window under each positive is tightened in the same way.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.shipping import arrow_map, ship
from cohortlens.llm.staging import staged

SAMPLE_ROWS = 4096
CELL_ROWS, GROUP_ROWS, LEAF_ROWS = 4096, 4096, 256
FANOUT, LOOK = 16, 3
STEP = 1 << 18  # window-by-row entries compared at once
_EXACT = float(1 << 53)
_INF = float("inf")
_WINDOW = "struct<tag:int,same:boolean,top:bigint,top_over:double,least:bigint,least_over:double>"
_ANCHOR = f"akey long, id long, label long, v array<double>, dims int, home int, windows array<{_WINDOW}>"


def _distance(x: np.ndarray, x2: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Distances (rows of x, rows of p)."""
    return np.sqrt(np.maximum(x2[:, None] + (p * p).sum(1) - 2 * (x @ p.T), 0))


def _square(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def _split_points(x: np.ndarray, fanout: int) -> np.ndarray:
    """Rows far from each other among evenly spaced candidates, the farthest next."""
    cand = x[np.unique(np.linspace(0, len(x) - 1, LOOK * fanout).astype(int))]
    chosen, gap = [0], _distance(cand, _square(cand), cand[:1])[:, 0]
    while len(chosen) < fanout and gap.max(initial=0) > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, _distance(cand, _square(cand), cand[chosen[-1:]])[:, 0])
    return cand[chosen]


@dataclass
class Node:
    """A leaf holds ``rows`` or, in the upper tree, a cell number; other nodes hold split points,
    subtrees, and per (split point, subtree) the nearest and farthest distance."""

    cell: int = 0
    rows: np.ndarray | None = None
    points: np.ndarray | None = None
    subtrees: list[Node] = field(default_factory=list)
    near: np.ndarray | None = None
    far: np.ndarray | None = None
    norms: np.ndarray | None = None  # least and largest squared norm of each subtree

    def clear(self) -> None:
        m = len(self.subtrees)
        self.near, self.far = np.full((m, m), _INF), np.full((m, m), -_INF)
        self.norms = np.stack([np.full(m, _INF), np.full(m, -_INF)])

    def widen(self, child: np.ndarray, dist: np.ndarray, x2: np.ndarray) -> None:
        """Take rows into the ranges; a distance that overflows says nothing."""
        low, high = np.where(np.isfinite(dist), dist, 0), np.where(np.isfinite(dist), dist, _INF)
        for j in np.unique(child):
            own = child == j
            self.near[:, j] = np.minimum(self.near[:, j], low[own].min(0))
            self.far[:, j] = np.maximum(self.far[:, j], high[own].max(0))
            self.norms[0, j] = min(self.norms[0, j], x2[own].min())
            self.norms[1, j] = max(self.norms[1, j], x2[own].max())

    def alive(self, x: np.ndarray, x2: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """(windows, subtrees): whether a subtree may hold a row in the window [low, high] of
        inner products with the anchors ``x`` (one row per window).  Errors only keep more."""
        with np.errstate(all="ignore"):
            d = _distance(x, x2, self.points)
            outer = x2[:, None] + self.norms[1] - 2 * low[:, None]
            inner = x2[:, None] + self.norms[0] - 2 * high[:, None]
            slack = 1e-6 * (1 + np.sqrt(x2.max(initial=0)) + np.sqrt(max(self.norms[1].max(), 0)))
            out = np.sqrt(np.maximum(outer, 0)) + slack
            inn = np.sqrt(np.maximum(inner, 0)) - slack
            dead = (outer < -slack * slack) | (self.norms[0] > self.norms[1])
            for i in range(len(self.points)):
                di = d[:, i:i + 1]
                dead |= (self.far[i] < np.maximum(di - out, inn - di)) | (self.near[i] > di + out)
        return ~dead


def build_upper(sample: np.ndarray, rows: float) -> Node:
    """Split points from a sample of ``rows`` rows; cells are numbered from 0 and no longer split
    once they should hold CELL_ROWS rows."""
    number = iter(range(1 << 30))

    def grow(x: np.ndarray, expected: float) -> Node:
        if expected <= CELL_ROWS or len(x) < 4 * FANOUT:
            return Node(cell=next(number))
        points = _split_points(x, FANOUT)
        if len(points) < 2:
            return Node(cell=next(number))
        child = _distance(x, _square(x), points).argmin(1)
        node = Node(points=points, subtrees=[grow(x[child == j], expected * (child == j).mean()) for j in range(len(points))])
        node.clear()
        return node

    return grow(sample, rows)


def _nodes(node: Node) -> list[Node]:
    return [node, *(n for s in node.subtrees for n in _nodes(s))]


def descend(node: Node, x: np.ndarray, widen: bool = False) -> np.ndarray:
    """The cell of each row; ``widen`` takes the rows into the ranges of their nodes."""
    out = np.full(len(x), node.cell)
    if node.subtrees and len(x):
        with np.errstate(all="ignore"):
            x2 = _square(x)
            dist = _distance(x, x2, node.points)
        child = np.where(np.isnan(dist), _INF, dist).argmin(1)
        if widen:
            node.widen(child, dist, x2)
        for j, sub in enumerate(node.subtrees):
            own = np.flatnonzero(child == j)
            out[own] = descend(sub, x[own], widen)
    return out


def build_lower(x: np.ndarray, rows: np.ndarray) -> Node:
    """The tree over given rows, its leaves holding row numbers."""
    if len(rows) > LEAF_ROWS:
        own = x[rows]
        points = _split_points(own, FANOUT)
        with np.errstate(all="ignore"):
            x2 = _square(own)
            dist = _distance(own, x2, points)
        child = np.where(np.isnan(dist), _INF, dist).argmin(1)
        if len(points) > 1 and np.bincount(child).max() < len(rows):
            node = Node(points=points, subtrees=[build_lower(x, rows[child == j]) for j in range(len(points))])
            node.clear()
            node.widen(child, dist, x2)
            return node
    return Node(rows=rows)


class _Windows:
    """The windows of a table of anchors: bounds on the score, and the k best rows so far."""

    def __init__(self, table: pa.Table, k: int, lower: int, upper: int):
        flat = [(i, w) for i, ws in enumerate(table.column("windows").to_pylist()) for w in ws]
        self.k = k
        self.own = np.array([i for i, _ in flat], np.int64)
        self.tag = np.array([w["tag"] for _, w in flat], np.int64)
        self.same = np.array([w["same"] for _, w in flat], bool)
        low, high = [], []
        for _, w in flat:
            top = _whole(w["top"], w["top_over"])
            least = _whole(w["least"], w["least_over"])
            low.append(max([x for x in (None if top is None else -(-lower * top // 100), least) if x is not None], default=-_INF))
            high.append(_INF if top is None else upper * top // 100)
        self.low, self.high = low, high
        self.found = [np.zeros(0, np.int64)] * 3

    def prepare(self, kind: type) -> None:
        self.low, self.high = np.array(self.low, kind), np.array(self.high, kind)

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        window, score, ids = (np.concatenate(x) for x in zip(self.found, (window, score, ids), strict=True))
        if score.dtype == object:
            order = np.array(sorted(range(len(score)), key=lambda i: (window[i], -score[i], ids[i])), np.int64)
        else:
            order = np.lexsort((ids, -score, window))
        window = window[order]
        place = np.arange(len(window)) - np.searchsorted(window, window)
        last = place == self.k - 1
        self.low[window[last]] = np.maximum(self.low[window[last]], score[order][last])
        keep = order[place < self.k]
        self.found = [window[place < self.k], score[keep], ids[keep]]


def _whole(value: int | None, over: float | None) -> int | None:
    """The exact score, or beyond 64 bits its double as a whole number."""
    return int(over) if over else value


def _vectors(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    parts = [c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks if len(c)] if dims else []
    return np.concatenate([*parts, np.zeros(0)]).reshape(len(column), dims)


def search_part(cand: pa.Table, query: pa.Table, dims: int, k: int, lower: int, upper: int) -> pa.Table:
    """For each window of each anchor in ``query``: its k best rows among ``cand``, exactly."""
    order = np.lexsort((cand.column("label").to_numpy(), cand.column("id").to_numpy()))
    ids, label = cand.column("id").to_numpy()[order], cand.column("label").to_numpy()[order]
    x = _vectors(cand.column("v"), dims)[order]
    a, a_id, a_label = _vectors(query.column("v"), dims), query.column("id").to_numpy(), query.column("label").to_numpy()
    wins = _Windows(query, k, lower, upper)
    with np.errstate(all="ignore"):
        a2 = _square(a)
        bound = np.sqrt(a2.max(initial=0)) * np.sqrt(_square(x).max(initial=0))
    exact = bool(bound < _EXACT / 2)
    wins.prepare(np.float64 if exact else object)
    whole_x, whole_a = (x, a) if exact else (_integers(x), _integers(a))

    def leaf(rows: np.ndarray, window: np.ndarray) -> None:
        for at in range(0, len(window), max(1, STEP // max(1, len(rows)))):
            w = window[at:at + max(1, STEP // max(1, len(rows)))]
            anchors, inverse = np.unique(wins.own[w], return_inverse=True)
            score = (whole_a[anchors] @ whole_x[rows].T)[inverse] if dims else np.zeros((len(w), len(rows)))
            ok = (score >= wins.low[w][:, None]) & (score <= wins.high[w][:, None])
            ok = ok.astype(bool) & ((a_label[wins.own[w]][:, None] == label[rows]) == wins.same[w][:, None])
            ok &= a_id[wins.own[w]][:, None] != ids[rows]
            i, j = np.nonzero(ok)
            if len(i):
                wins.add(w[i], score[i, j], ids[rows[j]])

    def visit(node: Node, window: np.ndarray) -> None:
        if not len(window):
            return
        if node.rows is not None:
            leaf(node.rows, window)
            return
        own = wins.own[window]
        # nearest subtrees first, by the anchors' mean: their rows raise the bounds for the others
        mean = _distance(a[own].mean(0)[None], _square(a[own].mean(0)[None]), node.points)[0] if exact else np.arange(len(node.points))
        for j in np.argsort(mean, kind="stable"):
            low, high = wins.low[window].astype(float), wins.high[window].astype(float)
            visit(node.subtrees[j], window[node.alive(a[own], a2[own], low, high)[:, j]])

    if len(ids) and len(wins.own):
        visit(build_lower(x, np.arange(len(ids))), np.arange(len(wins.own)))
    window, score, who = wins.found
    if score.dtype == object:
        edge = (1 << 63) - 1
        over = np.array([float(s) if abs(s) > edge else 0.0 for s in score])
        score = np.array([max(-edge, min(edge, s)) for s in score], np.int64)
    else:
        over = np.zeros(len(score))
    akey = query.column("akey").to_numpy()[wins.own[window]] if len(window) else np.zeros(0, np.int64)
    return pa.table({"akey": pa.array(akey, pa.int64()), "tag": pa.array(wins.tag[window], pa.int32()), "id": pa.array(who, pa.int64()),
                     "score": pa.array(score.astype(np.int64)), "over": pa.array(over.astype(np.float64))})


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(c) for c in row] for row in x.tolist()], object).reshape(x.shape)


def vectors_of(table: DataFrame, id_col: str, label: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, label, v): floor(scale * x) of each component, as a whole double, and the label, given
    as SQL text over the table.  Rows without id, label or vector take no part, nor those with a
    null or non-finite component (also where the scaling makes it so)."""
    scaled = F.transform(F.col(vector), lambda c: F.lit(float(scale)) * c.cast("double"))
    named = table.select(F.col(id_col).cast("long").alias("id"), F.expr(label).cast("long").alias("label"), scaled.alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(_INF)))
    rows = named.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad)
    return arrow_map(rows, _floored, "id long, label long, v array<double>")


def _floored(batches):
    for batch in batches:
        v = batch.column(2)
        flat = pa.array(np.floor(v.flatten().to_numpy(zero_copy_only=False)))
        sizes = np.asarray(v.value_lengths())
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), flat)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["id", "label", "v"])


def _by_dims(batch: pa.RecordBatch, column: int):
    """(dims, row numbers, vectors) of a batch for each number of dimensions."""
    v = batch.column(column)
    sizes = np.asarray(v.value_lengths())
    flat, first = v.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        yield int(d), rows, flat[first[rows][:, None] + np.arange(d)].reshape(len(rows), d)


def _cells(trees: dict[int, Node]):
    """Rows with their number of dimensions and cell."""
    def run(batches):
        for batch in batches:
            cell, dims = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int32)
            for d, rows, x in _by_dims(batch, 2):
                dims[rows] = d
                cell[rows] = descend(trees[d], x) if d in trees else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(dims), pa.array(cell)], ["id", "label", "v", "dims", "cell"])
    return run


def _ranges(trees: dict[int, Node]):
    """Each task's ranges: (dims, node, subtree, nearest, farthest, norms)."""
    def run(batches):
        for n in (n for t in trees.values() for n in _nodes(t) if n.subtrees):
            n.clear()
        for batch in batches:
            for d, _, x in _by_dims(batch, 0):
                if d in trees:
                    descend(trees[d], x, widen=True)
        out = [(d, i, j, n.near[:, j].tolist(), n.far[:, j].tolist(), *n.norms[:, j].tolist())
               for d, t in trees.items() for i, n in enumerate(_nodes(t)) for j in range(len(n.subtrees)) if n.norms[0, j] < _INF]
        if out:
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                             ["dims", "node", "sub", "near", "far", "low", "high"])
    return run


def _fitted(vectors: DataFrame, sample_rows: int) -> dict[int, Node]:
    """Upper trees by number of dimensions, split points from a sample of at most ``sample_rows``
    rows (the smallest hashes), without ranges yet."""
    rows = vectors.count()
    sample = vectors.select("v", F.xxhash64("id", "v").alias("h")).orderBy("h", "v").limit(sample_rows).collect()
    by: dict[int, list] = {}
    for r in sample:
        by.setdefault(len(r["v"]), []).append(r["v"])
    return {d: build_upper(np.array(vs, float).reshape(len(vs), d), rows * len(vs) / len(sample)) for d, vs in by.items()}


def _fill(trees: dict[int, Node], cells: DataFrame) -> None:
    """Ranges over all rows; as many rows reach the driver as the trees have subtrees."""
    least = [F.min(F.get("near", F.lit(i))).alias(f"n{i}") for i in range(FANOUT)]
    most = [F.max(F.get("far", F.lit(i))).alias(f"f{i}") for i in range(FANOUT)]
    parts = arrow_map(cells.select("v"), _ranges(trees),
                      "dims int, node int, sub int, near array<double>, far array<double>, low double, high double")
    nodes = {d: _nodes(t) for d, t in trees.items()}
    for n in (n for ns in nodes.values() for n in ns if n.subtrees):
        n.clear()
    for r in parts.groupBy("dims", "node", "sub").agg(*least, *most, F.min("low").alias("low"), F.max("high").alias("high")).collect():
        n, j = nodes[r["dims"]][r["node"]], r["sub"]
        n.near[:, j] = [r[f"n{i}"] for i in range(len(n.subtrees))]
        n.far[:, j] = [r[f"f{i}"] for i in range(len(n.subtrees))]
        n.norms[:, j] = r["low"], r["high"]


def _reach(trees: dict[int, Node], k: int, lower: int, upper: int):
    """Anchors with the cells that may hold a row of one of their windows."""
    def run(batches):
        for batch in batches:
            out: list[list[int]] = [[0]] * batch.num_rows
            for d, rows, x in _by_dims(batch, 3):
                if d not in trees:
                    continue
                wins = _Windows(pa.Table.from_batches([batch.take(pa.array(rows))]), k, lower, upper)
                low, high = np.array(wins.low, float), np.array(wins.high, float)
                with np.errstate(all="ignore"):
                    x2 = _square(x)
                held: list[set] = [set() for _ in rows]

                def visit(node, w, x=x, x2=x2, wins=wins, low=low, high=high, held=held):
                    if not len(w):
                        return
                    if not node.subtrees:
                        for i in np.unique(wins.own[w]):
                            held[i].add(node.cell)
                        return
                    alive = node.alive(x[wins.own[w]], x2[wins.own[w]], low[w], high[w])
                    for j, sub in enumerate(node.subtrees):
                        visit(sub, w[alive[:, j]])

                visit(trees[d], np.arange(len(wins.own)))
                for i, r in enumerate(rows):
                    out[r] = sorted(held[i])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))],
                                             [*batch.schema.names, "cells"])
    return run


class _Index:
    """All rows in cells, dealt in parts, and the upper trees."""

    def __init__(self, vectors: DataFrame, lower: int, upper: int, k: int, sample_rows: int):
        self.bounds = k, lower, upper
        vectors = staged(vectors.distinct(), "vectors")
        self.trees = _fitted(vectors, sample_rows)
        self.rows = staged(arrow_map(vectors, _cells(self.trees), "id long, label long, v array<double>, dims int, cell int"), "cells")
        _fill(self.trees, self.rows)
        self.sizes = staged(self.rows.groupBy("dims", "cell").agg(
            F.ceil(F.count(F.lit(1)) / CELL_ROWS).cast("int").alias("parts")), "sizes")

    def search(self, anchors: DataFrame, home: bool) -> DataFrame:
        """(akey, tag, id, score, over, place): the k best rows of each window, in all cells that
        may hold one, or in one part of the anchor's own cell."""
        k, lower, upper = self.bounds
        if home:
            seen = anchors.withColumn("cell", F.col("home")).join(self.sizes, ["dims", "cell"]).withColumn(
                "part", F.pmod("akey", F.col("parts")).cast("int"))
        else:
            reach = arrow_map(anchors, _reach(self.trees, k, lower, upper), f"{_ANCHOR}, cells array<int>")
            seen = reach.withColumn("cell", F.explode("cells")).drop("cells").join(self.sizes, ["dims", "cell"]).withColumn(
                "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        seen = staged(seen.drop("parts", "home"), "visits")
        groups = seen.groupBy("dims", "cell", "part").agg(F.ceil(F.count(F.lit(1)) / GROUP_ROWS).cast("int").alias("groups"))
        keys = ["dims", "cell", "part", "grp"]
        left = self.rows.join(self.sizes, ["dims", "cell"]).withColumn(
            "part", F.pmod(F.xxhash64("id", "v"), F.col("parts")).cast("int")).drop("parts").join(
            groups, ["dims", "cell", "part"]).withColumn("grp", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
        right = seen.join(groups, ["dims", "cell", "part"]).withColumn(
            "grp", F.pmod(F.xxhash64("akey"), F.col("groups")).cast("int")).drop("groups")

        def run(key, cand: pa.Table, query: pa.Table) -> pa.Table:
            return search_part(cand, query, key[0].as_py(), k, lower, upper)

        ship(anchors.sparkSession)
        found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            run, "akey long, tag int, id long, score long, over double")
        order = Window.partitionBy("akey", "tag").orderBy(F.col("over").desc(), F.col("score").desc(), "id")
        return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def _with_windows(anchors: DataFrame, windows: DataFrame) -> DataFrame:
    """Anchors with the windows (akey, tag, same, top, top_over, least, least_over) of each."""
    lists = windows.groupBy("akey").agg(F.sort_array(F.collect_list(
        F.struct("tag", "same", "top", "top_over", "least", "least_over"))).alias("windows"))
    return anchors.drop("windows").join(lists, "akey").select(
        "akey", "id", "label", "v", "dims", "home", F.col("windows").cast(f"array<{_WINDOW}>"))


def mine_hard_negatives(vectors: DataFrame, anchors: str, positives: int = 5, negatives: int = 5,
                        lower: int = 80, upper: int = 100, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors``: (id, label, v), ``v`` whole doubles.  Anchors are the rows that the SQL condition
    ``anchors`` over ``id`` and ``label`` holds for.  An anchor's positives are the ``positives``
    best other rows of its label by inner product, ties to the smaller id; for each, the
    ``negatives`` best rows of other labels with lower/100 to upper/100 of its score.  ``positives``
    and ``negatives`` may differ; all where there are fewer.

    Rows with the anchor's id or another number of dimensions are not compared.  Rows repeated
    exactly count once; different rows of one id are anchors, positives and negatives each on their
    own.  Rows of null id, label or vector must be left out before (``vectors_of``).  Scores are
    exact; beyond 64 bits they are ranked as doubles and returned as the nearest long.  Empty
    vectors score 0.  No rows or no anchors give no rows.
    """
    k = max(positives, negatives)
    index = _Index(vectors.select("id", "label", "v"), lower, upper, k, sample_rows)
    base = staged(index.rows.filter(anchors).select(
        F.xxhash64("id", "label", "v").alias("akey"), "id", "label", "v", "dims", F.col("cell").alias("home")), "anchors")
    none = F.lit(None)

    def bounded(windows: DataFrame, found: DataFrame, want: int) -> DataFrame:
        """Windows with the score of the last wanted row found as their least."""
        last = found.filter(F.col("place") == want).select(
            "akey", "tag", F.col("score").alias("least"), F.col("over").alias("least_over"))
        return windows.drop("least", "least_over").join(last, ["akey", "tag"], "left")

    def best(windows: DataFrame, want: int) -> DataFrame:
        start = staged(_with_windows(base, windows), "start")
        near = index.search(start, home=True)
        tight = staged(_with_windows(base, bounded(windows, near, want)), "tight")
        return index.search(tight, home=False).filter(F.col("place") <= want)

    everything = base.select("akey", F.lit(0).alias("tag"), F.lit(True).alias("same"), none.cast("long").alias("top"),
                             none.cast("double").alias("top_over"), none.cast("long").alias("least"),
                             none.cast("double").alias("least_over"))
    liked = staged(best(everything, positives).select(
        "akey", F.col("place").alias("tag"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        F.col("over").alias("positive_over")), "positives")
    under = liked.select("akey", "tag", F.lit(False).alias("same"), F.col("positive_score").alias("top"),
                         F.col("positive_over").alias("top_over"), none.cast("long").alias("least"),
                         none.cast("double").alias("least_over"))
    hard = best(under, negatives)
    return hard.join(liked, ["akey", "tag"]).join(base.select("akey", F.col("id").alias("anchor_id")), "akey").select(
        "anchor_id", "positive_id", F.col("place").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
