"""Exact top-k by inner product: columnar branch and bound.

Candidates are dealt into cells of bounded size and queries into groups of bounded size; a
task has one cell and one group.  In a cell the components lie dimension by dimension.
Scores accumulate over blocks of dimensions; after each block a candidate stays only if its
partial score plus the largest possible rest (product of the remaining norms) can reach
the query's current k-th best, and the survivors are compacted.  The k best of each cell
meet in a grouped rank per query.  All arithmetic is on whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.shipping import arrow_map, ship

CELL_ROWS, GROUP_ROWS = 8192, 4096
DIM_BLOCK, FIRST_ROWS = 8, 512
_EXACT = float(1 << 53)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 1024) -> DataFrame:
    """(id, v): floor(scale * x) of each component, as a whole double of any size.  Rows without
    an id, and vectors that are null or hold null or non-finite components (also where the scaling
    makes them so), are left out."""
    scaled = F.transform(F.col(vector_col), lambda c: F.lit(float(scale)) * c.cast("double"))
    named = vectors.select(F.col(id_col).cast("long").alias("id"), scaled.alias("v"))
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))

    def floored(batches):
        for batch in batches:
            v = batch.column(1)
            ends = np.r_[0, np.cumsum(np.asarray(v.value_lengths()))].astype(np.int32)
            whole = pa.array(np.floor(v.flatten().to_numpy(zero_copy_only=False)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends), whole)], ["id", "v"])

    return arrow_map(named.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad), floored, "id long, v array<double>")


def _typed(x: np.ndarray, kind: type) -> np.ndarray:
    """Whole doubles as they are, or as Python integers."""
    return x if kind is np.float64 else np.array([[int(c) for c in row] for row in x.tolist()], object).reshape(x.shape)


def _rest_norms(x: np.ndarray) -> np.ndarray:
    """Norm of the components from each block on, rounded up; one row per block border."""
    borders = range(0, len(x) + DIM_BLOCK, DIM_BLOCK)
    with np.errstate(over="ignore"):
        square = x.astype(np.float64) ** 2
        return np.stack([np.sqrt(square[b:].sum(0)) * (1 + 1e-9) for b in borders])


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best: higher score first, then smaller id."""
    if len(score) > 4 * k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= floor)
        return near[np.lexsort((ids[near], -score[near]))[:k]]
    return np.lexsort((ids, -score))[:k]


def search_cell(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """For each column of ``q`` (dims, queries): the ids and scores of its k best columns of
    ``x`` (dims, candidates) other than those with its own id."""
    dims = len(x)
    bound = (np.abs(q).max(initial=0).astype(np.float64) * np.abs(x).max(initial=0).astype(np.float64)) * max(dims, 1)
    kind = np.float64 if bound < _EXACT else object
    qn, xn = _rest_norms(q), _rest_norms(x)
    order = np.argsort(-xn[0], kind="stable")
    ids, xn = ids[order], xn[:, order]
    x, q = _typed(np.ascontiguousarray(x[:, order]), kind), _typed(q, kind)
    head = min(len(ids), max(FIRST_ROWS, 4 * k))
    first = q.T @ x[:, :head] if dims else np.zeros((len(q_ids), head))
    for j, own in enumerate(q_ids):
        usable = np.flatnonzero(ids[:head] != own)
        top = usable[_best(first[j, usable], ids[usable], k)]
        score, who = first[j, top], ids[top]
        if head < len(ids):
            alive = head + np.flatnonzero(ids[head:] != own)
            sums = np.zeros(len(alive), kind)
            for b in range(0, dims, DIM_BLOCK):
                sums = sums + q[b:b + DIM_BLOCK, j] @ x[b:b + DIM_BLOCK, alive]
                if len(score) == k:
                    block = b // DIM_BLOCK + 1
                    reach = sums.astype(np.float64) * (1 + 1e-12 * np.sign(sums.astype(np.float64))) \
                        + qn[block, j] * xn[block, alive]
                    stay = ~(reach < float(score[-1]) * (1 - 1e-12 * np.sign(float(score[-1]))) - 1e-6)
                    alive, sums = alive[stay], sums[stay]
                if not len(alive):
                    break
            who, score = np.r_[who, ids[alive]], np.r_[score, sums]
            top = _best(score, who, k)
            who, score = who[top], score[top]
        yield own, who, score


def _matrix(table: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By number of dimensions: ids and the vectors laid out dimension by dimension."""
    ids = table.column("id").to_numpy()
    column = table.column("v").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    length = np.asarray(column.value_lengths().fill_null(0)) if len(column) else np.zeros(0, int)
    flat = column.flatten().to_numpy(zero_copy_only=False) if len(column) else np.zeros(0)
    first = np.cumsum(length) - length
    out = {}
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        out[int(d)] = ids[rows], np.ascontiguousarray(flat[first[rows][:, None] + np.arange(d)].T)
    return out


def exact_topk(candidates: DataFrame, queries: DataFrame, k: int = 10,
               cell_rows: int = CELL_ROWS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` (id, v) the k rows of
    ``candidates`` (id, v) with the highest inner product, ties to the smaller id; all where
    there are fewer.  Candidates with the query's id or another number of dimensions are not
    compared.  Rows repeated exactly count once.  An empty side gives no rows.  Scores are exact;
    those beyond 64 bits are ranked as doubles between tasks and returned as the nearest long.

    ``cell_rows`` and ``group_rows`` bound what a task holds; a grid of cells and groups
    covers every query and every candidate.
    """
    candidates, queries = candidates.distinct(), queries.distinct()
    n, m = candidates.count(), queries.count()
    cells, groups = max(1, -(-n // cell_rows)), max(1, -(-m // group_rows))

    def dealt(df, own, parts, other, copies):
        return df.select("id", "v", F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int").alias(own)).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))

    left = dealt(candidates, "cell", cells, "grp", groups).groupBy("cell", "grp")
    right = dealt(queries, "grp", groups, "cell", cells).groupBy("cell", "grp")

    def run(key, cand: pa.Table, query: pa.Table) -> pa.Table:
        found = []
        have = _matrix(cand) if cand.num_rows else {}
        for d, (q_ids, q) in (_matrix(query) if query.num_rows else {}).items():
            if d in have:
                for own, who, score in search_cell(q_ids, q, *have[d], k):
                    found.append((np.full(len(who), own), who, score))
        cols = [np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.int64) for c in range(3)]
        edge = np.iinfo(np.int64).max
        beyond = cols[2].dtype == object
        over = [float(s) if abs(s) > edge else 0.0 for s in cols[2]] if beyond else np.zeros(len(cols[2]))
        score = [max(-edge, min(edge, int(s))) for s in cols[2]] if beyond else cols[2].astype(np.int64)
        return pa.table({"query_id": pa.array(cols[0].astype(np.int64)), "vec_id": pa.array(cols[1].astype(np.int64)),
                         "score": pa.array(score, pa.int64()), "over": pa.array(over, pa.float64())})

    ship(candidates.sparkSession)
    local = left.cogroup(right).applyInArrow(run, "query_id long, vec_id long, score long, over double")
    by = Window.partitionBy("query_id").orderBy(F.col("over").desc(), F.col("score").desc(), "vec_id")
    return local.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
