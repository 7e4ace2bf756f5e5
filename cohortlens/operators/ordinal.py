"""Exact order statistics per group, computed without gathering a group into one task.

``PERCENTILE_CONT`` and ``NTILE`` need the rows at given positions of a group's sort order.
A window partitioned by the group puts a whole group (a survey year, a dominant country)
into one task.  Two ways lead around that:

*Values at positions* (percentiles, ends of buckets) are found by counting, in two scans:

1. every value falls into a *block* by a fixed monotone function (4096 blocks for each
   doubling of its size), and rows are counted by (group, block).  Spark counts before it
   shuffles, so ties and hot groups cost one row per task, and the number of blocks depends
   on the range of the values, not on the number of rows.  A running sum over a group's blocks
   gives the group's size and the block of every wanted position.  The blocks hit are a
   written table: its size is known when the second scan is planned, so Spark broadcasts it
   when it is small and joins by shuffle when it is not;
2. only rows of those blocks are counted by value, and a running sum inside the block gives the
   value at each position.

*A bucket for every row* (NTILE) needs every row's position.  Rows are dealt by ranges of
(group, order) and sorted, each with its place in its task, as a written table; rows per (task,
group) are counted, their running sum over the tasks is each task's first position, and the
bucket is a formula of position and group size.  Ties are split by the last order column, so a
value held by half of the rows spreads over as many tasks as its share of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.sources.staging import staged

BLOCKS_PER_DOUBLING = 4096
_SHIFT = 1 << 23  # larger than any doubling of a double, times the blocks in it
_END = 1 << 25  # beyond every finite value's block


def block_of(value: Column) -> Column:
    """A whole number that never falls as ``value`` rises; infinities and NaN (the largest, as
    Spark sorts it) have blocks of their own."""
    x = value.cast("double")
    size = F.floor(F.log2(F.abs(x)) * BLOCKS_PER_DOUBLING) + _SHIFT
    finite = F.when(x > 0, size).when(x < 0, -size).otherwise(F.lit(0)).cast("long")
    endless = F.lit(float("inf"))
    return (F.when(F.isnan(x), F.lit(_END + 1)).when(x == endless, F.lit(_END)).when(x == -endless, F.lit(-_END))
            .otherwise(finite).cast("long"))


def _match(keys: Sequence[str], prefix: str) -> Column:
    """Each key equals the column named ``prefix`` + key; NULL equals NULL."""
    return F.expr(" and ".join(f"`{k}` <=> `{prefix}{k}`" for k in keys))


def _renamed(df: DataFrame, keys: Sequence[str], prefix: str, *more: str) -> DataFrame:
    return df.selectExpr(*[f"`{k}` as `{prefix}{k}`" for k in keys], *[f"`{c}`" for c in more])


def _spots(positions: dict[str, Column | str]) -> Column:
    """The positions, Columns or SQL text over ``_n``, as (tag, pos) pairs."""
    return F.array(*[F.expr(f"named_struct('tag', '{t}', 'pos', cast({p} as bigint))") if isinstance(p, str)
                     else F.struct(F.lit(t).alias("tag"), p.cast("long").alias("pos")) for t, p in positions.items()])


#: Those of ``_spots`` within the row's ``count`` rows up to ``_end``, from the row's start.
_INSIDE = """transform(filter(_spots, s -> s.pos >= _end - count and s.pos < _end),
             s -> named_struct('tag', s.tag, 'pos', s.pos - _end + count))"""


def _running(counted: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    cols = ", ".join(f"`{k}`" for k in keys)
    return counted.selectExpr("*", f"sum(count) over (partition by {cols} order by `{by}` "
                                   "rows between unbounded preceding and current row) as _end")


def _located(rows: DataFrame, keys: Sequence[str], value: str, given: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(keys, value, _n, _spots): the rows' values that hold wanted positions, with those
    positions counted from the first row of that value.  ``given`` adds ``_spots`` to a table of
    (keys, ..., _n); ``rows`` is scanned twice."""
    cols = ", ".join(f"`{k}`" for k in keys)
    blocked = rows.select(*keys, value, block_of(F.col(value)).alias("_block"))
    counted = _running(blocked.groupBy(*keys, "_block").count(), keys, "_block")
    sized = given(counted.selectExpr("*", f"sum(count) over (partition by {cols}) as _n"))
    hit = sized.selectExpr(*[f"`{k}` as `_h_{k}`" for k in (*keys, "_block")], "_n", f"{_INSIDE} as _spots").where("size(_spots) > 0")
    found = staged(hit, "blocks")
    match = _match([*keys, "_block"], "_h_")
    near = blocked.join(found, match, "left_semi").groupBy(*keys, "_block", value).count()
    ends = _running(near, [*keys, "_block"], value).join(found, match)
    return ends.selectExpr(*[f"`{k}`" for k in keys], f"`{value}`", "_n", f"{_INSIDE} as _spots").where("size(_spots) > 0")


def at_positions(df: DataFrame, group: Sequence[str], order: Sequence[str], wanted: DataFrame) -> DataFrame:
    """(group, order, _tag): the row of each group at each wanted (group, _tag, _pos); positions
    from 0 in the order of the numeric, non-NULL columns ``order``.  Two scans for each column."""
    keys, rows = list(group), df.select(*group, *order)
    for column in order:
        pairs = wanted.groupBy(*keys).agg(F.collect_list(
            F.struct(F.col("_tag").alias("tag"), F.col("_pos").cast("long").alias("pos"))).alias("_spots"))
        lists = _renamed(pairs, keys, "_w_", "_spots")

        def given(sized: DataFrame, keys=keys, lists=lists) -> DataFrame:
            return sized.join(lists, _match(keys, "_w_")).drop(*["_w_" + k for k in keys])

        found = _located(rows, keys, column, given)
        keys = [*keys, column]
        wanted = found.selectExpr(*[f"`{k}`" for k in keys], "inline(_spots) as (_tag, _pos)")
        if column != order[-1]:
            wanted = staged(wanted, "places")
            rows = rows.join(_renamed(wanted, keys, "_j_").distinct(), _match(keys, "_j_"), "left_semi")
    return wanted.drop("_pos")


def group_sizes(df: DataFrame, group: Sequence[str], name: str = "_n") -> DataFrame:
    return df.groupBy(*group).agg(F.count(F.lit(1)).alias(name))


def values_at(df: DataFrame, group: Sequence[str], value: str, positions: dict[str, Column | str]) -> DataFrame:
    """One row per group: ``_n`` and, named by tag, ``value`` at each position (a Column or SQL text
    over ``_n``; NULL where the group is too small).  NULL values do not count.  Two scans of
    ``df``."""
    rows = df.select(*group, value).where(f"`{value}` is not null")
    spots = _spots({"": "0", **positions})  # the first row, so that every group is found
    found = _located(rows, list(group), value, lambda sized: sized.withColumn("_spots", spots))
    return found.groupBy(*group).agg(F.expr("first(_n) as _n"), *[
        F.expr(f"max(case when exists(_spots, s -> s.tag = '{t}') then `{value}` end) as `{t}`") for t in positions])


def exact_percentiles(df: DataFrame, group: Sequence[str], value: str, probs: Sequence[float],
                      names: Sequence[str], stabilise: int | None = 6,
                      extra: dict[str, Column | str] | None = None) -> DataFrame:
    """One row per group: ``_n`` (non-NULL count) and continuous percentiles (linear between the
    order statistics at floor and ceil of (n-1)p).

    ``stabilise`` rounds each to that many decimals, so callers that round further see the exact
    value and not last-bit interpolation noise.  ``extra`` adds values at other positions.  NaN
    counts as the largest value, as Spark sorts it; a percentile between two values of which one
    is infinite or NaN is what double arithmetic gives, between two equal ones that value."""
    at = {name: f"(_n - 1) * {float(p)!r}D" for name, p in zip(names, probs, strict=True)}
    spots = {f"_lo_{k}": f"floor({a})" for k, a in at.items()} | {f"_hi_{k}": f"ceil({a})" for k, a in at.items()}
    out = values_at(df, group, value, spots | (extra or {}))
    cols = []
    for k, a in at.items():
        low, high = f"`_lo_{k}`", f"`_hi_{k}`"
        between = f"case when {low} = {high} then {low} else {low} + ({high} - {low}) * ({a} - floor({a})) end"
        cols.append(f"{between if stabilise is None else f'round({between}, {stabilise})'} as `{k}`")
    return out.selectExpr(*[f"`{g}`" for g in group], "_n", *cols, *[f"`{e}`" for e in extra or {}])


def bucket_start(j: int, k: int, n: Column | str = "_n") -> Column:
    """Position of the first row of bucket ``j`` (from 1) of NTILE(k) over ``n`` rows: the first
    ``n mod k`` buckets hold one row more."""
    n = F.col(n) if isinstance(n, str) else n
    return (j - 1) * F.floor(n / k) + F.least(F.lit(j - 1), n % k)


def bucket_at(position: Column, k: int, n: Column) -> Column:
    """The bucket (from 1) of NTILE(k) over ``n`` rows at a position from 0."""
    small, longer = F.floor(n / k), n % k
    head = longer * (small + 1)  # rows in the buckets with one row more
    late = longer + F.floor((position - head) / F.greatest(small, F.lit(1)))
    return (F.when(position < head, F.floor(position / (small + 1))).otherwise(late) + 1).cast("int")


def placed(df: DataFrame, group: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Every row of ``df`` with its position (``_pos``, from 0) in its group's order and the
    group's size (``_n``); the order must be unique in a group.

    ``df`` is scanned twice (Spark samples it for the ranges) and shuffled once.  The table of
    rows per (task, group) has at most tasks + groups rows."""
    task = F.spark_partition_id().alias("_task")
    dealt = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    rows = staged(dealt.select("*", task, F.monotonically_increasing_id().alias("_at")), "placed")
    parts = rows.groupBy(*group, "_task").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    own = "partition by " + ", ".join(f"`{g}`" for g in group)
    starts = parts.selectExpr(*[f"`{k}` as `_g_{k}`" for k in (*group, "_task")], "_first", f"sum(_rows) over ({own}) as _n",
                              f"sum(_rows) over ({own} order by _task rows between unbounded preceding and current row) "
                              "- _rows as _ahead")
    starts = staged(starts, "starts")
    return rows.join(starts, _match([*group, "_task"], "_g_")).select(
        *df.columns, (F.col("_at") - F.col("_first") + F.col("_ahead")).alias("_pos"), "_n")


def ntile(df: DataFrame, group: Sequence[str], order: Sequence[str], k: int, name: str) -> DataFrame:
    """``NTILE(k) OVER (PARTITION BY group ORDER BY order)`` as a new column.  ``order`` must be
    unique within a group.  The result reads a written table, so using it twice does not read
    ``df`` again."""
    return placed(df, group, order).select(*df.columns, bucket_at(F.col("_pos"), k, F.col("_n")).alias(name))
