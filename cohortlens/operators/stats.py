"""Composite trend operators shared by the audit and analytic jobs.

All of them are DataFrame -> DataFrame compositions of built-in expressions.  The
windowed ones (shares, period deltas, ranks, baselines) are applied to *aggregated*
frames — one row per (period, category) — so their window partitions hold a handful
of rows however large the respondent table grows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def percent(part: str | Column, whole: str | Column) -> Column:
    """``100 * part / whole`` in double arithmetic (a decimal literal would give a
    decimal(30,6) that rounds twice)."""
    p = F.col(part) if isinstance(part, str) else part
    w = F.col(whole) if isinstance(whole, str) else whole
    return F.lit(100.0) * p / w


def _cols(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def adoption_rate(long: DataFrame | None, base: DataFrame, period: str, item: str, entity: str,
                  dp: int = 2, count_name: str = "user_count", pct_name: str = "adoption_pct",
                  counts: DataFrame | None = None) -> DataFrame:
    """Distinct entities per (period, item) over the per-period base count, in percent.
    ``counts`` (period, item, ``count_name``) takes the place of ``long`` where they are stored.

    ``base`` is one row per entity-period eligible for the denominator.  The denominator
    is one row per period, so it is joined by broadcast (its size is the number of
    periods, not of respondents)."""
    totals = base.groupBy(period).agg(F.count(F.lit(1)).alias("_total"))
    if counts is None:
        counts = long.groupBy(period, item).agg(F.countDistinct(entity).alias(count_name))
    return (
        counts.join(F.broadcast(totals), period)
        .select(period, item, F.col(count_name), F.col("_total").alias("total_respondents"),
                F.round(percent(count_name, "_total"), dp).alias(pct_name))
    )


def share_of(df: DataFrame, group: Sequence[str], within: Sequence[str] = (), dp: int = 1,
             n_name: str = "n", pct_name: str = "pct") -> DataFrame:
    """Count per group and its percent of the ``within`` partition (or of the grand total
    when ``within`` is empty).

    The denominator is its own aggregate joined back, not an unpartitioned window, so
    the grouped rows are never moved into one task: the grand total is one row and is
    broadcast; per-partition totals are joined by key (AQE broadcasts them when small).
    """
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias(n_name))
    return with_total_share(counts, n_name, within, dp, pct_name)


def with_total_share(counts: DataFrame, n_name: str, within: Sequence[str] = (), dp: int = 1,
                     pct_name: str = "pct") -> DataFrame:
    """Add ``pct_name`` = rounded percent of ``n_name`` in its ``within`` total."""
    within = list(within)
    if within:
        totals = counts.groupBy(*within).agg(F.sum(n_name).alias("_total"))
        joined = counts.join(totals, [counts[c].eqNullSafe(totals[c]) for c in within]).drop(
            *[totals[c] for c in within])
    else:
        totals = counts.agg(F.sum(n_name).alias("_total"), F.lit(1).alias("_one"))
        joined = counts.withColumn("_one", F.lit(1)).join(F.broadcast(totals), "_one").drop("_one")
    return joined.withColumn(pct_name, F.round(percent(n_name, "_total"), dp)).drop("_total")


def period_delta(df: DataFrame, entity: str | Sequence[str], period: str, value: str,
                 dp: int | None, prev_name: str, delta_name: str | None = None,
                 next_name: str | None = None) -> DataFrame:
    """Previous (and optionally next) row's value per entity in period order, and the
    rounded difference.  Row-based: a missing period is skipped, not NULL-filled."""
    w = Window.partitionBy(*_cols(entity)).orderBy(period)
    out = df.withColumn(prev_name, F.lag(value).over(w))
    if delta_name:
        diff = F.col(value) - F.col(prev_name)
        out = out.withColumn(delta_name, F.round(diff, dp) if dp is not None else diff)
    if next_name:
        out = out.withColumn(next_name, F.lead(value).over(w))
    return out


def rank_within(df: DataFrame, period: str | Sequence[str], order: str | Column, name: str) -> DataFrame:
    """RANK() per period by ``order`` descending (ties share a rank), as bigint."""
    o = F.col(order) if isinstance(order, str) else order
    w = Window.partitionBy(*_cols(period)).orderBy(o.desc())
    return df.withColumn(name, F.rank().over(w).cast("long"))


def gap_to_baseline(df: DataFrame, within: Sequence[str], category: str, order: Sequence[str],
                    value: str, name: str, full_frame: bool = True, dp: int = 0) -> DataFrame:
    """``value`` minus the value of the first present category in ``order`` (per
    ``within``).  ``full_frame=False`` keeps SQL's default RANGE frame, where rows whose
    order key ties the first are peers of it and see the same first value."""
    key = F.lit(None).cast("int")
    for i, c in reversed(list(enumerate(order))):
        key = F.when(F.col(category) == F.lit(c), F.lit(i + 1)).otherwise(key)
    w = Window.partitionBy(*within).orderBy(key.asc_nulls_last())
    if full_frame:
        w = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(name, F.round(F.col(value) - F.first(value).over(w), dp))


def endpoint_compare(rates: DataFrame, entity: str, period: str, value: str, p0: int, p1: int,
                     floor: float, dp: int = 2) -> DataFrame:
    """Pivot two periods side by side, keep entities present in both with either side at
    or above ``floor``; change and a Rising / Declining / Stable label."""
    a, b = f"pct_{p0}", f"pct_{p1}"
    wide = rates.where(F.col(period).isin(p0, p1)).groupBy(entity).agg(
        F.max(F.when(F.col(period) == p0, F.col(value))).alias(a),
        F.max(F.when(F.col(period) == p1, F.col(value))).alias(b),
    )
    return (
        wide.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .where((F.col(a) >= floor) | (F.col(b) >= floor))
        .select(
            entity, a, b,
            F.round(F.col(b) - F.col(a), dp).alias("total_change_pp"),
            F.when(F.col(b) > F.col(a), "Rising").when(F.col(b) < F.col(a), "Declining")
            .otherwise("Stable").alias("trend_direction"),
        )
    )


def topk_keys(df: DataFrame, key: str, k: int, min_n: int) -> DataFrame:
    """The ``k`` most frequent keys having at least ``min_n`` rows (ties broken by key).
    The count is projected before the limit, and the result has at most ``k`` rows."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= min_n)
        .orderBy(F.col("_n").desc(), F.col(key).asc_nulls_first())
        .limit(k)
        .select(key)
    )


def topk_semi(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose key is among ``keys`` (a NULL key never matches, as SQL IN).
    ``keys`` has a proven bound (the k of ``topk_keys``), so it is broadcast."""
    return df.join(F.broadcast(keys), key, "left_semi")


def unmatched_values(df: DataFrame, raw: str, cleaned: str | None, group: Sequence[str] = (),
                     out_name: str = "unmatched_raw_value", top: int | None = None,
                     when: Column | None = None) -> DataFrame:
    """Raw labels that no cleaning rule caught (cleaned NULL), with counts.
    ``when`` replaces the default filter (e.g. cleaned == 'Other')."""
    cond = when if when is not None else (F.col(raw).isNotNull() & F.col(cleaned).isNull())
    out = (
        df.where(cond).groupBy(*group, F.col(raw).alias(out_name))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if top is not None:
        out = out.orderBy(F.col("n").desc(), F.col(out_name).asc_nulls_first()).limit(top)
    return out
