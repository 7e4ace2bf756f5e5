"""Distribution operators over a numeric answer: percentile tables with a minimum
sample, bucket mixes and bucket edges, and filtered-cohort medians.  All exact, all
built on the distributed order statistics of ``operators.ordinal``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.ordinal import bucket_start, exact_percentiles, ntile
from cohortlens.operators.stats import percent

QUARTILES = (0.25, 0.5, 0.75)


def percentile_stats(df: DataFrame, group: Sequence[str], value: str = "salary",
                     probs: Sequence[float] = QUARTILES,
                     names: Sequence[str] = ("p25", "median_salary", "p75"),
                     min_n: int | None = None, n_name: str = "n", keep_raw: bool = False) -> DataFrame:
    """Per group: non-NULL count, exact percentiles rounded to whole units, and an
    optional minimum-size gate.  ``keep_raw`` also returns the unrounded values as
    ``_raw_<name>`` (for spreads such as IQR computed before rounding)."""
    q = exact_percentiles(df, list(group), value, probs, [f"_raw_{n}" for n in names])
    if min_n is not None:
        q = q.where(F.col("_n") >= min_n)
    return q.select(*group, F.col("_n").alias(n_name),
                    *[F.round(F.col(f"_raw_{n}")).alias(n) for n in names],
                    *([F.col(f"_raw_{n}") for n in names] if keep_raw else []))


def _count() -> Column:
    return F.count(F.lit(1))


def ntile_mix(df: DataFrame, bucket_group: Sequence[str], order: Sequence[str], k: int,
              report_group: Sequence[str], shares: dict[str, int], dp: int = 1) -> DataFrame:
    """Bucket rows by NTILE(k) within ``bucket_group``, then per ``report_group``: row count and
    the percent of rows in each bucket named in ``shares`` (name -> bucket)."""
    return bucket_mix(ntile(df, list(bucket_group), list(order), k, "_bucket"), "_bucket", report_group, shares, dp)


def bucket_mix(df: DataFrame, bucket: str, report_group: Sequence[str], shares: dict[str, int], dp: int = 1) -> DataFrame:
    """Per ``report_group``: row count and the percent of rows in each bucket named in ``shares``."""
    return df.groupBy(*report_group).agg(
        _count().alias("total_n"),
        *[F.round(percent(F.sum(F.when(F.col(bucket) == q, 1).otherwise(0)), _count()), dp).alias(name)
          for name, q in shares.items()],
    )


def ntile_bounds(df: DataFrame, group: Sequence[str], value: str, k: int, ceiling_of: int, floor_of: int) -> DataFrame:
    """NTILE(k) by ``value`` within ``group``, then per group: row count, the largest value of
    bucket ``ceiling_of``, the smallest of bucket ``floor_of`` (NULL where empty) and the exact
    median rounded to whole units.  A bucket's ends are the values at its first and last
    position, so no row needs its bucket."""
    n, high, low = F.col("_n"), f"d{ceiling_of}_ceiling", f"d{floor_of}_floor"
    last = bucket_start(ceiling_of + 1, k) - 1
    spots = {high: F.when(last >= bucket_start(ceiling_of, k), last).otherwise(n),
             low: F.when(bucket_start(floor_of + 1, k) > bucket_start(floor_of, k), bucket_start(floor_of, k)).otherwise(n)}
    q = exact_percentiles(df, list(group), value, (0.5,), ("_m",), extra=spots)
    return q.select(*group, n.alias("total_n"), high, low, F.round("_m").alias("median_salary"))


def cohort_median_gap(df: DataFrame, group: Sequence[str], flag: str, value: str,
                      names: tuple[str, str] = ("median_salary_ai_users", "median_salary_non_ai"),
                      gap_name: str = "ai_salary_premium") -> DataFrame:
    """Per group: the size of the whole group (``total_n``) and of its flagged cohort
    (``flag_n``), the exact median of ``value`` where ``flag`` is true and where it is
    false, and their difference (NULL when either cohort is empty).  Everything comes
    from one per-cohort pass: sizes are summed from the cohort counts."""
    cohorts = percentile_stats(df, [*group, flag], value, probs=(0.5,), names=("_m",), n_name="_cn")
    on, off = names
    return cohorts.groupBy(*group).agg(
        F.sum("_cn").cast("long").alias("total_n"),
        F.sum(F.when(F.col(flag), F.col("_cn")).otherwise(0)).cast("long").alias("flag_n"),
        F.max(F.when(F.col(flag), F.col("_m"))).alias(on),
        F.max(F.when(~F.col(flag), F.col("_m"))).alias(off),
    ).withColumn(gap_name, F.round(F.col(on) - F.col(off)))
