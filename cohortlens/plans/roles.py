"""Developer-role jobs: salary rank movement, decile spread, AI adoption vs salary,
headcount share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.rules import non_blank
from cohortlens.operators.distribution import cohort_median_gap, ntile_bounds, percentile_stats
from cohortlens.operators.stats import percent, period_delta, rank_within, share_of
from cohortlens.plans.salary import salaried

YEAR = "survey_year"
ROLE = "dev_type_primary"


def _paid_roles(clean: DataFrame) -> DataFrame:
    return salaried(clean).where(non_blank(ROLE, trimmed=False))


def role_rank_change(clean: DataFrame, min_n: int = 100) -> DataFrame:
    """Median salary rank of each role per year and how many places it moved since the
    role's previous row; IQR over median from unrounded percentiles."""
    base = _paid_roles(clean).select(YEAR, ROLE, "salary")
    stats = percentile_stats(base, [YEAR, ROLE], min_n=min_n, keep_raw=True)
    stats = stats.withColumn(
        "iqr_over_median",
        F.round((F.col("_raw_p75") - F.col("_raw_p25")) / F.nullif(F.col("_raw_median_salary"), F.lit(0.0)), 2))
    stats = rank_within(stats, YEAR, "median_salary", "salary_rank")
    stats = period_delta(stats, ROLE, YEAR, "salary_rank", None, prev_name="prev_year_rank")
    return stats.select(
        YEAR, ROLE, "n", "median_salary", "salary_rank", "prev_year_rank",
        (F.col("prev_year_rank") - F.col("salary_rank")).alias("rank_change"),
        "iqr_over_median",
    ).orderBy(YEAR, "salary_rank")


def role_spread(clean: DataFrame, min_n: int = 100) -> DataFrame:
    """Deciles (NTILE(10)) within (year, role): the top of decile 1, the bottom of
    decile 9, their ratio and its rank per year; median for reference."""
    rows = _paid_roles(clean).select(YEAR, ROLE, "salary")
    bounds = ntile_bounds(rows, [YEAR, ROLE], "salary", 10, ceiling_of=1, floor_of=9)
    out = bounds.where(F.col("total_n") >= min_n).withColumn(
        "_ratio", F.col("d9_floor") / F.nullif(F.col("d1_ceiling"), F.lit(0.0)))
    out = rank_within(out, YEAR, "_ratio", "rank_by_spread")
    return out.select(YEAR, ROLE, "total_n", "d1_ceiling", "median_salary", "d9_floor",
                      F.round("_ratio", 1).alias("d9_d1_ratio"), "rank_by_spread").orderBy(
        YEAR, "rank_by_spread")


def ai_salary(clean: DataFrame, min_n: int = 100, first_year: int = 2023) -> DataFrame:
    """Per (year, role): share of AI-tool users, median salary of users and non-users,
    the premium, and the rank by adoption."""
    rows = _paid_roles(clean).where((F.col(YEAR) >= first_year) & F.col("ai_user").isNotNull()).select(
        YEAR, ROLE, "ai_user", "salary")
    # one pass over the rows: per-cohort sizes and medians, then sizes summed per role
    out = (
        cohort_median_gap(rows, [YEAR, ROLE], "ai_user", "salary")
        .where(F.col("total_n") >= min_n)
        .withColumn("pct_ai_users", F.round(percent("flag_n", "total_n"), 1))
    )
    out = rank_within(out, YEAR, "pct_ai_users", "rank_by_ai_adoption")
    return out.select(
        YEAR, ROLE, "total_n", "pct_ai_users", "median_salary_ai_users", "median_salary_non_ai",
        "ai_salary_premium",
        "rank_by_ai_adoption",
    ).orderBy(YEAR, F.col("pct_ai_users").desc())


def role_headcount(clean: DataFrame, min_n: int = 100) -> DataFrame:
    """Share of each role among respondents naming a role, per year (denominator taken
    before the ``min_n`` gate), and its change against the role's previous row."""
    base = clean.where(non_blank(ROLE, trimmed=False))
    # the year total is the sum of its role counts: one scan, share taken before the gate
    out = share_of(base, [YEAR, ROLE], within=[YEAR], dp=2, pct_name="pct_of_year").where(
        F.col("n") >= min_n)
    out = period_delta(out, ROLE, YEAR, "pct_of_year", 2, prev_name="prev_year_pct",
                       delta_name="yoy_share_change")
    return out.select(YEAR, ROLE, "n", "pct_of_year", "prev_year_pct", "yoy_share_change").orderBy(
        YEAR, F.col("pct_of_year").desc())
