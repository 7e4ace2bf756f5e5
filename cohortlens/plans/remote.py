"""Work-arrangement jobs: share by year, salary by arrangement, remote rate by role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.rules import non_blank
from cohortlens.operators.stats import gap_to_baseline, percent, period_delta, rank_within, share_of
from cohortlens.operators.distribution import percentile_stats
from cohortlens.plans.salary import salaried

YEAR = "survey_year"
WORKING = ("Employed FT", "Self-employed")
ARRANGEMENT_ORDER = ("In-person", "Hybrid", "Remote")


def remote_share(clean: DataFrame) -> DataFrame:
    """Share of each arrangement among working respondents per year and its change."""
    base = clean.where(F.col("remote_work_clean").isNotNull() & F.col("employment_clean").isin(*WORKING))
    shares = share_of(base, [YEAR, "remote_work_clean"], within=[YEAR], dp=1, pct_name="pct_of_year")
    shares = period_delta(shares, "remote_work_clean", YEAR, "pct_of_year", 1,
                          prev_name="prev_year_pct", delta_name="yoy_change_pp")
    return shares.select(YEAR, "remote_work_clean", "n", "pct_of_year", "prev_year_pct",
                         "yoy_change_pp").orderBy(YEAR, F.col("pct_of_year").desc())


def remote_salary(clean: DataFrame) -> DataFrame:
    """Salary percentiles per (year, arrangement); gap to the first present of
    In-person, Hybrid, Remote in that year; change against the previous row."""
    base = salaried(clean).where(F.col("remote_work_clean").isNotNull()).select(
        YEAR, "remote_work_clean", "salary")
    stats = percentile_stats(base, [YEAR, "remote_work_clean"])
    stats = gap_to_baseline(stats, [YEAR], "remote_work_clean", ARRANGEMENT_ORDER, "median_salary",
                            "gap_vs_inperson", full_frame=False)
    stats = period_delta(stats, "remote_work_clean", YEAR, "median_salary", 0,
                         prev_name="prev_year_median", delta_name="yoy_salary_change")
    return stats.select(YEAR, "remote_work_clean", "n", "p25", "median_salary", "p75", "gap_vs_inperson",
                        "prev_year_median", "yoy_salary_change").orderBy(YEAR, F.col("median_salary").desc())


def remote_by_role(clean: DataFrame, min_n: int = 100) -> DataFrame:
    """Per (year, role) with at least ``min_n`` working respondents: % remote / hybrid /
    in-person and ranks by the remote and in-person ratios (unrounded)."""
    base = clean.where(
        F.col("remote_work_clean").isNotNull()
        & non_blank("dev_type_primary", trimmed=False)
        & F.col("employment_clean").isin(*WORKING)
    )

    def count_of(label):
        return F.sum(F.when(F.col("remote_work_clean") == label, 1).otherwise(0)).cast("long")

    totals = base.groupBy(YEAR, "dev_type_primary").agg(
        F.count(F.lit(1)).alias("total_n"),
        count_of("Remote").alias("remote_n"),
        count_of("Hybrid").alias("hybrid_n"),
        count_of("In-person").alias("inperson_n"),
    ).where(F.col("total_n") >= min_n)
    out = rank_within(totals, YEAR, percent("remote_n", "total_n"), "rank_most_remote")
    out = rank_within(out, YEAR, percent("inperson_n", "total_n"), "rank_most_inperson")
    return out.select(
        YEAR, "dev_type_primary", "total_n",
        F.round(percent("remote_n", "total_n"), 1).alias("pct_remote"),
        F.round(percent("hybrid_n", "total_n"), 1).alias("pct_hybrid"),
        F.round(percent("inperson_n", "total_n"), 1).alias("pct_inperson"),
        "rank_most_remote", "rank_most_inperson",
    ).orderBy(YEAR, F.col("pct_remote").desc())
