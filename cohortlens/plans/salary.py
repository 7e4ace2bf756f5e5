"""Salary jobs: country percentiles, experience premium, role mix over quartiles.

Percentiles are exact (``operators.ordinal``): positions are found by counting blocks of
values in two scans, so a country or year holding a large share of respondents is not gathered
into one task, and ties cost nothing.
Predicates on the cleaned columns reach the parquet reader because the cleaning view is
materialised by the ingest step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.rules import non_blank
from cohortlens.operators.cleaning import bracket_order
from cohortlens.operators.distribution import bucket_mix, percentile_stats
from cohortlens.operators.ordinal import ntile
from cohortlens.operators.stats import gap_to_baseline, period_delta, rank_within, topk_keys, topk_semi

YEAR = "survey_year"
FULL_TIME = "Employed FT"


def salaried(clean: DataFrame) -> DataFrame:
    """Full-time respondents with a plausible salary, salary renamed ``salary``."""
    return clean.where(
        F.col("salary_usd_yearly_clean").isNotNull() & (F.col("employment_clean") == FULL_TIME)
    ).withColumnRenamed("salary_usd_yearly_clean", "salary")


def salary_country(clean: DataFrame, min_n: int = 100) -> DataFrame:
    """P25 / median / P75 / IQR per (year, country) with at least ``min_n`` salaries;
    rank by median within the year; previous row's median per country and the change."""
    base = salaried(clean).where(F.col("country").isNotNull()).select(YEAR, "country", "salary")
    stats = percentile_stats(base, [YEAR, "country"], min_n=min_n, n_name="n_respondents", keep_raw=True)
    stats = stats.withColumn("iqr", F.round(F.col("_raw_p75") - F.col("_raw_p25")))
    stats = rank_within(stats, YEAR, "median_salary", "rank_by_median")
    stats = period_delta(stats, "country", YEAR, "median_salary", 0,
                         prev_name="prev_year_median", delta_name="yoy_median_change")
    return stats.select(YEAR, "country", "n_respondents", "p25", "median_salary", "p75", "iqr",
                        "rank_by_median", "prev_year_median", "yoy_median_change").orderBy(
        YEAR, "rank_by_median")


def salary_experience(clean: DataFrame, min_country_n: int = 500, top_k: int = 10,
                      min_n: int = 30) -> DataFrame:
    """Percentiles per (year, country, experience bracket) within the ``top_k`` countries
    by salary answers (at least ``min_country_n``), brackets with at least ``min_n``;
    premium of each bracket's median over the lowest bracket present."""
    paid = salaried(clean)
    top = topk_keys(paid, "country", top_k, min_country_n)
    base = topk_semi(paid.where(F.col("exp_bracket").isNotNull()), "country", top).select(
        YEAR, "country", "exp_bracket", "salary")
    stats = percentile_stats(base, [YEAR, "country", "exp_bracket"], min_n=min_n)
    stats = gap_to_baseline(stats, [YEAR, "country"], "exp_bracket",
                            ("0-1 yrs", "2-4 yrs", "5-9 yrs", "10-19 yrs", "20+ yrs"),
                            "median_salary", "premium_vs_entry_level", full_frame=True)
    return stats.select(YEAR, "country", "exp_bracket", "n", "p25", "median_salary", "p75",
                        "premium_vs_entry_level", bracket_order().alias("bracket_order")).orderBy(
        YEAR, "country", "bracket_order")


def salary_quartile_mix(clean: DataFrame, min_n: int = 50, first_year: int = 2023) -> DataFrame:
    """Each respondent's salary quartile within the year (NTILE(4), ties split by
    response id), then per (year, role): count, median, % in the top and bottom
    quartile; roles with at least ``min_n``; rank by median."""
    rows = (
        salaried(clean)
        .where(non_blank("dev_type_primary", trimmed=False) & (F.col(YEAR) >= first_year))
        .select(YEAR, "response_id", "dev_type_primary", "salary")
    )
    shares = {"pct_in_top_quartile": 4, "pct_in_bottom_quartile": 1}
    # the quartiles rank within the year, the median within (year, role); both read the written
    # table of ranked rows, so the panel is read for that table only
    ranked = ntile(rows, [YEAR], ["salary", "response_id"], 4, "quartile")
    mix = bucket_mix(ranked, "quartile", [YEAR, "dev_type_primary"], shares)
    med = percentile_stats(ranked, [YEAR, "dev_type_primary"], probs=(0.5,), names=("median_salary",), n_name="_n2")
    out = mix.join(med, [YEAR, "dev_type_primary"])
    out = out.where(F.col("total_n") >= min_n)
    out = rank_within(out, YEAR, "median_salary", "rank_by_median")
    return out.select(YEAR, "dev_type_primary", "total_n", "median_salary", "pct_in_top_quartile",
                      "pct_in_bottom_quartile", "rank_by_median").orderBy(YEAR, "rank_by_median")


def salary_summary(responses: DataFrame, low: float = 1000, high: float = 1000000) -> DataFrame:
    """Raw salary answers in [low, high] per year: rows, answers, median, P25, P75."""
    base = responses.where(F.col("salary_usd_yearly").between(low, high)).select(
        YEAR, F.col("salary_usd_yearly").alias("salary"))
    q = percentile_stats(base, [YEAR], names=("p25", "median_salary", "p75"), n_name="has_salary")
    return q.withColumn("total", F.col("has_salary")).select(
        YEAR, "total", "has_salary", "median_salary", "p25", "p75").orderBy(YEAR)
