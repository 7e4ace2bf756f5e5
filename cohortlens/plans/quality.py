"""Audits of the ingest and cleaning steps: row reconciliation, outlier counts, label
distributions, values no rule caught, proxy coverage, and the ingest sanity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.stats import percent, share_of, unmatched_values, with_total_share

YEAR = "survey_year"


def rows_per_year(responses: DataFrame) -> DataFrame:
    return responses.groupBy(YEAR).agg(F.count(F.lit(1)).alias("n")).orderBy(YEAR)


def null_salary_pct(responses: DataFrame) -> DataFrame:
    nulls = F.sum(F.when(F.col("salary_usd_yearly").isNull(), 1).otherwise(0))
    return responses.groupBy(YEAR).agg(F.round(percent(nulls, F.count(F.lit(1))), 1).alias("pct_null")).orderBy(YEAR)


def clean_row_count(clean: DataFrame) -> DataFrame:
    return clean.agg(F.count(F.lit(1)).alias("n_rows"))


def row_reconcile(responses: DataFrame, clean: DataFrame) -> DataFrame:
    """Raw rows per year against matching cleaned rows, with LEFT JOIN semantics (a key
    repeated on both sides fans out).  Both sides are first counted per respondent and year, so
    the join carries one row per respondent and side: a key held by a large share of rows neither
    multiplies rows nor lands its rows in one task.  raw = sum(l * max(r, 1)),
    clean = sum(l * r); a NULL key never matches, as in SQL.

    Grouping and joining are by respondent alone, the years being a short list in the row, so
    over tables bucketed by respondent nothing is shuffled before the last sums by year."""
    def by_respondent(df: DataFrame, name: str) -> DataFrame:
        counted = df.groupBy("response_id", YEAR).agg(F.count(F.lit(1)).alias("n"))
        return counted.groupBy("response_id").agg(F.collect_list(F.struct(YEAR, "n")).alias(name))

    both = by_respondent(responses, "_l").join(by_respondent(clean, "_r"), "response_id", "left")
    rows = both.select("_r", F.explode("_l").alias("_one"))
    year = F.col(f"_one.{YEAR}")
    same = F.filter(F.coalesce("_r", F.array()), lambda r: r[YEAR] == year)
    matched = F.aggregate(same, F.lit(0).cast("long"), lambda t, r: t + r["n"])
    return rows.select(year.alias(YEAR), F.col("_one.n").alias("_l"), matched.alias("_r")).groupBy(YEAR).agg(
        F.sum(F.col("_l") * F.greatest("_r", F.lit(1))).alias("raw_rows"),
        F.sum(F.col("_l") * F.col("_r")).alias("clean_rows"),
    ).orderBy(YEAR)


def outliers(clean: DataFrame) -> DataFrame:
    agg = clean.groupBy(YEAR).agg(
        F.count("salary_usd_yearly").alias("raw_with_salary"),
        F.count("salary_usd_yearly_clean").alias("clean_with_salary"),
    )
    removed = F.col("raw_with_salary") - F.col("clean_with_salary")
    return agg.select(
        YEAR, "raw_with_salary", "clean_with_salary", removed.alias("outliers_removed"),
        F.round(percent(removed, F.nullif(F.col("raw_with_salary"), F.lit(0))), 2).alias("pct_removed"),
    ).orderBy(YEAR)


def remote_distribution(clean: DataFrame) -> DataFrame:
    base = clean.where(F.col("remote_work").isNotNull())
    return share_of(base, [YEAR, "remote_work_clean"], within=[YEAR], dp=1, pct_name="pct_of_year").orderBy(
        YEAR, F.col("n").desc())


def remote_unmatched(clean: DataFrame) -> DataFrame:
    return unmatched_values(clean, "remote_work", "remote_work_clean", group=[YEAR]).orderBy(F.col("n").desc())


def education_distribution(clean: DataFrame) -> DataFrame:
    return share_of(clean, ["ed_level_clean"], dp=1, pct_name="pct_total").orderBy(F.col("n").desc())


def education_unmatched(clean: DataFrame) -> DataFrame:
    return unmatched_values(clean, "ed_level", "ed_level_clean").orderBy(F.col("n").desc())


def experience_distribution(clean: DataFrame) -> DataFrame:
    """Bracket sizes, mean years and share, in order of the bracket's smallest value."""
    base = clean.where(F.col("exp_bracket").isNotNull())
    agg = base.groupBy("exp_bracket").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("experience_years"), 1).alias("avg_yrs"),
        F.min("experience_years").alias("_min"),
    )
    agg = with_total_share(agg, "n", dp=1, pct_name="pct_total")
    return agg.orderBy(F.col("_min").asc_nulls_last()).select("exp_bracket", "n", "avg_yrs", "pct_total")


def experience_coverage(clean: DataFrame) -> DataFrame:
    return clean.groupBy(YEAR).agg(
        F.count("years_code_pro").alias("has_years_code_pro"),
        F.count("work_exp").alias("has_work_exp"),
        F.count("experience_years").alias("has_experience_years"),
    ).orderBy(YEAR)


def ai_distribution(clean: DataFrame) -> DataFrame:
    return share_of(clean, [YEAR, "ai_user"], within=[YEAR], dp=1, pct_name="pct_of_year").orderBy(
        YEAR, F.col("ai_user").asc_nulls_last())


def employment_distribution(clean: DataFrame) -> DataFrame:
    return share_of(clean, ["employment_clean"], dp=1, pct_name="pct_total").orderBy(F.col("n").desc())


def employment_other_top(clean: DataFrame, top: int = 20) -> DataFrame:
    return unmatched_values(clean, "employment", None, out_name="raw_value", top=top,
                            when=F.col("employment_clean") == "Other")


def org_size_coverage(clean: DataFrame) -> DataFrame:
    return (
        clean.where(F.col("org_size").isNotNull())
        .groupBy(F.col("org_size").alias("raw_value"), "org_size_order")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("org_size_order").asc_nulls_last(), "raw_value")
    )
