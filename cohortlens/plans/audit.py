"""All audits of the ingest and cleaning steps from one pass over the panel.

``audit_counts`` groups the cleaned rows by seven grouping sets at once: Spark expands each row
to its sets, counts before it shuffles, and one scan fills every report.  The counts are a small
table (one row for each distinct answer and year), from which ``audit_reports`` takes the fourteen
reports of ``plans.quality``, each with the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.stats import percent, with_total_share
from cohortlens.plans.quality import YEAR

#: The columns that reports group by, and those of each set.
COLUMNS = (YEAR, "remote_work", "remote_work_clean", "ed_level", "ed_level_clean", "exp_bracket", "ai_user",
           "employment", "employment_clean", "org_size", "org_size_order")
SETS = {
    "year": (YEAR,),
    "remote": (YEAR, "remote_work", "remote_work_clean"),
    "education": ("ed_level", "ed_level_clean"),
    "experience": ("exp_bracket",),
    "ai": (YEAR, "ai_user"),
    "employment": ("employment", "employment_clean"),
    "org_size": ("org_size", "org_size_order"),
}


def audit_counts(clean: DataFrame) -> DataFrame:
    """Counts of the cleaned rows by each of ``SETS``; ``audit`` names the set."""
    grouped = clean.groupingSets([[F.col(c) for c in cols] for cols in SETS.values()], *[F.col(c) for c in COLUMNS]).agg(
        F.grouping_id().alias("_set"),
        F.count(F.lit(1)).alias("n"),
        F.count("salary_usd_yearly").alias("raw_salary"),
        F.count("salary_usd_yearly_clean").alias("clean_salary"),
        F.count("years_code_pro").alias("has_years_code_pro"),
        F.count("work_exp").alias("has_work_exp"),
        F.count("experience_years").alias("has_experience_years"),
        F.avg("experience_years").alias("avg_years"),
        F.min("experience_years").alias("min_years"),
    )
    # a grouping id has a bit for each column that the row's set leaves out, the first column highest
    ids = {name: sum(1 << (len(COLUMNS) - 1 - i) for i, c in enumerate(COLUMNS) if c not in cols) for name, cols in SETS.items()}
    name = reduce(lambda e, kv: e.when(F.col("_set") == kv[1], F.lit(kv[0])), ids.items(), F)
    return grouped.withColumn("audit", name).drop("_set")


def audit_reports(counts: DataFrame) -> dict[str, DataFrame]:
    """The fourteen audit reports by job name, from ``audit_counts``."""
    def of(name: str) -> DataFrame:
        return counts.where(F.col("audit") == name)

    def summed(df: DataFrame, *keys) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum("n").alias("n"))

    n, raw = F.col("n"), F.col("raw_salary")
    removed = raw - F.col("clean_salary")
    asked = of("remote").where(F.col("remote_work").isNotNull())
    experience = with_total_share(
        of("experience").where(F.col("exp_bracket").isNotNull()).select("exp_bracket", "n", "avg_years", "min_years"),
        "n", dp=1, pct_name="pct_total")
    return {
        "sanity_rows_per_year": of("year").select(YEAR, "n").orderBy(YEAR),
        "sanity_null_pct": of("year").select(YEAR, F.round(percent(n - raw, n), 1).alias("pct_null")).orderBy(YEAR),
        "clean_row_count": of("year").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows")),
        "v_outliers": of("year").select(
            YEAR, raw.alias("raw_with_salary"), F.col("clean_salary").alias("clean_with_salary"),
            removed.alias("outliers_removed"),
            F.round(percent(removed, F.nullif(raw, F.lit(0))), 2).alias("pct_removed")).orderBy(YEAR),
        "v_remote_dist": with_total_share(summed(asked, YEAR, "remote_work_clean"), "n", [YEAR], 1, "pct_of_year").orderBy(
            YEAR, n.desc()),
        "v_remote_unmatched": asked.where(F.col("remote_work_clean").isNull()).select(
            YEAR, F.col("remote_work").alias("unmatched_raw_value"), "n").orderBy(n.desc()),
        "v_education_dist": with_total_share(summed(of("education"), "ed_level_clean"), "n", dp=1, pct_name="pct_total").orderBy(
            n.desc()),
        "v_education_unmatched": of("education").where(
            F.col("ed_level").isNotNull() & F.col("ed_level_clean").isNull()).select(
            F.col("ed_level").alias("unmatched_raw_value"), "n").orderBy(n.desc()),
        "v_exp_dist": experience.orderBy(F.col("min_years").asc_nulls_last()).select(
            "exp_bracket", "n", F.round("avg_years", 1).alias("avg_yrs"), "pct_total"),
        "v_exp_coverage": of("year").select(YEAR, "has_years_code_pro", "has_work_exp", "has_experience_years").orderBy(YEAR),
        "v_ai_dist": with_total_share(of("ai").select(YEAR, "ai_user", "n"), "n", [YEAR], 1, "pct_of_year").orderBy(
            YEAR, F.col("ai_user").asc_nulls_last()),
        "v_employment_dist": with_total_share(
            summed(of("employment"), "employment_clean"), "n", dp=1, pct_name="pct_total").orderBy(n.desc()),
        "v_other_top20": of("employment").where(F.col("employment_clean") == "Other").select(
            F.col("employment").alias("raw_value"), "n").orderBy(n.desc(), F.col("raw_value").asc_nulls_first()).limit(20),
        "v_org_size": of("org_size").where(F.col("org_size").isNotNull()).select(
            F.col("org_size").alias("raw_value"), "org_size_order", "n").orderBy(
            F.col("org_size_order").asc_nulls_last(), "raw_value"),
    }


#: How each report's rows are named in the long form: year, label, and the measures.
_LABEL = {"v_remote_dist": "remote_work_clean", "v_remote_unmatched": "unmatched_raw_value", "v_education_dist": "ed_level_clean",
          "v_education_unmatched": "unmatched_raw_value", "v_exp_dist": "exp_bracket", "v_ai_dist": "ai_user",
          "v_employment_dist": "employment_clean", "v_other_top20": "raw_value", "v_org_size": "raw_value"}


def audit_long(reports: dict[str, DataFrame]) -> DataFrame:
    """Every report in one table: (report, survey_year, label, measure, value)."""
    frames = []
    for name, df in reports.items():
        label = _LABEL.get(name)
        measures = [c for c in df.columns if c not in (YEAR, label)]
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in measures]))
        frames.append(df.select(
            F.lit(name).alias("report"), (F.col(YEAR) if YEAR in df.columns else F.lit(None)).cast("int").alias(YEAR),
            (F.col(label) if label else F.lit(None)).cast("string").alias("label"), each.alias("_m")).select(
            "report", YEAR, "label", "_m.measure", "_m.value"))
    return reduce(lambda a, b: a.unionByName(b), frames)
