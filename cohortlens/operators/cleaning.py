"""The cleaning view: one wide projection of derived columns over the raw responses.

Every rule is a table of data fed to a generic builder from ``functions.rules``; the
whole view is a single Project, so Catalyst inlines it into each query and prunes the
derived columns a query does not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.rules import (
    PatternRule,
    coalesce_proxy,
    first_token,
    label_ordinal,
    pattern_labels,
    range_null_out,
    threshold_bins,
)

# ---------------------------------------------------------------------------
# Thresholds, patterns and labels of the cleaning rules.  The
# outputs are the published category names; rule order matters (first match wins).
# ---------------------------------------------------------------------------
SALARY_RANGE = (1000, 1000000)
EXPERIENCE_RANGE = (0, 50)

EXPERIENCE_BRACKETS = (("0-1 yrs", 2), ("2-4 yrs", 5), ("5-9 yrs", 10), ("10-19 yrs", 20))
EXPERIENCE_TOP_BRACKET = ("20+ yrs", 50)
BRACKET_ORDER = ("0-1 yrs", "2-4 yrs", "5-9 yrs", "10-19 yrs", "20+ yrs")

REMOTE_RULES = (
    PatternRule("Remote", like=("%remote%",), unless=("%hybrid%",)),
    PatternRule("Hybrid", like=("%hybrid%", "%your choice%", "%flexible%")),
    PatternRule("In-person", like=("%person%",), unless=("%hybrid%",)),
)

EDUCATION_RULES = (
    PatternRule("No formal degree", like=("%primary%", "%secondary%", "Something else")),
    PatternRule("Associate degree", like=("%associate%",)),
    PatternRule("Bachelor's degree", like=("%bachelor%",)),
    PatternRule("Master's degree", like=("%master%",)),
    PatternRule("PhD or higher", like=("%doctoral%", "%phd%", "%doctor%")),
    PatternRule("Professional degree", like=("%professional%",)),
    PatternRule("Some college", like=("%some college%", "%without earning%")),
)

EMPLOYMENT_RULES = (
    PatternRule("Student", like=("%student%",)),
    PatternRule("Employed FT", like=("%full-time%", "%full time%"), exact=("Employed",)),
    PatternRule("Employed PT", like=("%part-time%", "%part time%")),
    PatternRule("Self-employed", like=("%self-employed%", "%freelance%", "%contractor%", "%independent%")),
    PatternRule("Not employed", like=("%not employed%", "%retired%")),
)
EMPLOYMENT_DEFAULT = "Other"

ORG_SIZE_ORDER = {
    "Just me - I am a freelancer, sole proprietor, etc.": 1,
    "Just me - I am a freelancer, sole proprietor, etc": 1,
    "2 to 9 employees": 2,
    "10 to 19 employees": 3,
    "20 to 99 employees": 4,
    "100 to 499 employees": 5,
    "500 to 999 employees": 6,
    "1,000 to 4,999 employees": 7,
    "5,000 to 9,999 employees": 8,
    "10,000 or more employees": 9,
}

AI_RULES = (
    PatternRule(True, like=("%yes%",)),
    PatternRule(False, like=("%no%",)),
)
AI_FIRST_YEAR = 2023

PASS_THROUGH = (
    "lang_worked", "lang_want", "lang_admired", "db_worked", "db_want", "platform_worked",
    "tools_worked", "dev_envs_worked", "dev_type", "ed_level", "employment", "remote_work",
    "org_size", "ai_select", "industry", "years_code", "years_code_pro", "work_exp",
    "salary_usd_yearly", "main_branch",
)


def salary_clean(col: str | Column = "salary_usd_yearly") -> Column:
    return range_null_out(col, *SALARY_RANGE)


def raw_experience() -> Column:
    return coalesce_proxy("years_code_pro", "work_exp")


def experience_years() -> Column:
    return range_null_out(raw_experience(), *EXPERIENCE_RANGE)


def exp_bracket() -> Column:
    """Bins the uncapped proxy, so a negative answer lands in the first bracket."""
    return threshold_bins(raw_experience(), EXPERIENCE_BRACKETS, EXPERIENCE_TOP_BRACKET)


def remote_clean(col: str | Column = "remote_work") -> Column:
    return pattern_labels(col, REMOTE_RULES)


def education_clean(col: str | Column = "ed_level") -> Column:
    return pattern_labels(col, EDUCATION_RULES)


def employment_clean(col: str | Column = "employment") -> Column:
    """NULL input falls through every rule, so it is 'Other' too."""
    return pattern_labels(col, EMPLOYMENT_RULES, default=EMPLOYMENT_DEFAULT)


def dev_type_primary(col: str | Column = "dev_type") -> Column:
    return first_token(col, ";")


def org_size_order(col: str | Column = "org_size") -> Column:
    return label_ordinal(col, ORG_SIZE_ORDER)


def ai_user(col: str | Column = "ai_select", year: str = "survey_year") -> Column:
    flag = pattern_labels(col, AI_RULES)
    return F.when(F.col(year) < AI_FIRST_YEAR, F.lit(None).cast("boolean")).otherwise(flag)


def derived_columns() -> dict[str, Column]:
    return {
        "salary_usd_yearly_clean": salary_clean(),
        "experience_years": experience_years(),
        "exp_bracket": exp_bracket(),
        "remote_work_clean": remote_clean(),
        "ed_level_clean": education_clean(),
        "employment_clean": employment_clean(),
        "dev_type_primary": dev_type_primary(),
        "org_size_order": org_size_order(),
        "ai_user": ai_user(),
    }


DERIVED = (
    "salary_usd_yearly_clean", "experience_years", "exp_bracket", "remote_work_clean",
    "ed_level_clean", "employment_clean", "dev_type_primary", "org_size_order", "ai_user",
)
CLEAN_COLUMNS = ("response_id", "survey_year", "country", "age", *DERIVED, *PASS_THROUGH)


def with_derived(responses: DataFrame) -> DataFrame:
    """Every raw column plus the nine derived ones (the stored wide panel)."""
    return responses.select("*", *[expr.alias(name) for name, expr in derived_columns().items()])


def clean(responses: DataFrame) -> DataFrame:
    """``responses_clean``: keys, 9 derived columns, 20 raw pass-through columns.
    Drops currency, comp_total and comp_freq.  Never changes the row count."""
    return with_derived(responses).select(*CLEAN_COLUMNS)


def bracket_order(col: str | Column = "exp_bracket") -> Column:
    """1..5 in seniority order, NULL for anything else."""
    return label_ordinal(col, {b: i + 1 for i, b in enumerate(BRACKET_ORDER)})
