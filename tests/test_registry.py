import importlib.util

import __spark_entry__ as entry

# the operator inventory of SURVEY §2, by job key
PLANNED = {
    "csv_roundtrip", "na_tokens", "harmonise_year", "union_years", "coerce_numeric", "explode_multival",
    "lang_exploded", "db_exploded", "write_tables", "sanity_rows_per_year", "sanity_null_pct",
    "clean_row_count", "schema_profile", "salary_summary",
    "clean_salary", "clean_experience", "clean_exp_bracket", "clean_remote", "clean_education",
    "clean_employment", "clean_dev_type", "clean_org_size", "clean_ai_user", "clean_view",
    "v_row_reconcile", "v_outliers", "v_remote_dist", "v_remote_unmatched", "v_education_dist",
    "v_education_unmatched", "v_exp_dist", "v_exp_coverage", "v_ai_dist", "v_employment_dist",
    "v_other_top20", "v_org_size",
    "lang_trend", "lang_endpoints", "lang_desire_gap", "salary_country", "salary_experience",
    "salary_quartile_mix", "remote_share", "remote_salary", "remote_by_role", "role_rank_change",
    "role_spread", "ai_salary", "role_headcount", "registered_views", "audit_reports",
}


def test_every_planned_job_is_registered_with_an_oracle():
    assert PLANNED <= set(entry.queries())
    oracles = entry.oracle_sql()
    assert PLANNED <= set(oracles)
    assert all(oracles[name].lstrip().upper().startswith("WITH") for name in PLANNED)


def test_corpus_operators_are_optional(monkeypatch):
    """Without their subpackage the entry has the other jobs."""
    find = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda n, *a: None if n == "cohortlens.llm" else find(n, *a))
    assert set(entry.queries()) == PLANNED
