"""The one-pass audits against the jobs that each report has of its own."""

from pathlib import Path

import pytest

from cohortlens.plans import quality as Q
from cohortlens.plans.audit import audit_counts, audit_long, audit_reports
from cohortlens.sources.staging import staged
from cohortlens.sources.store import store

SF = "/root/testdata/sf0.001"
JOBS = {
    "sanity_rows_per_year": Q.rows_per_year, "sanity_null_pct": Q.null_salary_pct, "clean_row_count": Q.clean_row_count,
    "v_outliers": Q.outliers, "v_remote_dist": Q.remote_distribution, "v_remote_unmatched": Q.remote_unmatched,
    "v_education_dist": Q.education_distribution, "v_education_unmatched": Q.education_unmatched,
    "v_exp_dist": Q.experience_distribution, "v_exp_coverage": Q.experience_coverage, "v_ai_dist": Q.ai_distribution,
    "v_employment_dist": Q.employment_distribution, "v_other_top20": Q.employment_other_top, "v_org_size": Q.org_size_coverage,
}


@pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")
def test_each_report_is_that_of_its_job(spark):
    clean = store(spark, SF).clean()
    counts = audit_counts(clean)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Window" not in plan
    reports = audit_reports(staged(counts, "audit-test"))
    assert set(reports) == set(JOBS)
    for name, job in JOBS.items():
        own = job(clean)
        assert reports[name].columns == own.columns and reports[name].dtypes == own.dtypes, name
        assert sorted(map(str, reports[name].collect())) == sorted(map(str, own.collect())), name
    long = audit_long(reports)
    assert long.columns == ["report", "survey_year", "label", "measure", "value"]
    assert {r.report for r in long.select("report").distinct().collect()} == set(JOBS)


def test_no_rows(spark):
    if not Path(SF).exists():
        pytest.skip("driver tables not present")
    reports = audit_reports(audit_counts(store(spark, SF).clean().limit(0)))
    assert reports["clean_row_count"].collect()[0].n_rows == 0
    assert all(df.count() == 0 for name, df in reports.items() if name != "clean_row_count")
