"""Invariants on the sf0.001 panel: shares add up, cleaning keeps rows, methods agree."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cohortlens.operators.cleaning import clean
from cohortlens.operators.distribution import cohort_median_gap, ntile_bounds, ntile_mix, percentile_stats
from cohortlens.operators.stats import (
    endpoint_compare, gap_to_baseline, period_delta, rank_within, share_of, topk_keys, unmatched_values,
)
from cohortlens.plans import quality, remote
from cohortlens.sources.store import store

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def s(spark):
    return store(spark, SF)


def test_cleaning_keeps_every_row(s):
    assert clean(s.responses()).count() == s.responses().count()


def test_year_shares_sum_to_100(s):
    for df in (remote.remote_share(s.clean()), quality.remote_distribution(s.clean())):
        pct = "pct_of_year"
        for r in df.groupBy("survey_year").agg(F.sum(pct).alias("t")).collect():
            assert abs(r.t - 100.0) <= 0.05 * 6


def test_grand_shares_sum_to_100(s):
    for df in (quality.education_distribution(s.clean()), quality.employment_distribution(s.clean())):
        total = df.agg(F.sum("pct_total")).collect()[0][0]
        assert abs(total - 100.0) <= 0.05 * 10


def test_reconcile_counts_equal(s):
    for r in quality.row_reconcile(s.responses(), s.clean()).collect():
        assert r.raw_rows == r.clean_rows


def test_share_of_and_unmatched(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", "x"), (1, "b", None), (2, "b", None)],
                               "y int, raw string, c string")
    got = {(r.y, r.raw): (r.n, r.pct) for r in share_of(df, ["y", "raw"], within=["y"], pct_name="pct").collect()}
    assert got == {(1, "a"): (2, 66.7), (1, "b"): (1, 33.3), (2, "b"): (1, 100.0)}
    um = {(r.unmatched_raw_value, r.n) for r in unmatched_values(df, "raw", "c").collect()}
    assert um == {("a", 1), ("b", 2)}


def test_period_delta_is_row_based(spark):
    df = spark.createDataFrame([("x", 2021, 1.0), ("x", 2023, 4.0), ("x", 2024, 3.5)], "e string, y int, v double")
    got = {r.y: (r.prev, r.d, r.nxt) for r in
           period_delta(df, "e", "y", "v", 1, prev_name="prev", delta_name="d", next_name="nxt").collect()}
    assert got == {2021: (None, None, 4.0), 2023: (1.0, 3.0, 3.5), 2024: (4.0, -0.5, None)}


def test_rank_ties_share_rank(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (1, 3.0)], "y int, v double")
    assert sorted(r.r for r in rank_within(df, "y", "v", "r").collect()) == [1, 1, 3]


def test_gap_to_lowest_present_category(spark):
    df = spark.createDataFrame([(1, "Hybrid", 100.0), (1, "Remote", 130.0)], "y int, c string, m double")
    got = {r.c: r.g for r in gap_to_baseline(df, ["y"], "c", ("In-person", "Hybrid", "Remote"), "m", "g").collect()}
    assert got == {"Hybrid": 0.0, "Remote": 30.0}


def test_endpoint_labels(spark):
    df = spark.createDataFrame([("a", 2021, 5.0), ("a", 2025, 7.0), ("b", 2021, 4.0), ("b", 2025, 4.0),
                                ("c", 2021, 1.0), ("c", 2025, 2.0), ("d", 2025, 9.0)],
                               "l string, y int, p double")
    got = {r.l: r.trend_direction for r in endpoint_compare(df, "l", "y", "p", 2021, 2025, 3.0).collect()}
    assert got == {"a": "Rising", "b": "Stable"}


def test_topk_keeps_null_key_group(spark):
    df = spark.createDataFrame([(None,)] * 5 + [("x",)] * 3 + [("y",)], "k string")
    assert [r.k for r in topk_keys(df, "k", 2, 2).collect()] == [None, "x"]


def test_distribution_operators(spark):
    rows = [("r", i, float(v), v % 2 == 0) for i, v in enumerate(range(1, 101))]
    df = spark.createDataFrame(rows, "g string, id long, salary double, flag boolean")
    p = percentile_stats(df, ["g"], "salary").collect()[0]
    assert (p.n, p.p25, p.median_salary, p.p75) == (100, 26.0, 51.0, 75.0)
    b = ntile_bounds(df, ["g"], "salary", 10, ceiling_of=1, floor_of=9).collect()[0]
    assert (b.total_n, b.d1_ceiling, b.d9_floor, b.median_salary) == (100, 10.0, 81.0, 51.0)
    m = ntile_mix(df, ["g"], ["salary", "id"], 4, ["g"], {"top": 4, "bottom": 1}).collect()[0]
    assert (m.total_n, m.top, m.bottom) == (100, 25.0, 25.0)
    c = cohort_median_gap(df, ["g"], "flag", "salary").collect()[0]
    assert (c.median_salary_ai_users, c.median_salary_non_ai, c.ai_salary_premium) == (51.0, 50.0, 1.0)
    assert (c.total_n, c.flag_n) == (100, 50)


def test_reconcile_fans_out_like_a_join(spark):
    left = spark.createDataFrame([(1, 2023), (1, 2023), (2, 2023), (None, 2023), (3, 2024)],
                                 "response_id long, survey_year int")
    right = spark.createDataFrame([(1, 2023), (1, 2023), (1, 2023), (None, 2023), (3, 2024)],
                                  "response_id long, survey_year int")
    got = {r.survey_year: (r.raw_rows, r.clean_rows) for r in quality.row_reconcile(left, right).collect()}
    # id 1: 2 x 3 pairs; id 2 unmatched; NULL never matches
    assert got == {2023: (8, 6), 2024: (1, 1)}


def test_adoption_rate_counts_distinct_entities(spark):
    from cohortlens.operators.stats import adoption_rate
    long = spark.createDataFrame([(2023, 1, "Go"), (2023, 1, "Go"), (2023, 2, "Go"), (2023, 2, "Rust"),
                                  (2024, 3, "Go")], "y int, id long, lang string")
    base = spark.createDataFrame([(2023, 1), (2023, 2), (2023, 4), (2024, 3)], "y int, id long")
    got = {(r.y, r.lang): (r.user_count, r.total_respondents, r.adoption_pct)
           for r in adoption_rate(long, base, "y", "lang", "id").collect()}
    assert got == {(2023, "Go"): (2, 3, 66.67), (2023, "Rust"): (1, 3, 33.33), (2024, "Go"): (1, 1, 100.0)}


def test_topk_semi_keeps_rows_of_top_keys_only(spark):
    from cohortlens.operators.stats import topk_semi
    df = spark.createDataFrame([(None, 1), ("a", 2), ("a", 3), ("b", 4)], "k string, v int")
    keys = spark.createDataFrame([(None,), ("a",)], "k string")
    assert sorted(r.v for r in topk_semi(df, "k", keys).collect()) == [2, 3]   # NULL never matches
