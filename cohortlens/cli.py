"""Command line: ingest yearly files into tables, then run reports over the tables.

    python -m cohortlens ingest --data-dir data/ --tables out/tables
    python -m cohortlens clean  --tables out/tables
    python -m cohortlens run    --tables out/tables lang_trend salary_country ...
    python -m cohortlens run    --tables out/tables --out out/reports lang_trend
    python -m cohortlens sql    --tables out/tables "SELECT survey_year, count(*) FROM responses GROUP BY 1"
    python -m cohortlens audit  --tables out/tables
    python -m cohortlens list

Reports use the published thresholds (the functions' defaults).  ``--tables`` should
be shared storage on a cluster.  ``run`` and ``sql`` print every row of a result, or write it
as CSV under ``--out``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortlens.operators.cleaning import clean as clean_view
from cohortlens.plans import audit, quality, remote, roles, salary, trends
from cohortlens.sources import survey_csv
from cohortlens.sources.staging import staged
from cohortlens.sources.store import read_buckets, read_table, register_views, write_tables

TABLES = ("responses", "responses_clean", "lang_exploded", "db_exploded", "lang_usage")


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return read_table(self.spark, self.root, name)

    def bucketed(self, name: str) -> DataFrame:
        return read_buckets(self.spark, self.root, name)


REPORTS: dict[str, Callable[[Tables], DataFrame]] = {
    "sanity_rows_per_year": lambda t: quality.rows_per_year(t.responses),
    "sanity_null_pct": lambda t: quality.null_salary_pct(t.responses),
    "v_row_reconcile": lambda t: quality.row_reconcile(t.bucketed("responses"), t.bucketed("responses_clean")),
    "v_outliers": lambda t: quality.outliers(t.responses_clean),
    "v_remote_dist": lambda t: quality.remote_distribution(t.responses_clean),
    "v_remote_unmatched": lambda t: quality.remote_unmatched(t.responses_clean),
    "v_education_dist": lambda t: quality.education_distribution(t.responses_clean),
    "v_education_unmatched": lambda t: quality.education_unmatched(t.responses_clean),
    "v_exp_dist": lambda t: quality.experience_distribution(t.responses_clean),
    "v_exp_coverage": lambda t: quality.experience_coverage(t.responses_clean),
    "v_ai_dist": lambda t: quality.ai_distribution(t.responses_clean),
    "v_employment_dist": lambda t: quality.employment_distribution(t.responses_clean),
    "v_other_top20": lambda t: quality.employment_other_top(t.responses_clean),
    "v_org_size": lambda t: quality.org_size_coverage(t.responses_clean),
    "salary_summary": lambda t: salary.salary_summary(t.responses),
    "lang_trend": lambda t: trends.lang_trend(t.responses_clean, t.lang_exploded, usage=t.lang_usage),
    "lang_endpoints": lambda t: trends.lang_endpoints(t.responses_clean, t.lang_exploded, usage=t.lang_usage),
    "lang_desire_gap": lambda t: trends.lang_desire_gap(t.responses_clean, t.lang_exploded, usage=t.lang_usage),
    "salary_country": lambda t: salary.salary_country(t.responses_clean),
    "salary_experience": lambda t: salary.salary_experience(t.responses_clean),
    "salary_quartile_mix": lambda t: salary.salary_quartile_mix(t.responses_clean),
    "remote_share": lambda t: remote.remote_share(t.responses_clean),
    "remote_salary": lambda t: remote.remote_salary(t.responses_clean),
    "remote_by_role": lambda t: remote.remote_by_role(t.responses_clean),
    "role_rank_change": lambda t: roles.role_rank_change(t.responses_clean),
    "role_spread": lambda t: roles.role_spread(t.responses_clean),
    "ai_salary": lambda t: roles.ai_salary(t.responses_clean),
    "role_headcount": lambda t: roles.role_headcount(t.responses_clean),
}


def ingest(spark: SparkSession, data_dir: str, tables: str) -> dict[str, tuple[str, ...]]:
    """Yearly files -> the four tables (full refresh)."""
    return write_tables(survey_csv.ingest(spark, data_dir), tables.rstrip("/"))


def _give(result: DataFrame, out: str | None, name: str) -> None:
    if out:
        result.write.mode("overwrite").option("header", "true").csv(out)
        return
    print(f"== {name}")
    result = result.cache()
    result.show(max(result.count(), 1), truncate=False)
    result.unpersist()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="cohortlens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("ingest", help="read the yearly CSVs, write the tables")
    p.add_argument("--data-dir", required=True)
    p.add_argument("--tables", required=True)
    p = sub.add_parser("clean", help="count the cleaned rows")
    p.add_argument("--tables", required=True)
    p = sub.add_parser("run", help="run reports over the tables")
    p.add_argument("--tables", required=True)
    p.add_argument("--out", help="write each report as a CSV folder here and print nothing")
    p.add_argument("reports", nargs="+", choices=sorted(REPORTS))
    p = sub.add_parser("audit", help="every audit report from one pass over the panel")
    p.add_argument("--tables", required=True)
    p.add_argument("--out", help="write each report as a CSV folder here and print nothing")
    p = sub.add_parser("sql", help="run a query over the tables by name")
    p.add_argument("--tables", required=True)
    p.add_argument("--out", help="write the result as a CSV folder here")
    p.add_argument("query")
    sub.add_parser("list", help="list report names")
    args = ap.parse_args(argv)

    if args.cmd == "list":
        print("\n".join(sorted(REPORTS)))
        return 0
    spark = spark or SparkSession.builder.appName("cohortlens").getOrCreate()
    if args.cmd == "ingest":
        ingest(spark, args.data_dir, args.tables)
        t = Tables(spark, args.tables)
        quality.rows_per_year(t.responses).show()
        quality.null_salary_pct(t.responses).show()
    elif args.cmd == "clean":
        print(f"responses_clean: {clean_view(Tables(spark, args.tables).responses).count():,} rows")
    elif args.cmd == "audit":
        counts = staged(audit.audit_counts(Tables(spark, args.tables).responses_clean), "audit")
        for name, report in audit.audit_reports(counts).items():
            _give(report, args.out and f"{args.out.rstrip('/')}/{name}", name)
    elif args.cmd == "sql":
        register_views(spark, args.tables)
        _give(spark.sql(args.query), args.out, "sql")
    else:
        t = Tables(spark, args.tables)
        for name in args.reports:
            _give(REPORTS[name](t), args.out and f"{args.out.rstrip('/')}/{name}", name)
    return 0
