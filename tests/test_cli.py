import tempfile
from pathlib import Path

import pytest

from cohortlens import cli
from cohortlens.sources import survey_csv

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver tables not present")


def test_ingest_then_reports(spark, capsys):
    files = survey_csv.survey_files(spark, SF)
    out = tempfile.mkdtemp(prefix="cohortlens-cli-") + "/tables"
    assert cli.main(["ingest", "--data-dir", files, "--tables", out], spark=spark) == 0
    assert cli.main(["clean", "--tables", out], spark=spark) == 0
    assert cli.main(["run", "--tables", out, "lang_trend", "v_outliers", "remote_share"], spark=spark) == 0
    text = capsys.readouterr().out
    assert "== lang_trend" in text and "responses_clean:" in text and "pct_removed" in text


def test_every_report_builds(spark):
    out = tempfile.mkdtemp(prefix="cohortlens-cli-") + "/tables"
    cli.ingest(spark, survey_csv.survey_files(spark, SF), out)
    t = cli.Tables(spark, out)
    for name, fn in cli.REPORTS.items():
        assert fn(t).columns, name


def test_sql_over_the_users_tables_and_full_output(spark, capsys):
    folder = tempfile.mkdtemp(prefix="cohortlens-cli-")
    cli.ingest(spark, survey_csv.survey_files(spark, SF), folder + "/tables")
    text = "SELECT response_id FROM responses_clean ORDER BY response_id"
    assert cli.main(["sql", "--tables", folder + "/tables", text], spark=spark) == 0
    shown = capsys.readouterr().out
    rows = spark.read.parquet(folder + "/tables/panel").count()
    assert rows > 100 and shown.count("|") >= 2 * rows  # every row is printed
    assert cli.main(["run", "--tables", folder + "/tables", "--out", folder + "/out", "lang_trend"], spark=spark) == 0
    assert spark.read.option("header", "true").csv(folder + "/out/lang_trend").columns[0] == "survey_year"
