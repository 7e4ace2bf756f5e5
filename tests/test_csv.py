import tempfile


from cohortlens.schema import RESPONSE_COLUMNS
from cohortlens.sources import survey_csv as csv


def test_round_trip_through_year_files(spark, responses):
    df = responses(
        {"response_id": 1, "survey_year": 2021, "lang_worked": "Python; Go", "years_code": 0,
         "salary_usd_yearly": 123456.789, "dev_type": ""},
        {"response_id": 2, "survey_year": 2025, "work_exp": 7, "years_code_pro": 9,
         "remote_work": 'Odd "quoted"\nlabel', "years_code": 51},
        {"response_id": 3, "survey_year": 2023, "ai_select": "Yes", "years_code": 12},
    )
    out_dir = tempfile.mkdtemp(prefix="cohortlens-csv-test-")
    csv.write_year_files(df, out_dir)
    got = {r.response_id: r for r in csv.ingest(spark, out_dir).collect()}
    assert set(got) == {1, 2, 3}
    r1, r2, r3 = got[1], got[2], got[3]
    assert r1.survey_year == 2021 and r1.lang_worked == "Python; Go"
    assert r1.years_code is None            # 'Less than 1 year' is not a number
    assert r1.salary_usd_yearly == 123456.789
    assert r1.dev_type is None              # empty cell is a missing value
    assert r1.remote_work is None           # not asked in 2021
    assert r2.years_code_pro is None        # not mapped in 2025
    assert r2.work_exp == 7.0
    assert r2.remote_work == 'Odd "quoted"\nlabel'
    assert r2.years_code is None            # 'More than 50 years'
    assert r3.ai_select == "Yes" and r3.years_code == 12.0
    assert list(csv.ingest(spark, out_dir).columns) == list(RESPONSE_COLUMNS)


def test_harmonise_missing_source_column_is_null(spark):
    raw = spark.createDataFrame([("1", "Employed", "x")], "ResponseId string, Employment string, Extra string")
    out = csv.harmonise(raw, 2023).collect()[0]
    assert out.survey_year == 2023 and out.response_id == "1" and out.employment == "Employed"
    assert out.country is None and "Extra" not in out.asDict()


def test_union_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "survey_year int, c string")
    assert csv.union_years([a, a, a]).count() == 3


def test_profile_reports_all_null(spark, responses):
    df = responses({"response_id": 5, "survey_year": 2022, "employment": "Student, full-time"})
    out_dir = tempfile.mkdtemp(prefix="cohortlens-csv-test-")
    csv.write_year_files(df, out_dir, years=(2022,))
    rows = {r.column_name: r for r in csv.schema_profile(spark, out_dir, years=(2022,)).collect()}
    assert rows["Employment"].sample_values == "Student, full-time"
    assert rows["Country"].sample_values == "UK"
    assert rows["DevType"].sample_values == "ALL NULL" and rows["DevType"].non_null == 0


def test_hand_written_file_with_dirty_values(spark, tmp_path):
    """A 2023 file as published: NA tokens, quoted empty, unquoted empty, a quoted
    newline with doubled quotes, '5d' and 'Less than 1 year' in numeric columns, an
    unknown column, and most mapped columns absent."""
    text = (
        'ResponseId,YearsCode,WorkExp,DevType,Country,Notes\n'
        '1,5d,12,"Developer, back-end",UK,x\n'
        '2,Less than 1 year,NA,"",Germany,"multi\nline ""quoted"""\n'
        '3, 7 ,3.5,NA,,y\n'
    )
    folder = tmp_path / "survey_results_public_2023.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text(text)
    df = csv.ingest(spark, str(tmp_path), years=(2023,))
    got = {r.response_id: r for r in df.collect()}
    assert set(got) == {1, 2, 3}
    assert (got[1].years_code, got[1].work_exp, got[1].dev_type, got[1].country) == (
        None, 12.0, "Developer, back-end", "UK")
    assert (got[2].years_code, got[2].work_exp, got[2].dev_type, got[2].country) == (None, None, None, "Germany")
    assert (got[3].years_code, got[3].work_exp, got[3].dev_type, got[3].country) == (7.0, 3.5, None, None)
    assert all(r.survey_year == 2023 and r.salary_usd_yearly is None and r.employment is None
               for r in got.values())
    raw = {r.ResponseId: r.Notes for r in csv.read_year(spark, str(tmp_path), 2023).collect()}
    assert raw["2"] == 'multi\nline "quoted"'


def _year_file(tmp_path, year, **parts):
    folder = tmp_path / f"survey_results_public_{year}.csv"
    folder.mkdir(parents=True)
    for name, text in parts.items():
        (folder / f"{name}.csv").write_bytes(text.encode())
    return str(tmp_path)


def test_one_file_is_read_in_many_splits(spark, tmp_path):
    """Quoted line breaks across split borders: the splits are smaller than most records."""
    rows = [(i, f'He said "{i}"\nand\n\nleft; {"x" * (i % 90)}', "UK" if i % 3 else "") for i in range(1, 400)]
    text = "ResponseId,Notes,Country\n" + "".join(
        '{},"{}",{}\n'.format(i, t.replace('"', '""'), c) for i, t, c in rows)
    folder = _year_file(tmp_path, 2023, part=text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = spark.read.option("lineSep", "\n").text(f"{folder}/survey_results_public_2023.csv")
        assert lines.rdd.getNumPartitions() > 20
        got = {r["ResponseId"]: (r["Notes"], r["Country"]) for r in csv.read_year(spark, folder, 2023).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {str(i): (t, c or None) for i, t, c in rows}


def test_each_part_is_parsed_by_its_own_header(spark, tmp_path):
    folder = _year_file(tmp_path, 2024, a="ResponseId,Country,WorkExp\r\n1,UK,7\r\n", b="WorkExp,ResponseId\n9,2\n", c="")
    got = {r.response_id: (r.country, r.work_exp) for r in csv.ingest(spark, folder, years=(2024,)).collect()}
    assert got == {1: ("UK", 7.0), 2: (None, 9.0)}


def test_profile_finds_the_years_by_the_file_names(spark, tmp_path):
    for year in (2022, 2031):
        _year_file(tmp_path, year, part=f"ResponseId,Only{year}\n1,x\n2,NA\n")
    (tmp_path / "notes.csv").write_text("a\n1\n")
    assert csv.discover(spark, str(tmp_path)) == (2022, 2031)
    got = {(r.survey_year, r.column_name): (r.n_columns, r.non_null, r.sample_values)
           for r in csv.schema_profile(spark, str(tmp_path)).collect()}
    assert got == {(y, c): (2, n, v) for y in (2022, 2031) for c, n, v in [("ResponseId", 2, "1 | 2"), (f"Only{y}", 1, "x")]}


def test_every_split_border_falls_somewhere_else(spark, tmp_path):
    """The same file in splits of many sizes: borders inside quotes, between doubled quotes, at line
    breaks, within and after the header; records longer than several splits; no last line break."""
    notes = ['""', "a\n\n\nb", 'q"q', "\n" * 40, "plain", "x" * 300 + "\n" + "y" * 300, ""]
    rows = [(i, notes[i % len(notes)], f"c{i}") for i in range(1, 60)]
    text = '"Response\nId",Notes,Country\n' + "\n".join('{},"{}",{}'.format(i, t.replace('"', '""'), c) for i, t, c in rows)
    folder = _year_file(tmp_path, 2023, part=text.replace('"Response\nId"', "ResponseId"))
    want = {str(i): (t or None, c) for i, t, c in rows}
    try:
        for size in (7, 64, 129, 500, 1021):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            got = {r["ResponseId"]: (r["Notes"], r["Country"]) for r in csv.read_year(spark, folder, 2023).collect()}
            assert got == want, size
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_text_is_scanned_once_and_lines_are_not_shuffled(spark, responses, tmp_path):
    """One scan of all files, no exchange; only where a record crosses a border a second one gives
    out the pieces."""
    csv.write_year_files(responses({"response_id": 1}), str(tmp_path))
    whole = csv.ingest(spark, str(tmp_path))._jdf.queryExecution()
    assert whole.optimizedPlan().toString().count("Relation [value") == 1
    assert "Exchange" not in whole.executedPlan().toString()
    folder = _year_file(tmp_path / "crossed", 2023, part='ResponseId,Notes\n1,"' + "a\n" * 400 + '"\n2,b\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        crossed = csv.read_year(spark, folder, 2023)
        assert crossed._jdf.queryExecution().optimizedPlan().toString().count("Relation [value") == 2
        assert crossed.count() == 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_changed_files_are_counted_anew(spark, tmp_path):
    folder = _year_file(tmp_path, 2023, part='ResponseId,Notes\n1,"a\nb"\n')
    assert [r.Notes for r in csv.read_year(spark, folder, 2023).collect()] == ["a\nb"]
    (tmp_path / "survey_results_public_2023.csv" / "part.csv").write_text('ResponseId,Notes\n1,"c\n\nd"\n2,e\n')
    assert [r.Notes for r in csv.read_year(spark, folder, 2023).collect()] == ["c\n\nd", "e"]


def test_profile_orders_by_id_and_breaks_ties_by_the_cells(spark, tmp_path):
    rows = "".join(f"{i},{'NA' if i % 2 else f'v{i}'}\n" for i in range(40, 0, -1)) + "2,b\n2,a\nx,late\n"
    folder = _year_file(tmp_path, 2022, a="ResponseId,V\n" + rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r.column_name: (r.non_null, r.sample_values) for r in csv.schema_profile(spark, folder, samples=9).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {"ResponseId": (43, "1 | 2 | 2 | 2 | 3"), "V": (23, "a | b | v2")}


def test_packed_files_are_read_like_plain_ones(spark, responses, tmp_path, monkeypatch):
    monkeypatch.setattr(csv, "PACKED_ROWS", 2)
    df = responses(*[{"response_id": i, "survey_year": 2023, "remote_work": f'line "{i}"\nline, two', "dev_type": "a;b"} for i in range(9)]).coalesce(1)
    found = {}
    for packed in (False, True):
        folder = str(tmp_path / str(packed))
        csv.write_year_files(df, folder, years=(2023,), packed=packed)
        found[packed] = sorted(map(str, csv.ingest(spark, folder, years=(2023,)).collect()))
        assert len(csv.headers(spark, csv.year_path(folder, 2023))) == (5 if packed else 1)
    assert found[True] == found[False] and len(found[True]) == 9
