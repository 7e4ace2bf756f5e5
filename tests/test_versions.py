"""A refresh is seen whole or not at all."""

import pytest
from pyspark.sql import functions as F

from cohortlens.plans import quality
from cohortlens.plans.trends import lang_trend, lang_desire_gap, lang_endpoints
from cohortlens.sources import store, versions


def tables(spark, root):
    return {n: sorted(map(str, store.read_table(spark, root, n).select(F.struct("*")).collect()))
            for n in ("responses", "responses_clean", "lang_exploded", "db_exploded", "lang_usage")}


@pytest.fixture
def panel(responses):
    def make(n, lang="Python;Go"):
        return responses(*[{"response_id": i, "survey_year": 2021 + i % 5, "lang_worked": lang, "db_worked": "A", "country": f"c{n}"}
                           for i in range(n)])
    return make


def test_a_refresh_that_fails_between_two_tables_leaves_the_old_ones(spark, tmp_path, panel, monkeypatch):
    root = str(tmp_path / "tables")
    store.write_tables(panel(7), root)
    before = tables(spark, root)
    real = store.explode_multival

    def failing(df, source, name):
        if source == "db_worked":
            raise RuntimeError("lost")
        return real(df, source, name)

    monkeypatch.setattr(store, "explode_multival", failing)
    with pytest.raises(RuntimeError):
        store.write_tables(panel(11, "Rust"), root)
    assert tables(spark, root) == before
    monkeypatch.setattr(store, "explode_multival", real)
    store.write_tables(panel(11, "Rust"), root)
    assert store.read_table(spark, root, "responses").count() == 11
    assert {r.language for r in store.read_table(spark, root, "lang_exploded").collect()} == {"Rust"}


def test_a_reader_at_work_keeps_its_version_and_older_ones_go(spark, tmp_path, panel):
    root = str(tmp_path / "tables")
    store.write_tables(panel(3), root)
    reader = store.read_table(spark, root, "responses")
    store.write_tables(panel(4), root)
    assert reader.count() == 3 and store.read_table(spark, root, "responses").count() == 4
    store.write_tables(store.read_table(spark, root, "responses").unionByName(panel(2)), root)  # from its own tables
    assert store.read_table(spark, root, "responses").count() == 6
    assert len(versions.published(spark, root)) == 2
    for name in ("panel", "lang_exploded", "db_exploded", "lang_usage"):
        assert len([p for p in (tmp_path / "tables" / name).iterdir() if p.name.startswith("version=")]) == 2


def test_no_published_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        store.read_table(spark, str(tmp_path), "responses")


def test_names_of_writers_at_the_same_time_differ(spark, tmp_path):
    assert versions.new(spark, str(tmp_path)) != versions.new(spark, str(tmp_path))


def test_reconcile_joins_buckets_without_a_shuffle(spark, tmp_path, responses):
    root = str(tmp_path / "tables")
    rows = [{"response_id": i % 50 if i % 9 else None, "survey_year": 2021 + i % 3} for i in range(300)]
    store.write_tables(responses(*rows), root)
    both = [store.read_buckets(spark, root, n) for n in ("responses", "responses_clean")]
    assert both[0].columns == store.read_table(spark, root, "responses").columns
    assert sorted(map(str, both[0].collect())) == sorted(map(str, store.read_table(spark, root, "responses").collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = quality.row_reconcile(*both)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    join = plan.index("SortMergeJoin")
    assert "Exchange" in plan[:join] and "Exchange" not in plan[join:]
    plain = quality.row_reconcile(*[store.read_table(spark, root, n) for n in ("responses", "responses_clean")])
    assert df.collect() == plain.collect()


def test_adoption_from_bitmaps_is_adoption_from_rows(spark, tmp_path, responses):
    root = str(tmp_path / "tables")
    rows = [{"response_id": i * 40_000 - 7 if i % 11 else None, "survey_year": 2021 + i % 5,
             "lang_worked": [None, "Go;Rust", "Go; Go", ";", "Ada"][i % 5 - i % 2], "lang_want": ["Go", "Rust; ;Ada", None][i % 3]}
            for i in range(200)] + [{"response_id": None, "survey_year": 2021, "lang_worked": "Only"}]
    store.write_tables(responses(*rows), root)
    clean, long, usage = (store.read_table(spark, root, n) for n in ("responses_clean", "lang_exploded", "lang_usage"))
    for job, args in ((lang_trend, (0.0, 1)), (lang_endpoints, ()), (lang_desire_gap, (0,))):
        assert sorted(job(clean, long, *args, usage=usage).collect()) == sorted(job(clean, long, *args).collect())
    files = lang_trend(clean, long, usage=usage).inputFiles()
    assert any("/lang_usage/" in f for f in files) and not any("/lang_exploded/" in f for f in files)


def test_tables_without_rows(spark, tmp_path, responses):
    root = str(tmp_path / "tables")
    store.write_tables(responses({"response_id": 1}).limit(0), root)
    assert all(rows == [] for rows in tables(spark, root).values())
    assert store.read_buckets(spark, root, "responses").count() == 0
