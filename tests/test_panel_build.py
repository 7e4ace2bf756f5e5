"""The panel's build: what is shuffled, and in which state."""

import datetime

from cohortlens.plans.trends import language_usage
from cohortlens.sources import store, survey_csv
from cohortlens.sources.panel import survey_panel


def star(spark, folder):
    day = datetime.datetime(1996, 1, 1)
    tables = {
        "orders": ([(i if i % 17 else None, i % 7, 1000.0 + i, day + datetime.timedelta(days=40 * i), "1-URGENT") for i in range(120)],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "customer": ([(i, i % 3, "AUTO") for i in range(7)], "c_custkey long, c_nationkey int, c_mktsegment string"),
        "nation": ([(i, f"N{i}") for i in range(3)], "n_nationkey int, n_name string"),
        "lineitem": ([(i % 100, i % 11, i % 13) for i in range(400)], "l_orderkey long, l_partkey long, l_suppkey long"),
        "part": ([(i, f"part {i % 5}", f"B{i % 3}") for i in range(10)], "p_partkey long, p_name string, p_brand string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def planned(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_the_panel_comes_dealt_by_respondent(spark, tmp_path):
    plan = planned(spark, survey_panel(spark, star(spark, tmp_path)).select("*"))
    top = plan[:plan.index("SortMergeJoin")]
    assert "Exchange" not in top
    # lines are dealt as they are: both steps of the lists lie above the exchange
    partial = plan.index("partial_collect_set")
    assert "Exchange hashpartitioning(l_orderkey" in plan[partial:] and "Exchange" not in plan[plan.index("collect_set"):partial]


def test_a_dealt_panel_is_written_as_a_rebalanced_one(spark, tmp_path):
    panel = survey_panel(spark, star(spark, tmp_path / "star"))
    found = {}
    for dealt in (True, False):
        root = str(tmp_path / f"tables_{dealt}")
        store.write_tables(panel, root, dealt=dealt)
        found[dealt] = {n: sorted(map(str, store.read_table(spark, root, n).collect()))
                        for n in ("responses", "responses_clean", "lang_exploded", "db_exploded", "lang_usage")}
        buckets = store.read_buckets(spark, root, "responses")
        assert sorted(map(str, buckets.collect())) == found[dealt]["responses"]
        files = [f.rsplit("/", 2)[1:] for f in buckets.inputFiles()]
        assert len({(year, name.split("_")[-1]) for year, name in files}) == len(files)  # a file for each year and bucket
    assert found[True] == found[False] and len(found[True]["responses"]) == 120


def test_bitmaps_are_built_where_their_ids_meet(spark, responses):
    """Not by every task that holds a few ids of a range."""
    rows = responses(*[{"response_id": i, "lang_worked": "Go;Rust", "lang_want": None if i % 2 else " Ada"} for i in range(40)])
    usage = language_usage(rows)
    plan = planned(spark, usage.select("*"))
    assert "Exchange hashpartitioning(survey_year" in plan[plan.index("partial_bitmap_construct_agg"):]
    assert {(r.language, r.kind) for r in usage.collect()} == {("Go", "used"), ("Rust", "used"), ("Ada", "wanted")}


def test_bitmaps_are_not_shuffled_and_rows_without_an_id_name_their_languages(spark, responses):
    rows = responses(*[{"response_id": i, "lang_worked": "Go"} for i in (1, 2, 40_000)],
                     *[{"response_id": None, "lang_worked": "Go; Ada", "lang_want": "Go"} for _ in range(3)])
    usage = language_usage(rows)
    plan = planned(spark, usage.where("bucket is not null").select("*"))
    known = plan[:plan.index("\n:- ")] + plan[plan.index("\n:- "):plan.index("\n+- ")] if "Union" in plan else plan
    assert known.count("Exchange") == 1
    found = {(r.language, r.kind, r.bucket): sum(b.bit_count() for b in r.bits) for r in usage.collect()}
    assert found == {("Go", "used", 1): 2, ("Go", "used", 2): 1, ("Go", "used", None): 0, ("Ada", "used", None): 0,
                     ("Go", "wanted", None): 0}
    assert usage.count() == len(found)


def test_yearly_files_need_the_panel_only(spark, tmp_path):
    """The long tables are written when first asked for; the files are packed and read back whole."""
    sf = star(spark, tmp_path / "star")
    files = survey_csv.survey_files(spark, sf)
    handle = store.store(spark, sf)

    def written():
        return {n for n in ("panel", *store.LONG_TABLES) if store.versions._names(spark, f"{handle.root}/{n}")}

    assert written() == {"panel"}
    parts = [f for y in survey_csv.YEARS for f in survey_csv.headers(spark, survey_csv.year_path(files, y))]
    assert parts and all(f.endswith(".csv.gz") for f in parts)
    shown = ["response_id", "survey_year", "country", "lang_worked"]
    assert sorted(map(str, survey_csv.ingest(spark, files).select(shown).collect())) == sorted(
        map(str, handle.responses().select(shown).collect()))
    assert handle.lang_exploded().count() and written() == {"panel", "lang_exploded"}
    assert handle.lang_usage().count() and handle.db_exploded().count() and written() == {"panel", *store.LONG_TABLES}
