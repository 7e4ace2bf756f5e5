"""Order statistics found by counting, against sorting in Python and Spark's own window."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortlens.operators.distribution import ntile_bounds, ntile_mix
from cohortlens.operators.ordinal import at_positions, block_of, exact_percentiles, group_sizes, ntile, values_at


def frame(spark, sizes, values, seed=7):
    rnd = random.Random(seed)
    rows = [(g, i) for g, n in sizes.items() for i in range(n)]
    return spark.createDataFrame([(g, k, values(rnd)) for k, (g, _) in enumerate(rows)], "g string, rid long, v double")


SIZES = {"hot": 900, "a": 101, "b": 7, "c": 1, None: 23}
VALUES = {"spread": lambda r: r.uniform(-3e5, 3e5), "tied": lambda r: r.choice([-5.0, 0.0, 1000.0, 1000.5]),
          "half tied": lambda r: 50000.0 if r.random() < 0.5 else round(r.uniform(1, 1e6), 2)}


def grouped(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r["g"]].append((r["v"], r["rid"]))
    return {g: sorted(rows) for g, rows in out.items()}


def test_blocks_never_fall(spark):
    rnd = random.Random(1)
    x = sorted([0.0, -0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, *(rnd.uniform(-1, 1) * 10 ** rnd.randint(-20, 20) for _ in range(500))])
    got = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, v double").select("i", block_of(F.col("v")).alias("b"))
    blocks = [r["b"] for r in got.orderBy("i").collect()]
    assert blocks == sorted(blocks)


@pytest.mark.parametrize("kind", VALUES)
def test_percentiles_are_linear_between_rows(spark, kind):
    df = frame(spark, SIZES, VALUES[kind])
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", (0.0, 0.25, 0.5, 0.9), ["q0", "q1", "q2", "q3"]).collect()}
    for g, rows in grouped(df).items():
        v = [x for x, _ in rows]
        assert got[g]["_n"] == len(v)
        assert list(got[g][2:]) == pytest.approx(np.percentile(v, [0, 25, 50, 90]).tolist(), abs=1e-6)


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("k", [4, 10])
def test_ntile_is_sparks_window(spark, kind, k):
    df = frame(spark, SIZES, VALUES[kind])
    own = Window.partitionBy("g").orderBy("v", "rid")
    both = ntile(df, ["g"], ["v", "rid"], k, "t").withColumn("w", F.ntile(k).over(own)).collect()
    assert len(both) == sum(SIZES.values()) and all(r["t"] == r["w"] for r in both)


def test_positions_beyond_a_group_are_null(spark):
    df = frame(spark, {"x": 3, "y": 1}, VALUES["spread"])
    got = {r["g"]: r for r in values_at(df, ["g"], "v", {"first": F.lit(0), "third": F.lit(2), "none": F.lit(-1)}).collect()}
    rows = grouped(df)
    assert got["x"]["first"] == rows["x"][0][0] and got["x"]["third"] == rows["x"][2][0]
    assert got["y"]["third"] is None and got["x"]["none"] is None


def test_rows_at_positions_break_ties_by_the_next_column(spark):
    df = frame(spark, {"x": 50}, VALUES["tied"])
    wanted = group_sizes(df, ["g"]).select("g", F.lit("p").alias("_tag"), F.lit(20).cast("long").alias("_pos"))
    (got,) = at_positions(df, ["g"], ["v", "rid"], wanted).collect()
    assert (got["v"], got["rid"]) == grouped(df)["x"][20]


def test_nulls_do_not_count_and_groups_of_two_columns(spark):
    rows = [(2023, "r", float(v)) for v in (1, 2, 3, 4)] + [(2023, "r", None), (2024, "r", 10.0), (2024, None, 7.0)]
    df = spark.createDataFrame(rows, "y int, k string, v double")
    got = {(r["y"], r["k"]): (r["_n"], r["m"]) for r in exact_percentiles(df, ["y", "k"], "v", (0.5,), ["m"]).collect()}
    assert got == {(2023, "r"): (4, 2.5), (2024, "r"): (1, 10.0), (2024, None): (1, 7.0)}


def test_ends_of_buckets(spark):
    df = frame(spark, SIZES, VALUES["half tied"])
    t = df.withColumn("t", F.ntile(10).over(Window.partitionBy("g").orderBy("v", "rid"))).groupBy("g").agg(
        F.max(F.when(F.col("t") == 1, F.col("v"))).alias("d1"), F.min(F.when(F.col("t") == 9, F.col("v"))).alias("d9"))
    expected = {r["g"]: (r["d1"], r["d9"]) for r in t.collect()}
    got = ntile_bounds(df, ["g"], "v", 10, ceiling_of=1, floor_of=9).collect()
    assert {r["g"]: (r["d1_ceiling"], r["d9_floor"]) for r in got} == expected


def test_mix_over_buckets(spark):
    df = spark.createDataFrame([(1, i, float(i), "ab"[i % 2]) for i in range(8)], "y int, rid long, v double, role string")
    got = ntile_mix(df, ["y"], ["v", "rid"], 4, ["role"], {"top": 4, "low": 1}).collect()
    assert {tuple(r) for r in got} == {("a", 4, 25.0, 25.0), ("b", 4, 25.0, 25.0)}


def test_no_task_reads_much_more_than_the_mean_of_a_tied_column(spark):
    """Half of the rows hold one value: they are counted before the shuffle, so what the tasks
    after it read is one row per task and value, not the ties."""
    df = spark.range(200_000).select(F.lit("g").alias("g"), F.when(
        F.col("id") % 2 == 0, F.lit(5.0)).otherwise(F.col("id") * 1.0).alias("v"))
    counted = df.withColumn("b", block_of(F.col("v"))).groupBy("g", "b").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2  # partial below the exchange, final above
    assert counted.count() < 70_000
    (r,) = exact_percentiles(df, ["g"], "v", (0.25, 0.5), ["q", "m"]).collect()
    assert (r["_n"], r["q"], r["m"]) == (200_000, 5.0, 5.0) or r["m"] == pytest.approx(5.0, abs=5)


def test_nan_and_infinity_have_their_place(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("n", v) for v in (1.0, 2.0, 9.0, 10.0, nan, nan)] + [("i", v) for v in (-inf, -inf, 3.0, inf, inf)] + [("o", nan)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r for r in exact_percentiles(df, ["g"], "v", (0.0, 0.4, 0.5, 1.0), ["a", "b", "c", "d"]).collect()}
    assert tuple(got["n"])[1:5] == (6, 1.0, 9.0, 9.5) and np.isnan(got["n"]["d"])
    assert (got["i"]["_n"], got["i"]["a"], got["i"]["c"], got["i"]["d"]) == (5, -inf, 3.0, inf)
    assert np.isnan(got["o"]["c"])
    x = [-inf, -1.7e308, 0.0, 5e-324, 1.7e308, inf, nan]
    blocks = spark.createDataFrame([(i, v) for i, v in enumerate(x)], "i int, v double").select("i", block_of(F.col("v")).alias("b"))
    order = [r["b"] for r in blocks.orderBy("i").collect()]
    assert order == sorted(order) and len(set(order)) == len(x)


def test_percentiles_read_their_rows_twice(spark, tmp_path):
    """Once for the blocks (done when the frame is built), once more for the values of the blocks hit."""
    frame(spark, SIZES, VALUES["spread"]).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    plan = exact_percentiles(rows, ["g"], "v", (0.1, 0.5, 0.9), ["a", "b", "c"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count(str(tmp_path / "rows")) == 1
    ranked = ntile(rows, ["g"], ["v", "rid"], 4, "q")._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "rows") not in ranked


def test_half_the_rows_on_one_value_are_dealt_evenly(spark, monkeypatch):
    from cohortlens.operators import ordinal
    written = {}
    staged = ordinal.staged
    monkeypatch.setattr(ordinal, "staged", lambda df, tag: written.setdefault(tag, staged(df, tag)))
    df = spark.range(40_000).select((F.col("id") % 2).alias("g"), "id", F.when(
        F.col("id") % 4 < 2, F.lit(5.0)).otherwise(F.col("id") * 1.0).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = ordinal.placed(df, ["g"], ["v", "id"])
        sizes = [r["count"] for r in written["placed"].groupBy("_task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    want = df.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")) - 1)
    assert want.join(rows, ["g", "id"]).where("p <> _pos or _n <> 20000").count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 10, 11, 40, 41])
def test_bucket_of_a_position_is_sparks(spark, n):
    from cohortlens.operators.ordinal import bucket_at
    df = spark.range(n).select("id", F.lit(n).cast("long").alias("n"), F.ntile(4).over(Window.orderBy("id")).alias("w"))
    assert all(r["b"] == r["w"] for r in df.select(bucket_at(F.col("id"), 4, F.col("n")).alias("b"), "w").collect())
