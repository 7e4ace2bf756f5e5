"""Models by held-out accuracy; mixing and search against brute force; the pipeline end to end."""

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.llm import mixing, toxicity as X, vector_search as V
from cohortlens.llm.weak_quality import estimate, score_quality

SF, SF_LARGER = "/root/testdata/sf0.01", "/root/testdata/sf0.1"


def auc(score, label):
    order = np.argsort(np.argsort(score)) + 1
    n1, n0 = (label == 1).sum(), (label == 0).sum()
    return (order[label == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    net = {k: v.astype(np.float64) for k, v in X.new_network(rng).items()}
    tokens = X.Tokens([b"you idiot the cat", b"a b c d e f", b"", b"hello"])
    x = tokens.inputs(net).astype(np.float64)
    token, mask = X._laid_out(tokens, tokens.first[:-1], np.diff(tokens.first))
    y = np.array([1, 0, 1, 0.])

    def loss():
        logit = X.forward(net, x, token, mask)
        return np.mean(np.logaddexp(0, logit) - y * logit)
    keep = {}
    p = X.sigmoid(X.forward(net, x, token, mask, keep))
    g, dx = X.gradients(net, x, token, mask, (p - y) / 4, keep)
    for name, grad in [*g.items(), ("x", dx)]:
        at = x if name == "x" else net[name]
        i = tuple(rng.integers(0, s) for s in at.shape)
        old, at[i] = at[i], at[i] + 1e-3
        up, at[i] = loss(), old - 1e-3
        down, at[i] = loss(), old
        assert abs((up - down) / 2e-3 - grad[i]) < 1e-4


def test_every_token_is_in_a_window():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        _, start, length = X.windows(np.array([0, n]))
        seen = {t for s, k in zip(start, length) for t in range(s, s + k)}
        assert seen == set(range(n)) and (length <= X.WINDOW).all() and len(start) >= 1


def test_toxicity_on_held_out_rows(spark, docs):
    table = spark.read.parquet(f"{SF_LARGER}/documents.parquet")
    labels = spark.read.parquet(f"{SF_LARGER}/labels.parquet")
    model = X.train(table, labels)
    got = X.score_toxicity(table, model).join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r["held_out"]]
    score, label = np.array([r["score"] for r in held]), np.array([r["toxic"] for r in held])
    assert auc(score, label) > 0.93 and ((score >= 0.5) == label).mean() > 0.9
    odd = X.score_toxicity(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    left = X.reject_toxic(docs, model)
    assert left.columns == docs.columns
    assert left.count() == sum(r["score"] < 0.5 for r in odd)


def taught(spark):
    """Documents, half of them rude, and their labels."""
    rude = [(i, f"you stupid idiot number{i} get lost", 1) for i in range(0, 80, 2)]
    rows = rude + [(i, f"a quiet walk number{i} by the sea", 0) for i in range(1, 80, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_labels_of_other_documents_take_no_place_in_the_sample(spark):
    docs, labels = taught(spark)
    others = spark.range(1000, 9000).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic")
    sample = X._sample(docs, labels.union(others), 20).collect()
    assert sorted(r["y"] for r in sample) == [0] * 20 + [1] * 20
    assert all(r["y"] == 1 - r["doc_id"] % 2 for r in sample)
    model = X.train(docs, labels.union(others), rows=20)
    left = X.reject_toxic(docs, model).collect()
    assert {r["doc_id"] for r in left} == set(range(1, 80, 2))


@pytest.mark.parametrize("known", ["false", "doc_id >= 1000", "toxic = 1", "toxic = 0"])
def test_documents_stay_without_usable_labels(spark, known):
    docs, labels = taught(spark)
    model = X.train(docs, labels.unionByName(labels.withColumn("doc_id", F.col("doc_id") + 1000)).filter(known))
    assert {r["predicted"] for r in X.score_toxicity(docs, model).collect()} == {0}
    assert X.reject_toxic(docs, model).count() == docs.count()


def test_words_are_learnt_beyond_64_bytes(spark):
    rows = [(i, f"{'x' * 64}{('kind', 'rude')[i % 2]} number{i}", i % 2) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = X.train(df, df)
    new = spark.createDataFrame([(i, f"{'x' * 64}{('kind', 'rude')[i % 2]} else{i}") for i in range(20)], "doc_id long, text string")
    assert all(r["predicted"] == r["doc_id"] % 2 for r in X.score_toxicity(new, model).collect())


def test_labellers_accuracies_are_found():
    r = np.random.default_rng(2)
    good = r.random(20000) < 0.8
    votes = np.stack([np.where(good, np.where(r.random(20000) < 0.9, 2, 0), np.where(r.random(20000) < 0.6, 0, 2))
                      for _ in range(6)], 1)
    pattern, count = np.unique(votes, axis=0, return_counts=True)
    found = estimate(pattern, count.astype(float))
    assert abs(found["share"] - 0.8) < 0.03
    assert abs(found["right"][0, :, 0] - 0.6).max() < 0.05 and abs(found["right"][1, :, 0] - 0.1).max() < 0.03


def test_quality_against_labels_never_seen(spark, docs):
    table, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = score_quality(table).join(labels, "doc_id").collect()
    score, label = np.array([r["score"] for r in got]), np.array([r["quality"] for r in got])
    assert auc(score, label) > 0.95 and (score[label == 1] >= 0.5).mean() > 0.95
    assert score_quality(docs).count() == docs.count()


def test_swap_or_not_is_a_permutation(spark):
    for n in (1, 2, 7, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("x"))
        assert sorted(r["x"] for r in got.collect()) == list(range(n))


@pytest.mark.parametrize("block", [3, 64])
def test_mix(docs, block):
    mix = mixing.mix_sources(docs, block_words=block, shard_blocks=8)
    got = [r.asDict() for r in mixing.mix_digest(mix).collect()]
    again = [r.asDict() for r in mixing.mix_digest(mixing.mix_sources(docs, block_words=block, shard_blocks=8)).collect()]
    key = lambda r: (r["doc_id"] or -1, r["size"], r["taken"])
    assert sorted(got, key=key) == sorted(again, key=key)
    size = {}
    for r in docs.collect():
        size[r["source"]] = size.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(names)}
    target, left, free = {}, sum(size.values()), set(names)
    while over := [s for s in free if left * weight[s] / sum(weight[f] for f in free) > 3 * size[s]]:
        s = over[0]
        target[s] = 3 * size[s]
        left -= target[s]
        free.remove(s)
    target |= {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
    rows = mix.rows.collect()
    for s in names:
        mine = [r for r in rows if r["source"] == s]
        assert all(abs(r["target"] - target[s]) < 1e-6 and r["source_size"] == size[s] for r in mine)
        assert sum(r["size"] for r in mine) == size[s]
    taken = {}
    for p in mix.pieces.collect():
        taken[p["skey"]] = taken.get(p["skey"], 0) + p["n_words"]
    for s in names:
        assert abs(taken.get("0" if s is None else "1" + s, 0) - target[s]) <= 1
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    text = mixing.mixed_documents(docs, mix)
    assert text.columns == docs.columns
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in text.collect())
    assert words == sum(taken.values())


VECTORS = [(i, [((i * 37 + d * 11) % 41 - 20) / 7 for d in range(20)]) for i in range(300)] + [
    (400, None), (500, [None] + [0.0] * 19), (600, [float("nan")] * 20), (700, [float("inf")] * 20), (None, [1.0] * 20),
    (800, [1.0] * 3), (900, []), (7, [1.0] * 20), (3, [((3 * 37 + d * 11) % 41 - 20) / 7 for d in range(20)]), (1000, [3e38] * 20)]


@pytest.mark.parametrize("cell", [64, 8192])
def test_exact_topk(spark, cell, monkeypatch):
    monkeypatch.setattr(V, "FIRST_ROWS", 16)
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in VECTORS], "vec_id long, embedding array<float>, cell int, rank int")
    known = V.quantised(df, "vec_id", "embedding").distinct().collect()
    assert {r["id"] for r in known} == {i for i, _ in VECTORS} - {None, 400, 500, 600, 700}
    assert sum(r["id"] == 7 for r in known) == 2
    got = V.exact_topk(V.quantised(df, "vec_id", "embedding"), V.quantised(df, "vec_id", "embedding").filter("id % 100 = 0"),
                       10, cell_rows=cell, group_rows=2)
    expected = set()
    for q in known:
        if q["id"] % 100 == 0:
            scored = sorted((-sum(int(a) * int(b) for a, b in zip(q["v"], c["v"])), c["id"]) for c in known
                            if c["id"] != q["id"] and len(c["v"]) == len(q["v"]))
            edge = 2**63 - 1  # (1000, 3e38) takes part; its scores are the nearest longs
            expected |= {(q["id"], n + 1, i, max(-edge, min(edge, -s))) for n, (s, i) in enumerate(scored[:10])}
    assert {tuple(r) for r in got.collect()} == expected
    none = V.quantised(df.limit(0), "vec_id", "embedding")
    assert V.exact_topk(none, none).count() == 0


def test_large_components_keep_exact_scores(spark):
    rows = [(i, [1e15 + i, -1e15]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    v = V.quantised(df, "vec_id", "embedding")
    top = np.iinfo(np.int64).max
    assert all(r["score"] == top for r in V.exact_topk(v, v.filter("id = 0"), 3).collect())


def test_pipeline_runs_its_stages_in_order(spark, frame):
    import corpus_pipeline as P
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_dedup", "secret_scan", "mixing", "packing"]
    given = spark.read.parquet(f"{SF}/documents.parquet").limit(300).withColumn("extra", F.lit(1))
    docs = given
    for name, stage in P.STAGES[:-1]:
        before = docs
        docs = P.staged(stage(spark, docs, SF), name)
        assert docs.columns == given.columns
        if name in ("toxicity", "near_dedup"):
            assert docs.join(before, given.columns, "left_anti").count() == 0 and docs.count() < before.count()
        if name == "secret_scan":
            assert docs.count() == before.count()
            assert not [r for r in docs.collect() if re.search(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}", r["text"])]
    pieces = P.STAGES[-1][1](spark, docs, SF)
    total = pieces.groupBy("doc_id").agg(F.sum("length").alias("n")).agg(F.sum("n")).first()[0]
    assert total == sum(x["doc_tokens"] for x in pieces.filter("start = 0").collect())


def test_training_samples_are_bounded_by_rows_and_bytes(spark):
    """Five thousand rows of one id, and a word of ten megabytes, bring no more than is stated."""
    docs = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("rude "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert X._sample(docs, labels, 20).count() == 20
    same = docs.select("doc_id", F.lit("the same text").alias("text"))
    assert X._sample(same, labels, 20).count() == 1
    long = docs.limit(3).unionByName(spark.createDataFrame([(2, "x" * 10_000_000 + " end")], "doc_id long, text string"))
    windows = X._drawn(X._sample(long, labels, 20), 50).collect()
    assert len(windows) == 50 and max(len(w["part"]) for w in windows) <= X.WINDOW * (X.LONGEST + 1)
    everything = X._drawn(X._sample(long, labels, 20), 10**6).collect()
    assert sum(len(w["part"].replace(b" ", b"")) for w in everything if w["doc_id"] == 2) > 10_000_000


def test_long_words_are_read_whole():
    """Two texts that differ in the last byte of a long word only have different pieces."""
    a, b = X.Tokens([b"y" * 500 + b"a z"]), X.Tokens([b"y" * 500 + b"b z"])
    assert len(a.word) == 9 and sorted(a.row) != sorted(b.row)
    assert X.pieces([b"y" * 130])[0].split() == [b"y" * 64, b"y" * 64, b"yy"]


def test_quality_sample_is_bounded_by_rows(spark, monkeypatch):
    """Five thousand rows of one id bring as many training rows as are asked for, whole."""
    from cohortlens.llm import weak_quality as W
    seen = []
    real = W.train_linear
    monkeypatch.setattr(W, "train_linear", lambda text, bucket, value, target: seen.append((text, bucket, target)) or real(
        text, bucket, value, target))
    long = " ".join(f"w{i}" for i in range(30_000))
    docs = spark.range(5000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(
        F.lit("A plain line that ends well. "), F.col("id").cast("string")).alias("text")).unionByName(
        spark.createDataFrame([(2, long), (3, None), (None, "no id"), (4, "")], "doc_id long, text string"))
    got = W.score_quality(docs, rows=20)
    assert got.count() == 5004
    (text, bucket, target), = seen
    assert len(target) <= 40
    rows = {r["doc_id"]: r for r in got.where("doc_id > 1").collect()}
    assert set(rows) == {2, 3, 4} and all(0 <= r["score"] <= 1 for r in rows.values())
    assert rows[3]["votes"] == rows[4]["votes"] and rows[3]["score"] == rows[4]["score"]
    few = W.score_quality(docs.where("doc_id > 1"), rows=20)
    assert few.count() == 3
    assert (np.bincount(seen[-1][0]) > 1024).any()  # of a long text all features are learnt from
