"""Mixing sources to target weights: token blocks, multinomial shards, index permutations.

Only DataFrame functions.  The words of a source, in a fixed order of its documents, form
blocks of ``block_words``.  A source's target (its weight's share, at most ``max_repeats``
times its size) gives a number of slots: full passes over its blocks and a part of one
more.  Every slot falls into a shard by a uniform draw, so a shard's counts by source are
multinomial with the targets as weights while the totals stay at the targets.  Slot j of a
pass goes through a pseudorandom permutation of the source's block numbers (another one for
each pass), and blocks join slots by number.  Only counts and offsets are shuffled, no text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.staging import staged

WORD_GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"
ROUNDS, CHUNK, BUCKET_ROWS = 16, 4096, 2000


def words_of(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, WORD_GAP))).cast("long")


def _source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), source.cast("string")))


def targets(sizes: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """``sizes`` (skey, source_size), one row per source -> with ``target``, a double.

    Weights go round the sources by code point, null last.  A target is the smaller of
    ``max_repeats * source_size`` and level * weight, with the level at which all targets add
    up to all sizes: sources ordered by where they reach their stop, and the level after the
    stopped ones taken out.  One small row per source meets in one task here.
    """
    by_name = Window.orderBy(F.substring("skey", 1, 1).desc(), "skey")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    named = sizes.withColumn("w", weight.cast("double")).withColumn(
        "cap", (F.col("source_size") * max_repeats).cast("double"))
    up = Window.orderBy(F.col("cap") / F.col("w"), "skey")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    after = up.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum(
        "w").over(after)
    leveled = named.withColumn("level", level).withColumn("stopped", F.col("cap") <= F.col("level") * F.col("w"))
    final = F.max(F.when(~F.col("stopped"), F.col("level"))).over(everything)
    return leveled.withColumn("final", final).select("skey", "source_size", F.when(
        F.col("stopped"), F.col("cap")).otherwise(F.col("final") * F.col("w")).alias("target"))


def permuted(index: Column, n: Column, *salt: Column) -> Column:
    """A pseudorandom permutation of 0..n-1 at ``index`` (swap-or-not: each round pairs x with
    k - x mod n and a hash of the pair's larger number decides whether to change sides)."""
    def step(x, r):
        partner = F.pmod(F.pmod(F.xxhash64(F.lit("key"), r, *salt), n) - x, n)
        return F.when(F.xxhash64(F.lit("side"), r, F.greatest(x, partner), *salt) % 2 == 0, partner).otherwise(x)
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index.cast("long"), step)


class Mix:
    """rows (doc_id, source, skey, size, first: its first word's place in the source,
    source_size, target), and pieces (shard, slot, skey, pass, block, first, from_word, n_words)."""

    def __init__(self, rows: DataFrame, pieces: DataFrame):
        self.rows, self.pieces = rows, pieces


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeats: int = 3,
                block_words: int = 512, shard_blocks: int = 1024, seed: int = 17) -> Mix:
    """Mix ``docs`` (doc_id, source, text).

    Null and word-free texts have size 0 and take part in nothing.  A null source is a source
    of its own.  Repeated rows are documents of their own.  Other columns are ignored; an
    empty table gives no rows.  The words taken from a source are its target, rounded; no
    document is taken more than ``max_repeats`` times.  Reruns agree: every draw is a hash.
    """
    sized = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                               word_count(F.col("text")).alias("size")), "sizes")
    buckets = max(1, -(-sized.count() // BUCKET_ROWS))
    keyed = sized.withColumn("skey", _source_key(F.col("source"))).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)))
    sums = keyed.groupBy("skey", "bucket").agg(F.sum("size").alias("words"))
    ahead = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("skey", "bucket", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("skey", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
        sums, ["skey", "bucket"]).withColumn("first", F.col("base") + F.col("within"))

    plan = staged(targets(keyed.groupBy("skey").agg(F.sum("size").alias("source_size")), weights, max_repeats), "targets")
    rows = staged(placed.join(plan, "skey").select(
        "doc_id", "source", "skey", "size", "first", "source_size", "target"), "placed")

    quota = plan.filter("source_size > 0").withColumn("want", F.round("target").cast("long")).selectExpr(
        "skey", "source_size as n", f"(source_size + {block_words - 1}) div {block_words} as blocks",
        "want div source_size as full", "want % source_size as rest").selectExpr(
        "*", f"full * blocks + if(rest = 0, 0, least(blocks, (rest + {block_words - 1}) div {block_words} + 1)) as slots")
    total = quota.agg(F.sum("slots")).first()[0] or 0
    shards = max(1, -(-total // shard_blocks))
    slots = quota.filter("slots > 0").withColumn("chunk", F.explode(F.expr(f"sequence(0L, (slots - 1) div {CHUNK})")))
    # a number of partitions keeps these few rows apart: each makes CHUNK slots
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = slots.repartition(parts, "skey", "chunk").withColumn("k", F.explode(F.expr(
        f"sequence(chunk * {CHUNK}, least(slots, (chunk + 1) * {CHUNK}) - 1)")))
    slots = slots.withColumn("pass", F.expr("k div blocks")).withColumn("j", F.expr("k % blocks"))
    slots = slots.withColumn("block", permuted(F.col("j"), F.col("blocks"), F.lit(seed), F.col("skey"), F.col("pass")))
    # in the last, partial pass: words before slot j, less the gap of the short last block where it came earlier
    short = slots.filter("pass = full and block = blocks - 1").select("skey", F.col("j").alias("short"))
    slots = slots.join(short, "skey", "left").withColumn("before", F.expr(
        f"j * {block_words} - if(short < j, blocks * {block_words} - n, 0)"))
    slots = slots.withColumn("take", F.expr(
        f"if(pass < full, {block_words}, greatest(0, least({block_words}, rest - before)))")).filter("take > 0")
    slots = slots.select("skey", "pass", "block", "take", F.pmod(
        F.xxhash64(F.lit(seed), "skey", "k"), F.lit(shards)).alias("shard"), F.xxhash64(
        F.lit(seed + 1), "skey", "k").alias("slot"))

    runs = rows.filter("size > 0").select("skey", "first", "size", F.explode(F.expr(
        f"sequence(first div {block_words}, (first + size - 1) div {block_words})")).alias("block"))
    met = runs.join(slots, ["skey", "block"])
    start, end = F.greatest("first", F.col("block") * block_words), F.least(
        F.col("first") + F.col("size"), F.col("block") * block_words + F.col("take"))
    pieces = met.select("shard", "slot", "skey", "pass", "block", "first", (start - F.col("first")).alias("from_word"),
                        (end - start).alias("n_words")).filter("n_words > 0")
    return Mix(rows, pieces)


def mix_digest(mix: Mix) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken."""
    taken = mix.pieces.groupBy("skey", "first").agg(F.sum("n_words").alias("taken")).withColumn("held", F.lit(True))
    rows = mix.rows.withColumn("held", F.col("size") > 0)
    return rows.join(taken, ["skey", "first", "held"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def mixed_documents(docs: DataFrame, mix: Mix) -> DataFrame:
    """The columns of ``docs`` with one row per document and pass that took words of it: the
    whole text where all words were taken, else the taken words joined by spaces.

    Documents are found again by doc_id and size; rows equal in both are interchangeable in
    number of words, and each gets its own takes.
    """
    takes = mix.pieces.groupBy("skey", "first", "pass").agg(F.sort_array(F.collect_list(
        F.struct("from_word", "n_words"))).alias("runs"), F.sum("n_words").alias("n"))
    order = Window.partitionBy("doc_id", "skey", "size").orderBy("first")
    rows = mix.rows.filter("size > 0").withColumn("nth", F.row_number().over(order)).select(
        F.col("doc_id").alias("__id"), F.col("skey").alias("__skey"), F.col("size").alias("__size"),
        F.col("nth").alias("__nth"), "skey", "first")
    takes = takes.join(rows, ["skey", "first"]).select("__id", "__skey", "__size", "__nth", F.struct(
        "runs", "n").alias("__take"))
    own = docs.select("*", F.col("doc_id").cast("long").alias("__d"), _source_key(F.col("source")).alias("__s"),
                      word_count(F.col("text")).alias("__z"))
    same = Window.partitionBy("__d", "__s", "__z").orderBy("text")
    own = own.withColumn("__n", F.row_number().over(same))
    met = own.join(takes, (own["__d"].eqNullSafe(takes["__id"])) & (own["__s"] == takes["__skey"])
                   & (own["__z"] == takes["__size"]) & (own["__n"] == takes["__nth"]))
    met = met.withColumn("__w", F.when(F.col("__take.n") < F.col("__size"), words_of(F.col("text"))))
    cut = F.array_join(F.flatten(F.transform("__take.runs", lambda r: F.slice(
        F.col("__w"), (r["from_word"] + 1).cast("int"), r["n_words"].cast("int")))), " ")
    text = F.when(F.col("__w").isNull(), F.col("text")).otherwise(cut)
    return met.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])
