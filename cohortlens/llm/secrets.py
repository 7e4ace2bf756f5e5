"""Secret scans with corpus-wide ownership frequency.  Only DataFrame functions.

Every text is searched for assignments, access keys and long hex runs (the base kinds), and
for other long mixed tokens.  Hashes of all found values are counted by distinct repositories
and owners: a value of many owners, or in many repositories, is a copied example; one of few
looks live.  Base spans are always reported; other tokens only where they look live.

A text gives out the lengths of its matches and of the gaps between them; positions are running
sums, and overlaps running maxima, over those rows, so the work is in proportion to the matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.staging import staged

# fixed values of the contract
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: A whole run of token characters with a digit in it; 20 or more.
TOKEN = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{20,}+"
KINDS = ("assign", "access", "hex", "token")
LEAST = (6, 20, 24, 20)  # characters of a value
LIVE_OWNERS, LIVE_REPOS = 2, 8
SPAN = "struct<start:int,no:int,end:int,value:string>"


def _matches(no: int, text: Column, pattern: str, group: int) -> Column:
    """Leftmost non-overlapping matches in order: kind, place, length of the text since the match
    before, length and value."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    parts = F.arrays_zip(found.alias("m"), value.alias("v"), F.split(text, pattern, -1).alias("gap"))
    each = F.transform(F.slice(parts, 1, F.size(found)), lambda p, i: F.struct(
        F.lit(no).alias("no"), i.alias("place"), F.length(p["gap"]).alias("gap"), F.length(p["m"]).alias("length"),
        p["v"].alias("value")))
    return F.when(text.rlike(pattern), each)


def _spans(matches: DataFrame) -> DataFrame:
    """(row, ..., start, end, covered) for rows (row, no, place, gap, length, value): code-point
    positions, short matches left out, and whether a base span overlaps (of tokens)."""
    before = Window.partitionBy("row", "no").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    least = F.get(F.array(*[F.lit(n) for n in LEAST]), F.col("no"))
    spans = matches.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(before).cast("int")).withColumn(
        "start", F.col("end") - F.col("length")).filter(F.length("value") >= least)
    spans = spans.filter((F.col("no") < 3) | F.col("value").rlike("[A-Za-z]"))
    base = F.col("no") < 3
    ahead = Window.partitionBy("row").orderBy("start", "no").rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("row").orderBy(F.col("start").desc(), F.col("no").desc()).rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(base, F.col("end"))).over(ahead)  # of base spans that do not start later
    later = F.min(F.when(base, F.col("start"))).over(behind)  # of base spans that do not start earlier
    covered = F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(later < F.col("end"), F.lit(False))
    return spans.withColumn("covered", ~base & covered).drop("place", "gap", "length")


def span_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat(
        F.get(names, s["no"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, repo_col: str = "doc_id", owner_col: str = "source",
                 live_owners: int = LIVE_OWNERS, live_repos: int = LIVE_REPOS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text and the two named columns): doc_id, text_key,
    base and spans (arrays of start, kind number, end, value by start and kind), n_live and
    n_example (spans by their value: live with at most ``live_owners`` distinct owners and
    ``live_repos`` distinct repositories, an example with more of either).

    A null text has no spans.  All rows without an owner (or repository) count as one owner
    (repository).  Repeated rows have the same result each.  Other columns are ignored; an empty
    table gives no rows.
    """
    text = F.col("text")
    read = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col(repo_col).cast("string").alias("repo"), F.col(owner_col).cast("string").alias("owner"),
        F.coalesce(text, F.lit("")).alias("text"))
    kinds = [_matches(0, text, ASSIGN, 2), _matches(1, text, ACCESS, 0), _matches(2, text, HEX, 0), _matches(3, text, TOKEN, 0)]
    found = staged(read.select("row", "doc_id", "repo", "owner", F.xxhash64("doc_id", "text").alias("text_key"),
                               F.flatten(F.array_compact(F.array(*kinds))).alias("matches")), "secrets")
    rows = found.select("row", "repo", "owner", F.inline("matches")).withColumn("hash", F.sha2("value", 256))
    spans = _spans(rows).filter(~F.col("covered")).drop("covered")

    def distinct(name: str) -> Column:
        return F.countDistinct(name) + F.max(F.col(name).isNull().cast("int"))

    owners = spans.groupBy("hash").agg(distinct("owner").alias("owners"), distinct("repo").alias("repos"))
    told = spans.join(owners, "hash").withColumn(
        "live", (F.col("owners") <= live_owners) & (F.col("repos") <= live_repos))
    span = F.struct("start", "no", "end", "value")

    def listed(held: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(held, span)))

    told = told.groupBy("row").agg(
        listed(F.col("no") < 3).alias("base"), listed((F.col("no") < 3) | F.col("live")).alias("spans"),
        F.sum(F.col("live").cast("long")).alias("n_live"), F.sum((~F.col("live")).cast("long")).alias("n_example"))
    none = F.array().cast(f"array<{SPAN}>")
    return found.select("row", "doc_id", "text_key").join(told, "row", "left").select(
        "doc_id", "text_key", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"))


def secret_digest(found: DataFrame) -> DataFrame:
    def count(no):
        return F.size(F.filter("base", lambda s: s["no"] == no)).cast("long")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"), "n_live", "n_example")


def redacted(docs: DataFrame, found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The rows and columns of ``docs`` with every reported span replaced by ``mark``, overlapping
    spans by one.  Null and empty texts, and texts without spans, stay as they are; repeated rows
    stay; no rows give no rows."""
    keys = ["__id", "__key"]
    spans = found.filter(F.size("spans") > 0).select(
        F.coalesce("doc_id", F.lit(-1)).alias("__id"), F.col("text_key").alias("__key"), "spans").dropDuplicates(keys)
    each = spans.select(*keys, F.posexplode("spans").alias("__at", "__s")).select(
        *keys, "__at", F.col("__s.start").alias("start"), F.col("__s.end").alias("end"))
    ahead = Window.partitionBy(*keys).orderBy("__at")
    new = F.coalesce(F.col("start") >= F.max("end").over(ahead.rowsBetween(Window.unboundedPreceding, -1)), F.lit(True))
    parts = each.withColumn("new", new.cast("int")).withColumn(
        "part", F.sum("new").over(ahead.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "part").agg(
        F.min("start").alias("start"), F.max("end").alias("end")).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("__parts"))
    own = docs.withColumn("__d", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))).withColumn(
        "__k", F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))))
    met = own.join(parts, (own["__d"] == parts["__id"]) & (own["__k"] == parts["__key"]), "left")
    # four bytes a code point, so that a piece is cut without reading the text before it; both
    # columns are used twice, or Spark would work them out anew for each piece
    zero = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"))
    last = F.struct(F.length("text").alias("start"), F.length("text").alias("end"))
    met = met.withColumn("__wide", F.when(F.col("__parts").isNotNull(), F.encode("text", "UTF-32"))).withColumn(
        "__edges", F.concat(F.array(zero), F.col("__parts"), F.array(last)))
    four = F.lit(4)

    def piece(start: Column, end: Column) -> Column:
        return F.decode(F.substring("__wide", start * four + 1, (end - start) * four), "UTF-32")

    kept = F.transform(F.slice("__edges", 2, F.size("__edges") - 1), lambda e, i: piece(F.get("__edges", i)["end"], e["start"]))
    text = F.when(F.col("__wide").isNull(), F.col("text")).otherwise(F.array_join(kept, mark))
    return met.select(*[text.alias(c) if c == "text" else F.col(c) for c in docs.columns])
