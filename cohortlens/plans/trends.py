"""Language adoption jobs: trend with year-over-year change, endpoint movers, desire gap.

The jobs share one stored aggregate, ``lang_usage``: who uses and who wants each language in
each year, as bitmaps of respondents (``language_usage``).  With it they read neither the
exploded answers nor the answer lists; without it the same counts come from the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.rules import non_blank, strip_unicode
from cohortlens.operators.bitmaps import distinct_bitmaps, distinct_counts
from cohortlens.operators.stats import (
    adoption_rate, endpoint_compare, percent, period_delta, rank_within,
)

YEAR = "survey_year"


def _wanted(clean: DataFrame) -> DataFrame:
    """(survey_year, response_id, language): each wanted language of each answer list."""
    return clean.where(F.col("lang_want").isNotNull()).select(
        YEAR, "response_id", F.explode(F.split("lang_want", ";", -1)).alias("_tok")).select(
        YEAR, "response_id", F.trim("_tok").alias("language"))


def language_usage(clean: DataFrame) -> DataFrame:
    """(survey_year, language, kind, bucket, bits): respondents who use (kind ``used``) or want
    (``wanted``) a language.  Blank languages are in it as they are in the answers.

    Answer lists are dealt by year and range of ids before the bitmaps are built: a bitmap is made
    once, not by every task that holds a few of its ids, and is not shuffled.  Rows without an id
    set no bit; only the languages they name are."""
    lists = clean.select(YEAR, "response_id", "lang_worked", "lang_want").where(
        "lang_worked is not null or lang_want is not null")

    def named(source: str, strip, kind: str) -> Column:
        tokens = F.transform(F.split(source, ";", -1), lambda t: F.struct(strip(t).alias("language"), F.lit(kind).alias("kind")))
        return F.coalesce(tokens, F.array().cast("array<struct<language:string,kind:string>>"))

    each = F.concat(named("lang_worked", strip_unicode, "used"), named("lang_want", F.trim, "wanted"))

    def named_by(rows: DataFrame, *more: str) -> DataFrame:
        return rows.select(YEAR, "response_id", *more, F.explode(each).alias("_each")).select(
            YEAR, "response_id", *more, "_each.language", "_each.kind")

    known = lists.where("response_id is not null").withColumn("bucket", F.bitmap_bucket_number("response_id"))
    unknown = named_by(lists.where("response_id is null")).distinct()
    return distinct_bitmaps(named_by(known.repartition(YEAR, "bucket"), "bucket"), [YEAR, "language", "kind"], "response_id", given=True).unionByName(
        distinct_bitmaps(unknown, [YEAR, "language", "kind"], "response_id"))


def language_rates(clean: DataFrame, lang_exploded: DataFrame, usage: DataFrame | None = None) -> DataFrame:
    """(survey_year, language, user_count, total_respondents, adoption_pct).

    Denominator: respondents who answered the language question that year; numerator:
    distinct respondents naming the (non-blank) language."""
    base = clean.where(F.col("lang_worked").isNotNull()).select(YEAR, "response_id")
    if usage is not None:
        return adoption_rate(None, base, YEAR, "language", "response_id", dp=2, counts=distinct_counts(
            usage, [YEAR, "language"], "user_count", when=(F.col("kind") == "used") & non_blank("language")))
    long = lang_exploded.where(non_blank("language"))
    return adoption_rate(long, base, YEAR, "language", "response_id", dp=2)


def lang_trend(clean: DataFrame, lang_exploded: DataFrame, min_pct: float = 5.0,
               min_years: int = 3, usage: DataFrame | None = None) -> DataFrame:
    """Adoption per language and year with previous / next year's rate, the change and
    the rank within the year (over all languages); then only languages at or above
    ``min_pct`` in at least ``min_years`` distinct years are kept."""
    rates = language_rates(clean, lang_exploded, usage)
    trend = period_delta(rates, "language", YEAR, "adoption_pct", 2,
                         prev_name="prev_year_pct", delta_name="yoy_change_pp",
                         next_name="next_year_pct")
    # (year, language) is unique here, so "distinct years at or above min_pct" is a
    # conditional count over the language's rows: a window on the same partitioning as
    # LAG/LEAD instead of a second aggregation and a semi join.  The rank is taken over
    # all languages before the filter.
    strong_years = F.sum(F.when(F.col("adoption_pct") >= min_pct, 1).otherwise(0)).over(
        Window.partitionBy("language"))
    trend = rank_within(trend.withColumn("_strong_years", strong_years), YEAR, "adoption_pct", "rank_in_year")
    return (
        trend.where(F.col("_strong_years") >= min_years)
        .select(YEAR, "language", "user_count", "adoption_pct", "prev_year_pct",
                "yoy_change_pp", "next_year_pct", "rank_in_year")
        .orderBy("language", YEAR)
    )


def lang_endpoints(clean: DataFrame, lang_exploded: DataFrame, first: int = 2021,
                   last: int = 2025, floor: float = 3.0, usage: DataFrame | None = None) -> DataFrame:
    """Adoption in the first and last year side by side, for languages present in both
    with at least ``floor`` percent in either; change and direction."""
    rates = language_rates(clean, lang_exploded, usage)
    return endpoint_compare(rates, "language", YEAR, "adoption_pct", first, last, floor).orderBy(
        F.col("total_change_pp").desc())


def lang_desire_gap(clean: DataFrame, lang_exploded: DataFrame, min_mentions: int = 500,
                    usage: DataFrame | None = None) -> DataFrame:
    """Percent of respondents wanting vs using each language, the gap, and its rank per
    year; pairs with ``used + wanted <= min_mentions`` are dropped before ranking."""
    totals = clean.where(F.col("lang_worked").isNotNull()).groupBy(YEAR).agg(
        F.count(F.lit(1)).alias("total"))
    if usage is not None:
        used = distinct_counts(usage, [YEAR, "language"], "used_count", when=(F.col("kind") == "used") & non_blank("language"))
        wanted = distinct_counts(usage, [YEAR, "language"], "want_count", when=F.col("kind") == "wanted")
    else:
        used = lang_exploded.where(non_blank("language")).groupBy(YEAR, "language").agg(
            F.countDistinct("response_id").alias("used_count"))
        wanted = _wanted(clean).groupBy(YEAR, "language").agg(F.countDistinct("response_id").alias("want_count"))
    pct_use = percent("used_count", "total")
    pct_want = percent("want_count", "total")
    joined = (
        used.join(wanted, [YEAR, "language"])
        .join(F.broadcast(totals), YEAR)
        .where(F.col("used_count") + F.col("want_count") > min_mentions)
        .withColumn("_gap", pct_want - pct_use)
    )
    ranked = rank_within(joined, YEAR, "_gap", "desire_gap_rank")
    return ranked.select(
        YEAR, "language",
        F.round(pct_use, 1).alias("pct_use"),
        F.round(pct_want, 1).alias("pct_want"),
        F.round(F.col("_gap"), 1).alias("desire_gap_pp"),
        "desire_gap_rank",
    ).orderBy(YEAR, F.col("desire_gap_pp").desc())
