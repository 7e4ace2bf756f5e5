"""Line-first quality rules.  Only DataFrame functions; one pass without a shuffle.

Each line is judged alone: punctuation (marks instead of words, shouting, prose that does not
end a sentence), navigation (items between separators) and boilerplate (stock phrases).
Failing lines go; a document that loses too many of its words with them is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.mixing import GAP_CHARS, words_of

SYMBOLS = "#*$%&|<>"
HAS_WORD = r"[^\x20\x09-\x0D]"
END_MARKS = r"""[.!?:;…)"'”’»][\x20\x09-\x0D]*$"""
BOILERPLATE = (
    "all rights reserved", "click here", "cookie policy", "enable javascript", "licensed under", "log in",
    "privacy policy", "released under", "sign up", "subscribe to", "terms of service", "terms of use")


def line_fails(line: Column) -> Column:
    """True where a line breaks a rule; lines without a word pass.

    punctuation: more than one symbol of ``#*$%&|<>`` in ten characters, or two or more
    ``!!``, or five words or more without an end mark; navigation: two or more separators
    ``|``, ``»`` or `` > ``; boilerplate: a stock phrase.
    """
    size = F.length(line)
    symbols = size - F.length(F.translate(line, SYMBOLS, ""))
    shouts = (size - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
    words = F.size(F.split(F.btrim(line), " "))
    parts = F.size(F.split(line, r"\||»| > ")) - 1
    stock = F.lower(line).rlike("|".join(BOILERPLATE))
    rules = (symbols * 10 > size) | (shouts >= 2) | ((words >= 5) & ~line.rlike(END_MARKS)) | (parts >= 2) | stock
    return line.rlike(HAS_WORD) & rules


def clean_lines(docs: DataFrame, max_lost_percent: int = 50) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, clean_text (the lines that pass),
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_failed_lines, lost_words,
    base_failed, kept.

    kept: not base_failed and at most ``max_lost_percent`` % of the words in failing lines.  A
    null text counts as empty: no words, base_failed.  Repeated rows are judged each; other
    columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    read = read.select("*", words_of(F.col("text")).alias("w"), F.split("text", "\n").alias("lines"))
    trigram = F.expr("""transform(sequence(0, size(w) - 3),
        i -> named_struct('h', xxhash64(w[i], w[i + 1], w[i + 2]), 'i', i))""")
    read = read.select(
        "*", F.when(F.size("w") >= 3, F.sort_array(trigram)).alias("t"),
        F.filter("lines", lambda x: x.rlike(HAS_WORD)).alias("full"),
        F.filter("lines", lambda x: ~line_fails(x)).alias("good"))
    again = F.expr("""sort_array(transform(filter(t, (x, j) ->
        coalesce(get(t, j - 1).h = x.h, false) or coalesce(get(t, j + 1).h = x.h, false)), x -> x.i))""")
    read = read.select("*", again.alias("p"), F.array_join("good", "\n").alias("clean_text"))
    repeat = F.expr("""aggregate(transform(p, (x, j) -> least(3, coalesce(get(p, j + 1) - x, 3))), 0, (a, x) -> a + x)""")
    n = F.col("n_words")
    counted = read.select(
        "doc_id", "clean_text", F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("text", GAP_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        F.coalesce(repeat, F.lit(0)).cast("long").alias("n_repeat_words"),
        (F.size("lines") - F.size("good")).cast("long").alias("n_failed_lines"),
        (F.size("w") - F.size(words_of(F.col("clean_text")))).cast("long").alias("lost_words"))
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    return counted.select("*", failed.alias("base_failed"), (~failed & (
        100 * F.col("lost_words") <= max_lost_percent * n)).alias("kept"))
