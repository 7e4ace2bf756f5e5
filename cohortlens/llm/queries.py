"""The corpus operators as queries over the given tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@functools.lru_cache(maxsize=1)
def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query("op5_minhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.near_duplicates import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, percent=80)


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.packing import pack_documents

    return digest_pieces(pack_documents(table(spark, sf_dir, "documents"), vocabulary()))


def digest_pieces(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op10_exact_topk", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.vector_search import exact_topk, quantised

    vectors = quantised(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return exact_topk(vectors, vectors.filter("id % 100 = 0"), k=10)


@query("op2_source_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.mixing import mix_digest, mix_sources

    return mix_digest(mix_sources(table(spark, sf_dir, "documents"), weights=(5, 2, 1), max_repeats=3))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
k(no, kind, re, grp, least) AS (VALUES
  (0, 'assign', '(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 20), (2, 'hex', '[0-9a-f]{24,}', 0, 24),
  (3, 'token', '[A-Za-z0-9+/_=-]{20,}', 0, 20)),
m AS (
  SELECT doc_id, source, no, kind, least, string_split_regex(text, re) AS gap,
         regexp_extract_all(text, re, 0) AS hit,
         CASE grp WHEN 2 THEN regexp_extract_all(text, re, 2) ELSE regexp_extract_all(text, re, 0) END AS val
  FROM d CROSS JOIN k
), u AS (
  SELECT doc_id, source, no, kind, least, unnest(generate_series(1, len(hit))) AS i, gap, hit, val FROM m
), s AS (
  SELECT doc_id, source, no, kind, least, val[i] AS v, CAST(len(hit[i]) AS BIGINT) AS n,
         CAST(sum(len(gap[i])) OVER w + coalesce(sum(len(hit[i])) OVER (PARTITION BY doc_id, no ORDER BY i
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS b
  FROM u WINDOW w AS (PARTITION BY doc_id, no ORDER BY i)
), base AS (SELECT * FROM s WHERE no < 3 AND len(v) >= least),
free AS (
  SELECT * FROM s WHERE no = 3 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
    AND NOT EXISTS (SELECT 1 FROM base x WHERE x.doc_id = s.doc_id AND x.b < s.b + s.n AND s.b < x.b + x.n)
), every AS (SELECT * FROM base UNION ALL SELECT * FROM free),
own AS (
  SELECT v, count(DISTINCT source) + max(CAST(source IS NULL AS INT)) <= 2
            AND count(DISTINCT doc_id) + max(CAST(doc_id IS NULL AS INT)) <= 8 AS live
  FROM every GROUP BY v
),
told AS (SELECT every.*, live FROM every JOIN own USING (v)),
f AS (
  SELECT doc_id, count(*) FILTER (no = 0) AS a, count(*) FILTER (no = 1) AS c, count(*) FILTER (no = 2) AS h,
         string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, no) FILTER (no < 3) AS t,
         string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, no) FILTER (no < 3 OR live) AS spans,
         count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example
  FROM told GROUP BY doc_id
)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(t, '')) AS base_sha256, coalesce(spans, '') AS spans,
       coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN f USING (doc_id)
"""


@query("op6_secret_scan", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.secrets import find_secrets, secret_digest

    return secret_digest(find_secrets(table(spark, sf_dir, "documents")))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), t AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d)
), c AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM t),
r AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words
  FROM c CROSS JOIN (VALUES (0), (1), (2)) AS o(j) WHERE n > 1 GROUP BY doc_id
), l AS (SELECT doc_id, unnest(lines) AS line FROM d),
f AS (
  SELECT doc_id, line, len(list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
         regexp_matches(line, '[^\x20\x09-\x0D]') AND (
           10 * len(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) > len(line)
           OR len(line) - len(replace(line, '!!', '')) >= 4
           OR (len(string_split(trim(line, ' '), ' ')) >= 5
               AND NOT regexp_matches(line, '[.!?:;…)"''”’»][\x20\x09-\x0D]*$'))
           OR len(string_split_regex(line, '\||»| > ')) >= 3
           OR regexp_matches(lower(line), 'all rights reserved|click here|cookie policy|enable javascript|licensed under|log in|privacy policy|released under|sign up|subscribe to|terms of service|terms of use')
         ) AS bad
  FROM l
), g AS (
  SELECT doc_id, sum(words) FILTER (bad) AS lost,
         count(*) FILTER (words > 0) - count(DISTINCT line) FILTER (words > 0) AS n_dup_lines
  FROM f GROUP BY doc_id
), x AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(len(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN r USING (doc_id) LEFT JOIN g USING (doc_id)
), y AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * lost <= 50 * n_words AS kept
FROM y
"""


@query("op7_quality_rules", OP7_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.quality_rules import clean_lines

    return clean_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op3_suffix_array_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.suffix_dedup import remove_repeats

    cut = remove_repeats(table(spark, sf_dir, "documents"), length=200, keep_first=False)
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.substring_dedup import remove_later_repeats

    cut = remove_later_repeats(table(spark, sf_dir, "documents"), window_words=20)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op1_toxicity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.toxicity import score_toxicity, train

    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))


@query("op9_weak_label_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.weak_quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, doc_id, list_transform(
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
    lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS t
  FROM documents
), s AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(t)) AS BIGINT) AS length FROM d WHERE len(t) > 0
), i AS (
  SELECT row_number() OVER () AS item, item_id, list_distinct(list_transform(
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'),
    lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS t
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
), q AS (SELECT item, unnest(t) AS term FROM i),
p AS (
  SELECT doc, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT doc, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY doc, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM p CROSS JOIN s GROUP BY term, docs
), m AS (SELECT doc, doc_id, 100 - 90 + ((90 * len(t) * docs) // length) AS m FROM d CROSS JOIN s WHERE len(t) > 0),
x AS (
  SELECT item, doc, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (doc) GROUP BY item, doc
), r AS (
  SELECT item, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank,
         doc_id, score
  FROM x JOIN m USING (doc) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM r JOIN i USING (item) WHERE rank <= 10
"""


@query("op12_lexical_search", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.lexical_search import rank_documents

    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, * FROM (
    SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
), s AS (
  SELECT a.r AS anchor, b.r AS other, a.id AS anchor_id, b.id, a.label = b.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id AND len(a.q) = len(b.q)
), p AS (
  SELECT anchor, anchor_id, id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, other) AS place
  FROM s WHERE same QUALIFY place <= 5
), n AS (
  SELECT p.*, s.id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor, place ORDER BY s.score DESC, s.id, other) AS INT) AS rank
  FROM p JOIN s USING (anchor)
  WHERE NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""


@query("op11_hard_negatives", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.hard_negatives import mine_hard_negatives, vectors_of

    vectors = vectors_of(table(spark, sf_dir, "embeddings"), "vec_id",
                         "CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END", "embedding", scale=256)
    return mine_hard_negatives(vectors, "id % 100 = 0", positives=5, negatives=5, lower=80, upper=100)


@query("op13_personal_data")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cohortlens.llm.personal_data import find_personal_data, personal_digest, train

    docs = table(spark, sf_dir, "documents")
    return personal_digest(find_personal_data(docs, train(docs)))
