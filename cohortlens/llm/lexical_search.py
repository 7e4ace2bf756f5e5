"""Exact ranked lexical search as dense blocked matrix products.

Terms are maximal runs of ASCII letters and digits and of all code points past ASCII, A-Z
lower-cased.  Items come in groups of bounded size; a group's distinct terms are its vocabulary.

1. one pass over the documents counts, per document, all terms and the occurrences of vocabulary
   terms; these postings are a table in the shared folder;
2. document frequencies, the number of documents and their total length are grouped sums over it;
3. a task lays its postings out in tiles: vocabulary terms of one tile of items (only those that
   occur) by documents, each entry a term's whole-number impact in a document.  An item tile's
   weights times that tile, in float64, are the scores.  Vocabulary columns are cut so that each
   product's sum stays under 2^53, where float64 is exact on whole numbers; cuts add in 64-bit
   integers;
4. per item the k best of each tile stay, all rows tied with the k-th included, and the task's k
   best meet in a grouped rank.

Only a group of items, its vocabulary and its document frequencies reach the driver (bounded by
``group_terms``, or by one item where that alone has more terms).  Terms are told apart by 64 bits
of hash.  A benchmark beyond one group costs one pass over the documents for each further group.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as S

from cohortlens.llm import textops as T
from cohortlens.llm.shipping import arrow_map
from cohortlens.llm.staging import staged

GROUP_TERMS = 1 << 20
ITEM_TILE, DOC_TILE = 64, 512
SALTS = 64
_EXACT = 1 << 53  # columns are cut at half of it, so a cut and one more column stay below
_TOP = 1_000_000  # no impact is larger

_FOLD = bytes(b if b > 127 or chr(b).isdigit() or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 32
              for b in range(256))


def folded(texts: list[bytes]) -> T.Words:
    """The terms of UTF-8 texts, as words of their folded bytes."""
    return T.Words([t.translate(_FOLD) for t in texts])


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values))


def _item_terms(batches):
    for batch in batches:
        texts = T.utf8(batch.column(1))
        for i, j in T.chunks(texts):
            words = folded(texts[i:j])
            h = words.hashes()
            sets = [np.unique(h[a:b]) for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
            flat = np.concatenate(sets) if sets else h
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, j - i), _lists(flat.view(np.int64), np.fromiter(map(len, sets), np.int64))],
                ["item_id", "terms"])


def _postings(vocabulary: np.ndarray):
    """A row per document with a term: its number of terms, and vocabulary terms with occurrences."""
    def run(batches):
        size = len(vocabulary)
        for batch in batches:
            texts = T.utf8(batch.column(1))
            for i, j in T.chunks(texts):
                words = folded(texts[i:j])
                n = np.diff(words.first)
                h = words.hashes()
                at = np.minimum(np.searchsorted(vocabulary, h), size - 1)
                hit = np.flatnonzero(vocabulary[at] == h)
                doc = np.searchsorted(words.first, hit, side="right") - 1
                key, tf = np.unique(doc * size + at[hit], return_counts=True)
                held = np.flatnonzero(n)
                counts = np.bincount(key // size, minlength=len(n))[held]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(pa.array(held)), pa.array(n[held].astype(np.int64)),
                     _lists((key % size).astype(np.int32), counts), _lists(tf.astype(np.int64), counts)],
                    ["doc_id", "n", "terms", "tfs"])
    return run


class _Tile:
    """Up to ITEM_TILE items: the terms they hold and a weight for each item and term."""

    def __init__(self, items: list[np.ndarray], first: int, weight: np.ndarray):
        self.first, self.size = first, len(items)
        self.terms = np.unique(np.concatenate(items))
        self.terms = self.terms[weight[self.terms] > 0]
        column = np.full(len(weight), -1)
        column[self.terms] = np.arange(len(self.terms))
        self.weights = np.zeros((len(items), len(self.terms)))
        for i, t in enumerate(items):
            c = column[t]
            self.weights[i, c[c >= 0]] = weight[t[c >= 0]]

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, docs: int) -> np.ndarray:
        """Whole scores (items, documents) from postings of one document tile."""
        out = np.zeros((self.size, docs), np.int64)
        if not len(self.terms):
            return out
        at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
        own = self.terms[at] == term
        used, row = np.unique(at[own], return_inverse=True)
        tile = np.zeros((len(used), docs))
        tile[row, doc[own]] = impact[own]
        weights = self.weights[:, used]
        cut = np.cumsum(weights.max(0, initial=0)) * _TOP // (_EXACT // 2)
        for c in np.unique(cut):
            part = cut == c if cut[-1] else slice(None)
            out += (weights[:, part] @ tile[part]).astype(np.int64)
        return out


def _impacts(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """(1000000000 tf) div (1000 tf + 8 m), m = 10 + (90 n docs) div terms, whole at any size."""
    if n.max(initial=0) * 90 * docs < 1 << 62 and tf.max(initial=0) < 1 << 32:
        return 10**9 * tf // (1000 * tf + 8 * (10 + 90 * docs * n // terms))
    return np.array([10**9 * t // (1000 * t + 8 * (10 + 90 * docs * k // terms))
                     for t, k in zip(tf.tolist(), n.tolist(), strict=True)], np.int64)


class _Best:
    """The k best rows of each item so far: score down, then id up, null ids last."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.rows = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]

    def add(self, first: int, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        least = self.least[first:first + len(score)]
        if score.shape[1] > self.k:
            kth = np.partition(score, score.shape[1] - self.k, axis=1)[:, score.shape[1] - self.k]
            np.maximum(least, kth, out=least)
        item, doc = np.nonzero(score >= least[:, None])
        if len(item):
            new = item + first, score[item, doc], ids[doc], null[doc]
            self.rows = self._cut([np.concatenate(x) for x in zip(self.rows, new, strict=True)])

    def _cut(self, rows: list[np.ndarray]) -> list[np.ndarray]:
        item, score, ids, null = rows
        order = np.lexsort((ids, null, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        full = place == self.k - 1
        self.least[item[full]] = np.maximum(self.least[item[full]], score[order][full])
        return [x[order][place < self.k] for x in rows]


def _score(items: list[np.ndarray], weight: np.ndarray, docs: int, terms: int, k: int):
    """Postings to (item, doc_id, score): each task's k best of each item."""
    def run(batches):
        tiles = [_Tile(items[i:i + ITEM_TILE], i, weight) for i in range(0, len(items), ITEM_TILE)]
        best, kind = _Best(len(items), k), None
        for batch in batches:
            kind = batch.column(0).type
            for i in range(0, batch.num_rows, DOC_TILE):
                part = batch.slice(i, DOC_TILE)
                ids = part.column(0)
                null = np.asarray(ids.is_null())
                n = part.column(1).to_numpy()
                counts = np.asarray(part.column(2).value_lengths())
                doc = np.repeat(np.arange(len(n)), counts)
                term, tf = (part.column(c).flatten().to_numpy() for c in (2, 3))
                impact = _impacts(tf, n[doc], docs, terms)
                for tile in tiles:
                    best.add(tile.first, tile.scores(doc, term, impact, len(n)), ids.fill_null(0).to_numpy(), null)
        if kind is not None:
            item, score, ids, null = best.rows
            yield pa.RecordBatch.from_arrays([pa.array(item), pa.array(ids, kind, mask=null), pa.array(score)],
                                             ["item", "doc_id", "score"])
    return run


def _ranked(found: DataFrame, k: int, by: list) -> DataFrame:
    return found.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(
        F.col("score").desc(), F.col("doc_id").asc_nulls_last()))).filter(F.col("rank") <= k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, group_terms: int = GROUP_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): for each row of ``items`` (item_id, text) the ``k`` rows of
    ``docs`` (doc_id, text) with the highest score above 0, ties to the smaller doc_id.

    Null and empty texts have no terms: such items return no rows, such documents do not count.
    Every row of ``docs`` is a document, also where ids repeat; null ids rank last among ties.
    Items repeated exactly count once, other items of one id are ranked each on their own.  Texts of
    any length are read whole.  An empty side gives no rows.  Other columns are ignored.
    """
    spark = docs.sparkSession
    id_kind, item_kind = docs.schema["doc_id"].dataType, items.schema["item_id"].dataType
    read = arrow_map(items.select("item_id", "text").distinct(), _item_terms, S.StructType(
        [S.StructField("item_id", item_kind), S.StructField("terms", S.ArrayType(S.LongType()))]))
    wanted = staged(read.filter(F.size("terms") > 0), "items")
    total = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = max(1, -(-total // group_terms))
    parts = [_group(docs, wanted.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(groups)) == g), k, id_kind)
             for g in range(groups if total else 0)]
    if not parts:
        return spark.createDataFrame([], S.StructType([
            S.StructField("item_id", item_kind), S.StructField("rank", S.IntegerType()),
            S.StructField("doc_id", id_kind), S.StructField("score", S.LongType())]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _group(docs: DataFrame, wanted: DataFrame, k: int, id_kind: S.DataType) -> DataFrame:
    spark = docs.sparkSession
    rows = wanted.orderBy("item_id", "terms").collect()  # group_terms bounds it
    hashes = [np.array(r["terms"], np.int64).view(np.uint64) for r in rows]
    vocabulary = np.unique(np.concatenate([*hashes, np.zeros(1, np.uint64)]))
    items = [np.searchsorted(vocabulary, h) for h in hashes]
    postings = staged(arrow_map(docs.select("doc_id", "text"), _postings(vocabulary), S.StructType([
        S.StructField("doc_id", id_kind), S.StructField("n", S.LongType()),
        S.StructField("terms", S.ArrayType(S.IntegerType())), S.StructField("tfs", S.ArrayType(S.LongType()))])), "postings")
    n, length = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
    weight = np.zeros(len(vocabulary), np.int64)
    for r in postings.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        weight[r["t"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1)))
    found = arrow_map(postings, _score(items, weight, n, length or 1, k), S.StructType([
        S.StructField("item", S.LongType()), S.StructField("doc_id", id_kind), S.StructField("score", S.LongType())]))
    few = _ranked(found, k, ["item", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))]).drop("rank")
    names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], S.StructType(
        [S.StructField("item", S.LongType()), S.StructField("item_id", wanted.schema["item_id"].dataType)]))
    return _ranked(few, k, ["item"]).join(F.broadcast(names), "item").select(
        "item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
