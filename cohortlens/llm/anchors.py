"""Repeated windows of a corpus found through winnowed anchors (shared by the two removers).

A document is a run of units, bytes or words.  Each window of ``length`` units chooses the
k-gram with the smallest hash in it (leftmost of equals) as its anchor, so equal windows
choose the same anchor at the same distance.  An anchor's windows start in one run; the span
of the run is all text these windows touch.

Only anchors that occur twice or more go on.  Equal spans (same anchor, same content) form a
class, counted with map-side aggregation: every window of a class of two or more is repeated.
Classes that share an anchor with other classes send one representative span to a
comparison, grouped by anchor; anchors with very many classes compare window hashes by a
grouped count instead, so no group outgrows a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textops as T
from cohortlens.llm.shipping import arrow_groups, arrow_map
from cohortlens.llm.staging import staged

_U = np.uint64
_MASK = (1 << 20) - 1
SEGMENT = 1 << 19
BATCH_ROWS, GROUP_ROWS = 1024, 1 << 14
NO_ID = -(1 << 63)
_X = 0xD1342543DE82EF95
_BYTES = T.stream(11, 256)
_table: tuple[np.ndarray, np.ndarray] | None = None


def _powers() -> tuple[np.ndarray, np.ndarray]:
    global _table
    if _table is None:
        n = (1 << 20) + 4096
        _table = tuple(np.multiply.accumulate(np.r_[_U(1), np.full(n, x, _U)])
                       for x in (_X, pow(_X, -1, 1 << 64)))
    return _table


def _values(texts: list[bytes], unit: str) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each unit of the texts laid end to end, and where each text begins."""
    if unit == "byte":
        return (_BYTES[np.frombuffer(b"".join(texts), np.uint8)],
                np.r_[0, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    words = T.Words(texts)
    return words.hashes(), words.first


def _grams(v: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k units, k a power of two, by doubling."""
    step, c = 1, T.stream(13, 8) | _U(1)
    while step < k:
        v = v[:-step] * c[0] + v[step:] * c[1]
        v ^= v >> _U(31)
        step *= 2
    return T.mix64(v)


def _sums(v: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash for each range [start, end) of units, the same wherever the range stands."""
    power, inverse = _powers()
    total = np.r_[_U(0), np.cumsum(v * power[:len(v)])]
    return (total[end] - total[start]) * inverse[start]


def winnowed(v: np.ndarray, first: np.ndarray, length: int, k: int):
    """(text, place of the anchor, first and last window start in the text, anchor hash, span
    hash) of each run of windows with one anchor.  At most 2**20 units."""
    g = _grams(v, k) if len(v) >= length else v[:0]
    if len(v) < length:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, _U),) * 2
    low = T.window_min((g & ~_U(_MASK)) | np.arange(len(g), dtype=_U), length - k + 1)
    q = (low & _U(_MASK)).astype(np.int64)
    p = np.arange(len(q))
    text = np.searchsorted(first, p, "right") - 1
    whole = p + length <= first[text + 1]
    p, q, text = p[whole], q[whole], text[whole]
    new = np.r_[True, q[1:] != q[:-1]][:len(q)]
    last = np.r_[new[1:], True][:len(q)]
    s, e, q, text = p[new], p[last], q[new], text[new]
    span = T.mix64(_sums(v, s, e + length) + ((q - s) * 1024 + (e - s)).astype(_U) * _U(_X))
    return text, q - first[text], s - first[text], e - first[text], g[q], span


def _scan(texts: list[bytes], unit: str, length: int, k: int):
    """``winnowed`` over any texts, long ones in overlapping segments."""
    for i, j in T.chunks(texts, SEGMENT):
        v, first = _values(texts[i:j], unit)
        if len(v) <= _MASK:
            text, *found = winnowed(v, first, length, k)
            yield text + i, *found
            continue
        for o in range(0, len(v), SEGMENT):  # a single long text
            part = v[o:o + SEGMENT + length - 1]
            text, q, s, e, h, c = winnowed(part, np.array([0, len(part)]), length, k)
            yield text + i, q + o, s + o, e + o, h, c


def _int(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.int64) if x.dtype != _U else x.view(np.int64))


def _anchors(docs: DataFrame, unit: str, length: int, k: int, hashes_only: bool) -> DataFrame:
    """(h, c, id, at): an anchor's hash, its span's hash, and where it is: the anchor's place and
    the distances back to the first window start and from there to the last, in one number."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for text, q, s, e, h, c in _scan(T.utf8(batch.column(1)), unit, length, k):
                if hashes_only:
                    yield pa.RecordBatch.from_arrays([_int(h)], names=["h"])
                else:
                    at = (q << 20) | ((q - s) << 10) | (e - s)
                    yield pa.RecordBatch.from_arrays([_int(h), _int(c), _int(ids[text]), _int(at)],
                                                     names=["h", "c", "id", "at"])
    return arrow_map(docs, run, "h long" if hashes_only else "h long, c long, id long, at long")


def _squeezed(docs: DataFrame) -> DataFrame:
    """(id, z): the texts compressed, for shuffles by id."""
    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = T.utf8(batch.column(1))
            for i, j in T.chunks(texts, 8 << 20):
                z = pa.array([press.compress(t) for t in texts[i:j]], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), z], names=["id", "z"])
    return arrow_map(docs, run, "id long, z binary")


def _spans(held: DataFrame, unit: str, length: int) -> DataFrame:
    """(h, n, id, first, runs, span): the bytes of the listed spans.  ``held``: id, z, list."""
    def run(batches):
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for r in range(batch.num_rows):
                text = tool.decompress(batch.column(1)[r].as_py())
                rows = batch.column(2)[r].values
                h, n, at = (np.asarray(rows.field(c)) for c in range(3))
                q = at >> 20
                s = q - ((at >> 10) & 1023)
                runs = (at & 1023) + 1
                if unit == "byte":
                    a, b = s, s + runs - 1 + length
                else:
                    words = T.Words([text])
                    a, b = words.start[s], words.end[s + runs + length - 2]
                own = np.full(len(h), batch.column(0)[r].as_py())
                yield pa.RecordBatch.from_arrays(
                    [_int(h), _int(n), _int(own), _int(s), _int(runs), pa.array(
                        [text[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)], pa.binary())],
                    names=["h", "n", "id", "first", "runs", "span"])
    return arrow_map(held.select("id", "z", "list"), run, "h long, n long, id long, first long, runs long, span binary")


class Windows:
    """All windows of the spans of a table, in text order: ``member`` (row), ``step`` (in the span)
    and ``start`` (in the document).  They are many to a span, so those of a few are found by ``of``."""

    def __init__(self, group: pa.Table):
        col = {c: group.column(c).to_numpy() for c in ("n", "id", "first", "runs")}
        order = np.lexsort((col["first"], col["id"]))
        self.n, self.id, self.first, self.runs = (col[c][order] for c in ("n", "id", "first", "runs"))
        spans = group.column("span").to_pylist()
        self.spans = [spans[i] for i in order]
        self.past = np.cumsum(self.runs)
        self.count = int(self.past[-1]) if len(self.past) else 0

    def of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(member, step) of the windows numbered ``at``."""
        member = np.searchsorted(self.past, at, "right")
        return member, at - (self.past - self.runs)[member]

    @property
    def member(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.runs)), self.runs)

    @property
    def start(self) -> np.ndarray:
        return np.repeat(self.first, self.runs) + T.repeated_arange(self.runs)

    def intervals(self, flagged: np.ndarray, length: int) -> pa.RecordBatch:
        """Runs of flagged windows as unit ranges (id, first, past)."""
        member, step = self.of(np.flatnonzero(flagged))
        start = self.first[member] + step
        new = np.r_[True, (member[1:] != member[:-1]) | (start[1:] != start[:-1] + 1)][:len(start)]
        last = np.r_[new[1:], True][:len(start)]
        return pa.RecordBatch.from_arrays(
            [_int(self.id[member[new]]), _int(start[new]), _int(start[last] + length)], names=["id", "first", "past"])

    def hashes(self, unit: str, length: int, lanes: int = 2) -> np.ndarray:
        """128-bit hash of each window in two lanes, or the first lane only."""
        found = np.zeros((lanes, self.count), _U)
        for i, j in T.chunks(self.spans, SEGMENT):
            a, b = (int(self.past[x - 1]) if x else 0 for x in (i, j))
            member, step = self.of(np.arange(a, b))
            v, first = _values(self.spans[i:j], unit)
            place = first[member - i] + step
            for lane in range(lanes):
                found[lane, a:b] = T.mix64(_sums(T.mix64(v ^ _U(_X)) if lane else v, place, place + length))
        return found


def numbered(docs: DataFrame, *also) -> tuple[DataFrame, DataFrame | None]:
    """(id, text and the columns ``also``) of ``docs``, where equal ids mean equal texts, and
    (id, doc_id) or None.

    id is doc_id where all are present and differ.  Otherwise the distinct documents are
    numbered in the order of doc_id (null first) and a hash of the text.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *also)
    rest = read.columns[1:]
    odd = read.groupBy("doc_id").count().filter("doc_id is null or count > 1")
    if not odd.take(1):
        return read.select(F.col("doc_id").alias("id"), *rest), None
    key = read.withColumn("key", F.xxhash64(F.coalesce("text", F.lit("")))).withColumn(
        "known", F.coalesce("doc_id", F.lit(NO_ID)))
    names = staged(key.select("doc_id", "known", "key").distinct().orderBy("known", "key").withColumn(
        "id", F.monotonically_increasing_id()), "numbers")
    return key.join(names.select("known", "key", "id"), ["known", "key"]).select("id", *rest), names.select("id", "doc_id")


def renamed(out: DataFrame, names: DataFrame | None) -> DataFrame:
    """``out`` with doc_id for id."""
    if names is None:
        return out.withColumnRenamed("id", "doc_id")
    return out.join(names, "id").select("doc_id", *[c for c in out.columns if c != "id"])


def repeated_ranges(docs: DataFrame, unit: str, length: int, k: int, later_only: bool, compare,
                    differ: bool) -> DataFrame:
    """(id, first, past): unit ranges made of windows that also start elsewhere in ``docs`` (id,
    text), or with ``later_only`` that also start earlier (by id, then place).  ``differ``: no
    id is in two rows.

    ``compare(table) -> batches of (id, first, past)`` flags windows among spans of whole anchor
    groups.
    """
    # tables of their own, so that the joins below read two shuffles and hot anchors can be split
    often = staged(_anchors(docs, unit, length, k, True).groupBy("h").count().filter("count > 1").select("h"), "often")
    found = staged(_anchors(docs, unit, length, k, False).join(often, "h", "left_semi"), "anchors")
    classes = staged(found.groupBy("h", "c").agg(
        F.count("*").alias("n"), F.min(F.struct("id", "at")).alias("rep")), "classes")
    groups = staged(classes.groupBy("h").agg(F.count("*").alias("classes")).filter("classes > 1"), "groups")

    from_ = "(at >> 20) - ((at >> 10) & 1023)"
    full = found.join(classes.filter("n > 1"), ["h", "c"])
    if later_only:
        full = full.filter("id <> rep.id or at <> rep.at")
    full = full.selectExpr("id", f"{from_} as first", f"{from_} + (at & 1023) + {length} as past")

    sent = classes.join(groups, "h").select(F.col("rep.id").alias("id"), F.struct(
        "h", "n", F.col("rep.at").alias("at"), "classes").alias("item"))
    lists = sent.groupBy("id").agg(F.collect_list("item").alias("list"))
    texts = _squeezed(docs)
    if not differ:  # a repeated row would send its spans again, as if they stood there twice
        texts = texts.dropDuplicates(["id"])
    spans = staged(_spans(texts.join(lists, "id"), unit, length), "spans")
    big = groups.filter(F.col("classes") > GROUP_ROWS).select("h")
    small = spans.join(big, "h", "left_anti")
    partly = arrow_groups(small, ["h"], compare, "id long, first long, past long", batch_rows=BATCH_ROWS)

    def hashed(batches):
        for batch in batches:
            for o in range(0, batch.num_rows, BATCH_ROWS):
                w = Windows(pa.Table.from_batches([batch.slice(o, BATCH_ROWS)]))
                a, b = w.hashes(unit, length)
                yield pa.RecordBatch.from_arrays(
                    [_int(a), _int(b), _int(w.id[w.member]), _int(w.start)], names=["w1", "w2", "id", "first"])

    rows = arrow_map(spans.join(big, "h", "left_semi"), hashed, "w1 long, w2 long, id long, first long")
    seen = rows.groupBy("w1", "w2").agg(F.count("*").alias("n"), F.min(F.struct("id", "first")).alias("rep"))
    hot = rows.join(seen.filter("n > 1"), ["w1", "w2"])
    if later_only:
        hot = hot.filter("id <> rep.id or first <> rep.first")
    return full.union(partly).union(hot.selectExpr("id", "first", f"first + {length} as past"))


def removed(docs: DataFrame, ranges: DataFrame, cut, schema: str) -> DataFrame:
    """``cut(ids, texts, ranges of each text, merged and sorted) -> batch`` over all of ``docs``."""

    lists = ranges.distinct().groupBy("id").agg(F.collect_list(F.struct("first", "past")).alias("list"))

    def run(batches):
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for i, j in _even(batch.column(1)):
                part = batch.slice(i, j - i)
                texts = [tool.decompress(z) for z in part.column(1).to_pylist()]
                merged = []
                for r in range(part.num_rows):
                    cell = part.column(2)[r]
                    if not cell.is_valid:
                        merged.append((np.zeros(0, np.int64),) * 2)
                        continue
                    a, b = (np.asarray(cell.values.field(c)) for c in (0, 1))
                    order = np.argsort(a)
                    a, b = a[order], np.maximum.accumulate(b[order])
                    new = np.r_[True, a[1:] > b[:-1]]
                    merged.append((a[new], b[np.r_[new[1:], True]]))
                yield cut(part.column(0), texts, merged)

    return arrow_map(_squeezed(docs).join(lists, "id", "left").select("id", "z", "list"), run, schema)


def _even(z: pa.Array):
    """Slices of a batch whose texts are a few MB together."""
    return T.chunks([memoryview(x.as_buffer()) for x in z], 1 << 20)
