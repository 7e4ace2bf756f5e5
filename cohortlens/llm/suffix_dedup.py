"""Suffix-array removal of repeated byte strings, with longest-previous-factor arrays.

The corpus's suffix array is never in one place.  Suffixes are dealt by the winnowed anchor
of their first ``length`` bytes, so suffixes with that prefix in common meet in one group;
each group orders its suffixes by content (to ``length`` bytes, ties in text order) and
takes the longest previous factor of each from its neighbours: the previous and the next
suffix in that order with a smaller text position.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlens.llm.anchors import Windows, numbered, removed, renamed, repeated_ranges

GRAM = 16
PART = 1 << 16


def longest_previous_factor(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each text position the longest match with an earlier position.

    ``order``: text positions in suffix order; ``lcp[i]``: common prefix of order[i-1] and
    order[i].  The best earlier match of a suffix is the previous or the next smaller
    position in suffix order, and its length the least lcp on the way there.  All links jump
    together over larger positions until none is left to jump; one whose match is empty stays.
    """
    def towards(order, lcp):
        link, least = np.arange(len(order)) - 1, lcp.copy()
        while len(jump := np.flatnonzero((link >= 0) & (least > 0) & (order[link] > order))):
            over = link[jump]
            least[jump] = np.minimum(least[jump], least[over])
            link[jump] = link[over]
        return np.where(link >= 0, least, 0)

    lpf = np.zeros(len(order), np.int64)
    if len(order):
        before = towards(order, lcp)
        after = towards(order[::-1], np.r_[0, lcp[:0:-1]])[::-1]
        lpf[order] = np.maximum(before, after)
    return lpf


def _compare(length: int, later_only: bool):
    def run(group: pa.Table) -> list[pa.RecordBatch]:
        w = Windows(group)
        size = np.fromiter(map(len, w.spans), np.int64, len(w.spans))
        text = b"".join(w.spans)
        from_ = np.cumsum(size) - size
        suffixes = np.ndarray((len(text) - length + 1,), f"S{length}", text, strides=(1,))
        flag = np.zeros(w.count, bool)
        for part in _shared_prefixes(w.hashes("byte", length, 1)[0]):
            member, step = w.of(part)
            suffix = suffixes[from_[member] + step]
            order = np.argsort(suffix, kind="stable")
            suffix = suffix[order]
            lcp = np.r_[0, np.where(suffix[1:] == suffix[:-1], length, 0)]  # as far as it matters
            hit = longest_previous_factor(order, lcp) >= length
            if not later_only:
                last = len(order) - 1
                hit |= longest_previous_factor(last - order, lcp)[::-1] >= length
            flag[part] = hit if later_only else hit & (w.n[member] == 1)  # the others' windows are known to be repeated
        return [w.intervals(flag, length)]
    return run


def _shared_prefixes(key: np.ndarray):
    """Suffixes whose first bytes (hashed: ``key``) occur again, in text order, in parts of about
    ``PART`` that keep equal keys together; other suffixes have no match of that length."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    again = np.r_[False, same] | np.r_[same, False] if len(key) else same
    order, ranked = order[again], ranked[again]
    del key, same, again
    at = 0
    while at < len(order):
        end = min(at + PART, len(order))
        end = int(np.searchsorted(ranked, ranked[end - 1], "right"))
        yield np.sort(order[at:end])
        at = end


def remove_repeats(docs: DataFrame, length: int = 200, keep_first: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, spans (array of
    first, past in bytes: the maximal removed runs) and kept (the remaining bytes).

    Removed is every byte covered by a string of ``length`` bytes that also starts earlier
    (smaller doc_id, or same document and earlier place); with ``keep_first=False``, that also
    starts anywhere else.  Strings are judged on the input; matches do not cross documents.
    A null text counts as empty.  Rows with a null doc_id come before all others.  Equal
    rows are one document, and copies of one another for ``keep_first=False``; rows that share
    a doc_id with different texts are documents of their own.  Other columns are ignored; an empty table gives no rows.
    """
    if not GRAM <= length < 512:
        raise ValueError(f"length must be from {GRAM} to 511")
    read, names = numbered(docs)
    ranges = repeated_ranges(read, "byte", length, GRAM, keep_first, _compare(length, keep_first), names is None)

    def cut(ids, texts, merged):
        kept, spans, gone = [], [], []
        for t, (a, b) in zip(texts, merged, strict=True):
            b = np.minimum(b, len(t))
            edges = [0, *np.c_[a, b].ravel().tolist(), len(t)]
            kept.append(b"".join(t[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)))
            spans.append([{"first": x, "past": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            gone.append(len(t) - len(kept[-1]))
        kind = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([len(t) for t in texts], pa.int64()), pa.array(gone, pa.int64()),
             pa.array(spans, kind), pa.array(kept, pa.binary())],
            names=["id", "n_bytes", "n_removed", "spans", "kept"])

    out = removed(read, ranges, cut, "id long, n_bytes long, n_removed long, "
                  "spans array<struct<first:long,past:long>>, kept binary")
    return renamed(out, names)
