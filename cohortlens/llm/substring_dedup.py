"""Substring deduplication by seed and extend.

Documents are joined on winnowed anchors of four words (the seeds).  Around a shared anchor a
match extends to the left and to the right; all ways to place a window of ``window_words``
on an anchor (so many words before it, the rest after) are tried at once by hashing, and
neighbouring matched windows run together into the maximal repeats.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cohortlens.llm.anchors import Windows, numbered, removed, renamed, repeated_ranges

SEED_WORDS = 4


def _extend(length: int):
    def run(group: pa.Table) -> list[pa.RecordBatch]:
        w = Windows(group)
        a, b = w.hashes("word", length)
        order = np.lexsort((np.arange(len(a)), b, a))
        same = np.r_[False, (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])][:len(order)]
        later = np.zeros(len(order), bool)
        later[order] = same  # equal windows are in text order
        return [w.intervals(later, length)]
    return run


def remove_later_repeats(docs: DataFrame, window_words: int = 20) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed, spans (array of
    first, past in words: the maximal repeats removed) and kept (the kept words joined by one
    space).

    Removed is every word covered by ``window_words`` consecutive words that also start earlier
    (smaller doc_id, or same document and earlier place), judged on the input.  Windows do not
    cross documents.  Null and word-free texts have no words.  Rows with a null doc_id come
    before all others.  Equal rows are one document and are cut alike;
    rows that share a doc_id with different texts are documents of their own.  Other
    columns are ignored; an empty table gives no rows.
    """
    if not SEED_WORDS <= window_words < 512:
        raise ValueError(f"window_words must be from {SEED_WORDS} to 511")
    read, names = numbered(docs)
    ranges = repeated_ranges(read, "word", window_words, SEED_WORDS, True, _extend(window_words), names is None)

    def cut(ids, texts, merged):
        kept, spans, gone, total = [], [], [], []
        for t, (a, b) in zip(texts, merged, strict=True):
            words = t.split()
            b = np.minimum(b, len(words))
            edges = [0, *np.c_[a, b].ravel().tolist(), len(words)]
            rest = [x for i, j in zip(edges[::2], edges[1::2], strict=True) for x in words[i:j]]
            kept.append(b" ".join(rest).decode())
            spans.append([{"first": x, "past": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            gone.append(len(words) - len(rest))
            total.append(len(words))
        kind = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, kind),
             pa.array(kept, pa.string())], names=["id", "n_words", "n_removed", "spans", "kept"])

    out = removed(read, ranges, cut, "id long, n_words long, n_removed long, "
                  "spans array<struct<first:long,past:long>>, kept string")
    return renamed(out, names)
