"""Packing by power-of-two decomposition.

Each document's token ids (with an end id) are cut into pieces whose lengths are powers of
two, at most ``max_length``: first as many full pieces as fit, then one piece for each bit
of the rest, longest first.  A piece is a sequence of its own and its length is its bucket,
so a batch takes sequences of one bucket, no sequence crosses documents and nothing is padded.
The work is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import base64
import functools
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textops as T
from cohortlens.llm.shipping import arrow_map

END_ID = 1
#: Texts of these characters only are split alike by both tokenizer libraries.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ]*")


@functools.lru_cache(maxsize=2)
def _encoder(vocabulary: str):
    """text -> ids of the byte-level BPE in ``vocabulary`` (a tokenizers file).

    Where the rank file of the same vocabulary lies beside it, plain texts go through that
    (the same ids, five times as fast); all other texts go through ``tokenizers``.
    """
    import os

    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(vocabulary)
    ranks = os.path.splitext(vocabulary)[0] + ".tiktoken"
    if not os.path.exists(ranks):
        return lambda text: slow.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(text: str) -> list[int]:
        if "<|" not in text and _PLAIN.fullmatch(text):
            return fast.encode_ordinary(text)
        return slow.encode(text, add_special_tokens=False).ids

    return encode


def piece_lengths(n: int, max_length: int) -> list[int]:
    """Powers of two, longest first, that add up to n; none above ``max_length``."""
    rest = n % max_length
    return [max_length] * (n // max_length) + [
        1 << b for b in range(max_length.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack_documents(docs: DataFrame, vocabulary: str, max_length: int = 2048, end_id: int = END_ID) -> DataFrame:
    """One row per piece of ``docs`` (doc_id, text): doc_id, start, length, doc_tokens, bucket
    (its length), sequence_id, offset (0: a piece fills its sequence) and ids (binary,
    little-endian unsigned 32-bit).

    A null or empty text has the end id alone.  Rows with a null doc_id are packed like
    others; repeated rows are packed each.  Other columns are ignored; an empty table gives no
    rows.  ``max_length`` is a power of two.  sequence_id follows the input's partitions, so it
    is the same on every run over the same files.
    """
    if max_length < 1 or max_length & (max_length - 1):
        raise ValueError("max_length must be a power of two")

    def run(batches):
        encode = _encoder(vocabulary)

        def made(rows, parts):
            of = np.repeat(np.array([r[1] for r in rows], np.int64), [len(r[2]) for r in rows])
            length = np.array([x for r in rows for x in r[2]], np.int64)
            start = np.concatenate([np.cumsum([0, *r[2][:-1]]) for r in rows])
            ids = pa.concat_arrays([pa.array([b[4 * s:4 * (s + n)] for s, n in zip(
                np.cumsum([0, *r[2][:-1]]).tolist(), r[2], strict=True)], pa.binary())
                for r, b in zip(rows, parts, strict=True)])
            doc = pa.array([r[0] for r in rows for _ in r[2]], pa.int64())
            return pa.RecordBatch.from_arrays(
                [doc, pa.array(start), pa.array(length), pa.array(of), ids],
                names=["doc_id", "start", "length", "doc_tokens", "ids"])

        for batch in batches:
            rows, parts, size = [], [], 0
            for doc_id, raw in zip(batch.column(0).to_pylist(), T.utf8(batch.column(1)), strict=True):
                ids = np.array([*encode(raw.decode()), end_id], "<u4")
                rows.append((doc_id, len(ids), piece_lengths(len(ids), max_length)))
                parts.append(ids.tobytes())
                size += len(ids)
                if size > 1 << 20:
                    yield made(rows, parts)
                    rows, parts, size = [], [], 0
            if rows:
                yield made(rows, parts)

    pieces = arrow_map(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
        "doc_id long, start long, length long, doc_tokens long, ids binary")
    return pieces.select(
        "doc_id", "start", "length", "doc_tokens", F.col("length").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"), "ids")
