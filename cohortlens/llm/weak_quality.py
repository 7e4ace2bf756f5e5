"""Quality from weak labels: labellers, expectation-maximisation, hashed linear scorer.

Eight overlapping heuristics vote good, bad or not at all on each document.  The counts of
all vote patterns (at most 3**8, whatever the corpus) give, by expectation-maximisation,
each labeller's accuracy on good and on bad documents and the share of good ones.  Posteriors
of a bounded sample then train a linear scorer on hashed words, word shapes and shape pairs,
which scores every document in one pass.  No given label is used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textops as T
from cohortlens.llm.shipping import arrow_map
from cohortlens.llm.staging import staged

LABELLERS = ("length", "symbols", "line_ends", "word_length", "variety", "capitals", "separators", "shouting")
BUCKETS, SAMPLE_ROWS, SEED = 1 << 14, 1500, 11
_U = np.uint64
_CLASS = np.full(256, ord("a"), np.uint8)
for _b in range(128):
    _c = chr(_b)
    _CLASS[_b] = _b if not _c.isalnum() else ord("0") if _c.isdigit() else ord("A") if _c.isupper() else ord("a")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def votes(texts: list[bytes]) -> np.ndarray:
    """(texts, labellers): 1 good, 0 bad, 2 no vote."""
    words = T.Words(texts)
    kind = _CLASS[words.buf]
    h = words.hashes()

    def per_text(flag):
        total = np.r_[0, np.cumsum(flag)]
        return (total[words.base[1:] - 1] - total[words.base[:-1]]).astype(float)

    n = np.diff(words.first)
    size = np.maximum(per_text(~T.SPACE[words.buf]), 1)
    some = np.maximum(n, 1)
    text = np.repeat(np.arange(len(texts)), n)
    order = np.lexsort((h, text))
    fresh = np.r_[True, (h[order][1:] != h[order][:-1]) | (text[order][1:] != text[order][:-1])][:len(h)]
    distinct = np.bincount(text[order][fresh], minlength=len(texts))
    ends = np.array([_line_ends(t) for t in texts]).reshape(-1, 2)
    shout = np.array([t.count(b"!!") for t in texts])

    def vote(good, bad):
        return np.where(bad, 0, np.where(good, 1, 2))

    share = ends[:, 0] / np.maximum(ends[:, 1], 1)
    symbol, upper = per_text(_SYMBOL[words.buf]) / size, per_text(kind == ord("A")) / size
    bars, mean = per_text(words.buf == ord("|")) / some, size / some
    variety = distinct / np.minimum(some, 200)
    never = np.zeros(len(texts), bool)
    return np.stack([
        vote(never, n < 5), vote(symbol < 0.005, symbol > 0.03), vote(share >= 0.8, share < 0.4),
        vote(never, (mean < 2) | (mean > 12)), vote(never, variety < 0.2), vote(never, upper > 0.4),
        vote(never, bars > 0.1), vote(never, shout > 2)], 1)


def _line_ends(text: bytes) -> tuple[int, int]:
    """Lines that end a sentence, and lines with a word."""
    lines = [x for x in (line.split() for line in text.split(b"\n")) if x]
    return sum(x[-1][-1:] in b".!?:;" for x in lines), len(lines)


def estimate(pattern: np.ndarray, count: np.ndarray, rounds: int = 100) -> dict:
    """Expectation-maximisation on vote patterns (patterns, labellers) with counts.

    ``share``: of good documents; ``right[c, k, v]``: probability that labeller k votes v on
    class c (0 bad, 1 good).  Most labellers detect one fault
    and else do not vote, so it starts from bad votes being rare on good documents, not from
    the majority of votes."""
    k = pattern.shape[1]
    right = np.empty((2, k, 3))
    right[0], right[1] = (0.35, 0.15, 0.5), (0.02, 0.58, 0.4)
    share = 0.8
    for _ in range(rounds):
        post = posterior(pattern, share, right)
        share = float(np.clip((post * count).sum() / max(count.sum(), 1), 0.01, 0.99))
        for c, weight in enumerate(((1 - post) * count, post * count)):
            for v in range(3):
                right[c, :, v] = ((pattern == v) * weight[:, None]).sum(0) + 1
            right[c] /= right[c].sum(1, keepdims=True)
    return {"share": share, "right": right}


def posterior(pattern: np.ndarray, share: float, right: np.ndarray) -> np.ndarray:
    """Probability that documents with these votes are good."""
    at = np.arange(pattern.shape[1])
    log = [np.log(right[c][at, pattern]).sum(1) for c in (0, 1)]
    return 1 / (1 + (1 - share) / share * np.exp(np.clip(log[0] - log[1], -50, 50)))


def hashed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket, value): counts of words, shapes and neighbouring shapes, hashed; each
    text's logarithms of counts have unit length."""
    words = T.Words([t.lower() for t in texts])
    plain = T.Words(texts)
    kind = _CLASS[plain.buf]
    run = np.r_[True, (kind[1:] != kind[:-1]) | T.SPACE[plain.buf[1:]]]
    shapes = T.Words([])
    shapes.buf = kind[run]
    place = np.cumsum(run)
    shapes.start, shapes.end = place[plain.start] - 1, place[plain.end] - 1
    s = shapes.hashes()
    text = np.repeat(np.arange(len(texts)), np.diff(plain.first))
    pair = text[1:] == text[:-1]
    key = np.concatenate([words.hashes(), T.mix64(s ^ _U(1)), T.mix64(s[1:] * _U(3) ^ s[:-1])[pair]])
    owner = np.concatenate([text, text, text[1:][pair]])
    both, count = np.unique(owner * BUCKETS + (key % _U(BUCKETS)).astype(np.int64), return_counts=True)
    owner, bucket = both // BUCKETS, both % BUCKETS
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(owner, value ** 2, minlength=len(texts)))
    return owner, bucket, value / norm[owner]


def train_linear(text: np.ndarray, bucket: np.ndarray, value: np.ndarray, target: np.ndarray,
                 epochs: int = 40, rate: float = 2.0, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft targets by full gradients with momentum; classes weigh alike."""
    w, b, mw, mb = np.zeros(BUCKETS), 0.0, np.zeros(BUCKETS), 0.0
    good = max(target.sum(), 1e-9)
    weight = np.where(target >= 0.5, 0.5 / good, 0.5 / max((1 - target).sum(), 1e-9))
    for _ in range(epochs * 5 if len(target) else 0):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(text, value * w[bucket], minlength=len(target)) + b, -50, 50)))
        miss = (p - target) * weight
        mw = 0.9 * mw + np.bincount(bucket, value * miss[text], minlength=BUCKETS) + decay * w
        mb = 0.9 * mb + miss.sum()
        w, b = w - rate * mw, b - rate * mb
    return w, b


def score_quality(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, votes (by ``LABELLERS``; g, b or -),
    weak (posterior of the votes), score (0 to 1, the linear scorer), kept (score >= 0.5).

    The scorer learns from at most ``rows`` rows with a posterior of 0.5 or more and as many
    below, by a hash of id and text, rows equal in both being one; of each come all its features,
    at most ``BUCKETS``.  Null and word-free texts are voted on and scored like others; rows with a
    null doc_id are scored but not learnt from; repeated rows count each in the votes.  Other
    columns are ignored; an empty table gives no rows.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = read.withColumn("own", F.xxhash64("text"))
    digits = 3 ** np.arange(len(LABELLERS))

    def vote(batches):
        for batch in batches:
            texts = T.utf8(batch.column(1))
            for i, j in T.chunks(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array((votes(texts[i:j]) * digits).sum(1))],
                    names=["doc_id", "own", "pattern"])

    voted = staged(arrow_map(named, vote, "doc_id long, own long, pattern long"), "votes")
    counts = voted.groupBy("pattern").count().orderBy("pattern").collect()  # at most 3**8 rows
    codes = np.array([r["pattern"] for r in counts], np.int64)
    table = codes[:, None] // digits % 3 if len(codes) else np.zeros((0, len(digits)), np.int64)
    model = estimate(table, np.array([r["count"] for r in counts], float))
    post = posterior(table, model["share"], model["right"])

    keys = voted.filter(F.col("doc_id").isNotNull()).select("doc_id", "own", "pattern").distinct()
    sides = [keys.filter(F.col("pattern").isin(codes[side].tolist())).orderBy(
        F.xxhash64(F.lit(SEED), "doc_id", "own"), "doc_id", "own").limit(rows) for side in (post >= 0.5, post < 0.5)]
    picked = F.broadcast(sides[0].union(sides[1]))
    # written, so that sorting the texts and reading them in Python are not the same tasks
    chosen = staged(named.join(picked, ["doc_id", "own"]).dropDuplicates(["doc_id", "own"]).select(
        "doc_id", "text", "pattern"), "learnt")

    def sampled(batches):
        for batch in batches:
            texts = T.utf8(batch.column(1))
            for i, j in T.chunks(texts):
                owner, bucket, value = hashed(texts[i:j])
                first = np.searchsorted(owner, np.arange(j - i + 1))
                each = [slice(a, b) for a, b in zip(first[:-1], first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i),
                     pa.array([bucket[x].astype(np.int32) for x in each], pa.list_(pa.int32())),
                     pa.array([value[x].astype(np.float32) for x in each], pa.list_(pa.float32()))],
                    names=["doc_id", "pattern", "bucket", "value"])

    sample = arrow_map(chosen, sampled, "doc_id long, pattern long, bucket array<int>, value array<float>").toArrow().sort_by(
        [("doc_id", "ascending"), ("pattern", "ascending")])
    size = np.asarray(sample.column("bucket").combine_chunks().value_lengths()) if len(sample) else np.zeros(0, int)
    flat = [np.concatenate([np.zeros(0, np.float64), *(np.asarray(c.flatten()) for c in sample.column(n).chunks)])
            for n in ("bucket", "value")]
    target = post[np.searchsorted(codes, sample.column("pattern").to_numpy())] if len(sample) else np.zeros(0)
    w, b = train_linear(np.repeat(np.arange(len(size)), size), flat[0].astype(np.int64), flat[1], target)
    names = ["".join("bg-"[v] for v in row) for row in table]
    by_code = dict(zip(codes.tolist(), zip(names, post.tolist(), strict=True), strict=True))

    def score(batches):
        for batch in batches:
            texts = T.utf8(batch.column(1))
            for i, j in T.chunks(texts):
                owner, bucket, value = hashed(texts[i:j])
                margin = np.bincount(owner, value * w[bucket], minlength=j - i) + b
                told = [by_code[c] for c in (votes(texts[i:j]) * digits).sum(1).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([t[0] for t in told], pa.string()),
                     pa.array([t[1] for t in told], pa.float64()), pa.array(1 / (1 + np.exp(-np.clip(margin, -50, 50))))],
                    names=["doc_id", "votes", "weak", "score"])

    return arrow_map(read, score, "doc_id long, votes string, weak double, score double").withColumn(
        "kept", F.col("score") >= 0.5)
