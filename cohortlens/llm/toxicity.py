"""Toxicity: bidirectional gated recurrent network with attention pooling, trained in numpy.

Input of a step is a word's hashed embedding beside the mean embedding of its hashed
character trigrams.  Two gated recurrent passes read a window of ``WINDOW`` words, attention
pools the states, and a linear unit gives the window's logit.  A document is scored on all
its windows, each overlapping the next by half; a small logistic model over its highest
window logits and its length gives the score.

A word of more than ``LONGEST`` bytes is read as several pieces, so a window has a bounded size
and nothing is left out.

The network is fitted on the driver on a bounded sample: of at most ``SAMPLE_ROWS`` labelled rows
of each label, at most ``SAMPLE_WINDOWS`` labelled windows, drawn from all their windows with the
same expected number for each row.  Scoring is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import textops as T
from cohortlens.llm.shipping import arrow_map
from cohortlens.llm.staging import staged

WINDOW, STRIDE = 32, 16
WORD_ROWS, CHAR_ROWS, EMBED, HIDDEN = 1 << 14, 1 << 12, 8, 8
LONGEST = 64  # bytes of a piece
SAMPLE_ROWS, SAMPLE_WINDOWS = 2500, 60_000
EPOCHS, STEPS, BATCH, SEED = 4, 800, 256, 7  # at least so many passes and steps
PART = 2048  # windows that are read at a time
UNTAUGHT = np.array([0, 0, 0, 0, -4.0])  # document weights without both labels: all score 0.018
_U = np.uint64
_LONG = re.compile(rb"[^\x20\x09-\x0D]{%d}(?=[^\x20\x09-\x0D])" % LONGEST)
_FOLD = bytes(32 if chr(b) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else ord(chr(b).lower()) if b < 128 else b
              for b in range(256))


def folded(text: bytes) -> bytes:
    """Lower case, punctuation as blanks (ASCII)."""
    return text.translate(_FOLD)


def pieces(texts: list[bytes]) -> list[bytes]:
    """Folded texts with words of more than LONGEST bytes cut into pieces of that size."""
    return [_LONG.sub(rb"\g<0> ", folded(t)) for t in texts]


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Tokens:
    """The words of folded texts by distinct word: ``word`` (word number of each token), ``row``
    (hashed embedding row of each word), ``gram``/``owner`` (its hashed trigrams)."""

    def __init__(self, texts: list[bytes]):
        words = T.Words([folded(t) for t in texts])
        if len(words.start) and (words.end - words.start).max() > LONGEST:
            words = T.Words(pieces(texts))
        self.first = words.first
        distinct, at, self.word = np.unique(words.hashes(), return_index=True, return_inverse=True)
        self.row = (distinct % _U(WORD_ROWS)).astype(np.int64)
        length = words.end[at] - words.start[at] if len(at) else np.zeros(0, np.int64)
        self.owner = np.repeat(np.arange(len(at)), length)
        place = words.start[at][self.owner] + T.repeated_arange(length) if len(at) else self.owner
        b = words.buf.astype(_U)
        gram = (b[np.maximum(place - 1, 0)] << _U(16)) | (b[place] << _U(8)) | b[place + 1] if len(at) else b[:0]
        gram[place == 0] = (_U(32) << _U(16)) | (gram[place == 0] & _U(0xFFFF))
        gram[T.SPACE[(gram >> _U(16)).astype(np.int64)]] |= _U(32) << _U(16)
        self.gram = (T.mix64(gram & _U(0xFFFFFF)) % _U(CHAR_ROWS)).astype(np.int64)
        self.length = np.maximum(length, 1)

    def inputs(self, net: dict) -> np.ndarray:
        chars = np.zeros((len(self.row), EMBED), np.float32)
        if len(self.row):
            first = np.searchsorted(self.owner, np.arange(len(self.row)))
            chars = np.add.reduceat(net["char"][self.gram], first) / self.length[:, None]
        return np.concatenate([net["word"][self.row], chars], 1).astype(np.float32)


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first token, length) of all windows of texts whose tokens are first[i]:first[i+1].
    A text without tokens has one empty window; every token is in a window."""
    size = np.diff(first)
    count = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
    text = np.repeat(np.arange(len(size)), count)
    start = T.repeated_arange(count) * STRIDE
    return text, first[:-1][text] + start, np.minimum(WINDOW, size[text] - start)


def new_network(rng: np.random.Generator) -> dict:
    def draw(*shape, scale):
        return rng.normal(0, scale, shape).astype(np.float32)
    net = {"word": draw(WORD_ROWS, EMBED, scale=0.1), "char": draw(CHAR_ROWS, EMBED, scale=0.1),
           "att": draw(2 * HIDDEN, HIDDEN, scale=0.3), "key": draw(HIDDEN, scale=0.3),
           "out": draw(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}
    for d in "fb":
        net |= {"W" + d: draw(2 * EMBED, 3 * HIDDEN, scale=0.4), "U" + d: draw(HIDDEN, 3 * HIDDEN, scale=0.3),
                "c" + d: np.zeros(3 * HIDDEN, np.float32)}
    return net


def _pass(gates: np.ndarray, token: np.ndarray, mask: np.ndarray, u: np.ndarray, back: bool, keep: list | None):
    """States (T, B, H) of one gated recurrent pass; ``keep`` collects what training needs."""
    steps, size, n = len(token), token.shape[1], HIDDEN
    h = np.zeros((size, n), np.float32)
    states = np.zeros((steps, size, n), np.float32)
    for t in range(steps)[::-1] if back else range(steps):
        a, hu = gates[token[t]], h @ u
        zr = sigmoid(a[:, :2 * n] + hu[:, :2 * n])
        z, r = zr[:, :n], zr[:, n:]
        new = np.tanh(a[:, 2 * n:] + r * hu[:, 2 * n:])
        step = mask[t][:, None] * (1 - z) * (new - h)
        if keep is not None:
            keep.append((t, h, z, r, new, hu[:, 2 * n:]))
        h = h + step
        states[t] = h
    return states


def forward(net: dict, x: np.ndarray, token: np.ndarray, mask: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Logits of windows; ``token`` (T, B) rows of ``x``, ``mask`` (T, B) 1 where there is one."""
    both = []
    for d in "fb":
        tape = [] if keep is not None else None
        both.append(_pass(x @ net["W" + d] + net["c" + d], token, mask, net["U" + d], d == "b", tape))
        if keep is not None:
            keep[d] = tape
    h = np.concatenate(both, 2)
    act = np.tanh(h @ net["att"])
    score = np.where(mask > 0, act @ net["key"], np.float32(-30))
    weight = np.exp(score - score.max(0)) * mask
    weight /= np.maximum(weight.sum(0), 1e-9)
    pooled = (weight[:, :, None] * h).sum(0)
    if keep is not None:
        keep |= {"h": h, "act": act, "weight": weight, "pooled": pooled}
    return pooled @ net["out"] + net["bias"][0]


def summed(row: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in ``row``, ordered, and the sum of ``value`` (one line each) by number."""
    if not len(row):
        return row, value
    order = np.argsort(row, kind="stable")
    row = row[order]
    first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
    return row[first], np.add.reduceat(value[order], first)


def gradients(net: dict, x: np.ndarray, token: np.ndarray, mask: np.ndarray, dlogit: np.ndarray, keep: dict):
    """Gradients of all dense weights, and of ``x``."""
    g = {"out": keep["pooled"].T @ dlogit, "bias": np.array([dlogit.sum()], np.float32)}
    dpool = dlogit[:, None] * net["out"]
    h, weight, act = keep["h"], keep["weight"], keep["act"]
    dw = (h * dpool).sum(2)
    dscore = weight * (dw - (weight * dw).sum(0))
    g["key"] = np.einsum("tbk,tb->k", act, dscore)
    dact = dscore[:, :, None] * net["key"] * (1 - act * act)
    g["att"] = np.einsum("tbh,tbk->hk", h, dact)
    dh_all = weight[:, :, None] * dpool + dact @ net["att"].T
    dgate, n = np.zeros((*token.shape, 6 * HIDDEN), np.float32), HIDDEN
    for i, d in enumerate("fb"):
        u, du = net["U" + d], np.zeros_like(net["U" + d])
        own = dgate[:, :, 3 * n * i:3 * n * (i + 1)]
        dh = np.zeros((token.shape[1], n), np.float32)
        for t, prev, z, r, new, hu in reversed(keep[d]):
            dh = dh + dh_all[t][:, i * n:(i + 1) * n]
            m = mask[t][:, None]
            dstep = dh * m
            dnew = dstep * (1 - z) * (1 - new * new)
            dz = -dstep * (new - prev) * z * (1 - z)
            dr = dnew * hu * r * (1 - r)
            own[t] = np.concatenate([dz, dr, dnew], 1)
            dhu = np.concatenate([dz, dr, dnew * r], 1)
            du += prev.T @ dhu
            dh = dh - dstep * (1 - z) + dhu @ u.T
        g["U" + d] = du
    word, dgate = summed(token.ravel(), dgate.reshape(-1, 6 * n))
    dx = np.zeros_like(x)
    for i, d in enumerate("fb"):
        own = dgate[:, 3 * n * i:3 * n * (i + 1)]
        g["W" + d], g["c" + d] = x[word].T @ own, own.sum(0)
        dx[word] += own @ net["W" + d].T
    return g, dx


def _laid_out(tokens: Tokens, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.arange(WINDOW)[:, None]
    mask = at < length
    place = np.where(mask, start + at, 0)
    word = tokens.word if len(tokens.word) else np.zeros(1, np.int64)
    return word[place], mask.astype(np.float32)


def train_network(texts: list[bytes], label: np.ndarray, seed: int = SEED) -> dict:
    """Fit on texts of at most one window each (Adam; Adagrad for the embeddings)."""
    rng = np.random.default_rng(seed)
    net = new_network(rng)
    if not len(texts) or label.min() == label.max():
        net["bias"][0] = 0 if not len(texts) else (4 if label[0] else -4)
        net["out"][:] = 0
        return net
    dense = [k for k in net if k not in ("word", "char")]
    m, v = ({k: np.zeros_like(net[k]) for k in dense} for _ in range(2))
    seen = {k: np.full_like(net[k], 1e-3) for k in ("word", "char")}
    step = 0
    size = min(BATCH, max(32, len(texts) // 32))
    epochs = max(EPOCHS, -(-STEPS * size // len(texts)))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        rate = 0.01 * (1 - epoch / epochs)
        for o in range(0, len(order), size):
            rows = order[o:o + size]
            tokens = Tokens([texts[i] for i in rows])
            if not len(tokens.row):
                continue
            token, mask = _laid_out(tokens, tokens.first[:-1], np.minimum(np.diff(tokens.first), WINDOW))
            x, keep = tokens.inputs(net), {}
            p = sigmoid(forward(net, x, token, mask, keep))
            g, dx = gradients(net, x, token, mask, ((p - label[rows]) / len(rows)).astype(np.float32), keep)
            step += 1
            for k in dense:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.01 * (g[k] ** 2 - v[k])
                net[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)
            word, dword = tokens.row, dx[:, :EMBED]
            dchar = (dx[:, EMBED:] / tokens.length[:, None])[tokens.owner]
            for k, row, grad in (("word", word, dword), ("char", tokens.gram, dchar)):
                rows_, total = summed(row, grad)
                seen[k][rows_] += total ** 2
                net[k][rows_] -= 5 * rate * total / np.sqrt(seen[k][rows_])
    return net


def features(net: dict, texts: list[bytes]) -> np.ndarray:
    """For each text: 1st, 3rd and 5th highest window logit (neighbouring windows share their
    words) and the log of the number of windows.  Where there are fewer, the lowest stands in."""
    out = np.zeros((len(texts), 4))
    for i, j in T.chunks(texts, T.CHUNK_BYTES // 2):
        tokens = Tokens(texts[i:j])
        text, start, length = windows(tokens.first)
        x = tokens.inputs(net) if len(tokens.row) else np.zeros((1, 2 * EMBED), np.float32)
        logit = np.concatenate([forward(net, x, *_laid_out(tokens, start[o:o + PART], length[o:o + PART]))
                                for o in range(0, len(start), PART)])
        order = np.lexsort((-logit, text))
        count = np.bincount(text, minlength=j - i)
        first = np.cumsum(count) - count
        for c, rank in enumerate((0, 2, 4)):
            out[i:j, c] = logit[order[first + np.minimum(rank, count - 1)]]
        out[i:j, 3] = np.log(count)
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Weights (bias last) by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(steps if len(x) else 0):
        p = sigmoid(x @ w)
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w -= np.linalg.solve(hess, x.T @ (p - y) + ridge * w)
    return w


def held_out(doc_id) -> F.Column:
    """Rows never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text, y): at most ``rows`` labelled rows of each label that may be learnt from, by
    a hash of id and text; labels of other documents do not count, and rows equal in both are one.
    The broadcast side has at most 2 * ``rows`` rows."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("y")).filter(
        F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(
        F.max("y").alias("y"))
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("own"))
    keys = named.select("doc_id", "own").distinct().join(known, "doc_id")
    order = F.xxhash64(F.lit(SEED), "doc_id", "own")
    picked = [keys.filter(F.col("y") == y).orderBy(order, "doc_id", "own").limit(rows) for y in (0, 1)]
    return named.join(F.broadcast(picked[0].union(picked[1])), ["doc_id", "own"]).dropDuplicates(["doc_id", "own"]).select(
        "doc_id", "text", "y")


def _drawn(sample: DataFrame, window_rows: int) -> DataFrame:
    """(doc_id, part, y): at most ``window_rows`` of all windows of the sampled rows.  A window's
    place in the draw is an exponential variate of the rate 1 / windows of its row, so rows count
    alike, and every window of a row may be drawn."""
    def cut(batches):
        for batch in batches:
            ids, ys = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for own, raw, y in zip(ids, T.utf8(batch.column(1)), ys, strict=True):
                words = pieces([raw])[0].split()
                starts = np.arange(1 + max(0, -(-(len(words) - WINDOW) // STRIDE))) * STRIDE
                u = (T.mix64(starts.astype(_U) + _U(own & 0xFFFFFFFF)).astype(float) + 1) / 2.0**64
                for o in range(0, len(starts), PART):
                    parts = [b" ".join(words[s:s + WINDOW]) for s in starts[o:o + PART]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([own] * len(parts)), pa.array(parts, pa.binary()), pa.array([y] * len(parts), pa.int32()),
                         pa.array(-np.log(u[o:o + PART]) * len(starts))], names=["doc_id", "part", "y", "place"])

    return arrow_map(sample, cut, "doc_id long, part binary, y int, place double").orderBy(
        "place", "doc_id", "part").limit(window_rows).drop("place")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, window_rows: int = SAMPLE_WINDOWS) -> dict:
    """Fit network and document model.  To the driver come at most ``window_rows`` windows of at
    most 32 pieces of 64 bytes, and four numbers for each of at most 2 * ``rows`` sampled rows."""
    sample = staged(_sample(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, rows), "labelled")
    parts = _drawn(sample, window_rows).toArrow().sort_by([("doc_id", "ascending"), ("part", "ascending")])
    net = train_network(parts.column("part").to_pylist(), np.asarray(parts.column("y"), np.float32))

    def known(batches):
        for batch in batches:
            f = features(net, T.utf8(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, f.T), batch.column(2)], names=["doc_id", "a", "b", "c", "d", "y"])

    told = arrow_map(sample, known, "doc_id long, a double, b double, c double, d double, y int").toArrow().sort_by(
        [("doc_id", "ascending"), ("a", "ascending")])
    x = np.stack([told.column(c).to_numpy() for c in "abcd"], 1)
    y = told.column("y").to_numpy().astype(float)
    return {"net": net, "document": fit_logistic(x, y) if len(set(y)) == 2 else UNTAUGHT}


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out, score (0 to 1), predicted.

    Null and word-free texts are scored as one empty window.  Rows with a null doc_id are
    scored like others, repeated rows each.  A model without both labels in its sample scores
    all documents alike and below 0.5.  Other columns are ignored; an empty table gives no rows.
    """
    def run(batches):
        for batch in batches:
            texts = T.utf8(batch.column(1))
            for i, j in T.chunks(texts):
                f = features(model["net"], texts[i:j])
                score = sigmoid(np.c_[f, np.ones(j - i)] @ model["document"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.clip(score, 0, 1))], names=["doc_id", "score"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_map(read, run, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject_toxic(docs: DataFrame, model: dict, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = T.utf8(batch.column(place))
            for i, j in T.chunks(texts):
                score = sigmoid(np.c_[features(model["net"], texts[i:j]), np.ones(j - i)] @ model["document"])
                yield batch.slice(i, j - i).filter(pa.array(score < threshold))

    return arrow_map(docs, run, docs.schema)
