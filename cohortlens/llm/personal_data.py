"""Personal data: spans by rule, and further spans by a character network with a transition layer.

Rules find four kinds of spans exactly, in time linear in the text.  These spans label the texts;
from a bounded sample of labelled tiles a bidirectional long short-term memory network over
characters with conditional-random-field transitions is trained in numpy.  It reads every text
whole, in overlapping windows.  Each window is decoded by the best tag path; of positions covered
twice the window counts in which they lie farther from the border, and runs of one tag over the
whole document are spans.  Those that touch no rule span and have the make-up of their kind are
added.  Rule spans always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from cohortlens.llm import textops as T
from cohortlens.llm.shipping import arrow_map
from cohortlens.llm.staging import staged

KINDS = ("email", "ip", "card", "phone")
TAGS = len(KINDS) + 1  # 0: none
#: Labelled tiles to learn from, at most so many of each class: with a span; without, but with a
#: digit or an @; others.  A tile has at most TILE characters.
SAMPLE_TILES, TILE = 1024, 96
WINDOW, MARGIN = 256, 16
STRIDE = WINDOW - 2 * MARGIN
OTHER, PAD = 128, 129  # symbols: ASCII, any other code point, past the end
SIZE, EMBED = 12, 12
EPOCHS, BATCH, RATE = 15, 64, 0.02
SPANS = "array<struct<kind:string,start:int,end:int,added:boolean>>"

_LOCAL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGITS = re.compile(r"[0-9][0-9. -]*+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AT = re.compile(r"@|\bat\b|[\[({]at[\])}]", re.IGNORECASE)


def luhn(digits: str) -> bool:
    doubled = str.maketrans("0123456789", "0246813579")
    back = digits[::-1]
    return (sum(map(int, back[::2])) + sum(map(int, back[1::2].translate(doubled)))) % 10 == 0


def _octet(part: str) -> bool:
    short = part.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start; positions are code points."""
    found = []
    if "@" in text:
        last = 0
        for m in _LOCAL.finditer(text):
            start = max(m.start(), last)
            domain = _DOMAIN.match(text, m.end()) if start < m.end() - 1 else None
            if domain:
                last = domain.end()
                found.append((0, start, last))
    # an address or a card lies within one run of digits, dots, spaces and dashes
    for run in _DIGITS.finditer(text):
        if run.end() - run.start() < 7:
            continue
        for m in _IP.finditer(text, run.start(), run.end()):
            if all(map(_octet, m.groups())):
                found.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text, run.start(), run.end()):
            digits = m[0].replace(" ", "").replace("-", "") if 16 <= m.end() - m.start() <= 37 else ""
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append((3, m.start(), m.end()))
    return sorted(found)


def plausible(kind: int, part: str) -> bool:
    """Whether a decoded span has the make-up of its kind: an email an at-sign, spelt out or not,
    between letters; an address four numbers up to 255; a card 13 to 19 digits that pass Luhn; a
    phone number 8 to 15 digits and no letters."""
    numbers = re.findall("[0-9]+", part)
    digits = "".join(numbers)
    letters = sum(map(str.isalpha, part))
    if kind == 0:
        at = _AT.search(part)
        return bool(at and letters >= 5 and any(map(str.isalnum, part[:at.start()])) and any(map(str.isalnum, part[at.end():])))
    if kind == 1:
        return len(numbers) == 4 and all(map(_octet, numbers)) and not letters
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits) and not letters
    return 8 <= len(digits) <= 15 and not letters and len(numbers) > 1


class Symbols:
    """The symbols of several texts, each followed by WINDOW paddings."""

    def __init__(self, texts: list[str]):
        parts, self.size = [], np.zeros(len(texts), np.int64)
        pad = np.full(WINDOW, PAD, np.uint8)
        for i, t in enumerate(texts):
            code = np.frombuffer(t.encode("utf-32-le"), np.uint32)
            self.size[i] = len(code)
            parts += [np.minimum(code, OTHER).astype(np.uint8), pad]
        self.all = np.concatenate(parts) if parts else pad
        self.base = np.cumsum(self.size + WINDOW) - self.size - WINDOW

    def cut(self, starts: np.ndarray, width: int) -> np.ndarray:
        return np.lib.stride_tricks.sliding_window_view(self.all, width)[starts]

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(text number, window number) of windows that cover all texts."""
        count = np.where(self.size > 0, 1 + np.maximum(0, -(-(self.size - WINDOW) // STRIDE)), 0)
        return np.repeat(np.arange(len(count)), count), T.repeated_arange(count)


@dataclass
class Tagger:
    """Character embedding, the two directions' gates, tag emissions, and tag transitions."""

    embed: np.ndarray  # (EMBED, symbols)
    gates: list[np.ndarray]  # forward, backward: (4 SIZE, SIZE + EMBED + 1)
    out: np.ndarray  # (TAGS, 2 SIZE + 1)
    step: np.ndarray  # (TAGS, TAGS): from, to
    edge: np.ndarray  # (2, TAGS): first and last tag

    @staticmethod
    def fresh(seed: int = 7) -> Tagger:
        r = np.random.default_rng(seed)
        gates = [r.normal(0, 0.3, (4 * SIZE, SIZE + EMBED + 1)).astype(np.float32) for _ in range(2)]
        for g in gates:
            g[:, -1] = 0
            g[SIZE:2 * SIZE, -1] = 1  # remember at first
        return Tagger(r.normal(0, 0.5, (EMBED, PAD + 1)).astype(np.float32), gates,
                      r.normal(0, 0.3, (TAGS, 2 * SIZE + 1)).astype(np.float32),
                      np.zeros((TAGS, TAGS), np.float32), np.zeros((2, TAGS), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.embed, *self.gates, self.out, self.step, self.edge]

    def emissions(self, x: np.ndarray) -> np.ndarray:
        """(steps, TAGS, windows) from symbols (steps, windows)."""
        steps, n = x.shape
        letters = self.embed[:, x]
        em = np.empty((steps, TAGS, n), np.float32)
        em[:] = self.out[:, -1:]
        z, part = np.empty((4 * SIZE, n), np.float32), np.empty((TAGS, n), np.float32)
        keep = np.empty((SIZE, n), np.float32)
        for way, order in enumerate((range(steps), range(steps - 1, -1, -1))):
            state, c = np.zeros((SIZE + EMBED + 1, n), np.float32), np.zeros((SIZE, n), np.float32)
            state[-1] = 1
            h, out = state[:SIZE], np.ascontiguousarray(self.out[:, way * SIZE:(way + 1) * SIZE])
            i, f, o, g = (z[k * SIZE:(k + 1) * SIZE] for k in range(4))
            sigmoids = z[:3 * SIZE]
            for t in order:
                state[SIZE:-1] = letters[:, t]
                np.matmul(self.gates[way], state, out=z)
                np.tanh(z, out=z)
                sigmoids += 1
                sigmoids *= 0.5
                np.multiply(i, g, out=keep)
                c *= f
                c += keep
                np.tanh(c, out=keep)
                np.multiply(o, keep, out=h)
                np.matmul(out, h, out=part)
                em[t] += part
        return em

    def decode(self, em: np.ndarray) -> np.ndarray:
        """Best tag path of each window, (steps, windows)."""
        steps, _, n = em.shape
        tags = np.zeros((steps, n), np.uint8)
        # where no tag's lead over "none" can pay for itself by the best transitions, the best
        # path is "none" throughout
        gain = 2 * max(0.0, float(self.step.max() - self.step[0, 0])) + float((self.edge.max(1) - self.edge[:, 0]).sum())
        lead = em[:, 1:].max(1) - em[:, 0]
        open_ = np.flatnonzero(lead.max(0) + gain >= 0)
        if len(open_):
            e = em[:, :, open_]
            best = [e[0] + self.edge[0][:, None]]
            for t in range(1, steps):
                best.append((best[-1][:, None] + self.step[:, :, None]).max(0) + e[t])
            y = (best[-1] + self.edge[1][:, None]).argmax(0)
            path = [y]
            for t in range(steps - 2, -1, -1):
                y = (best[t] + self.step[:, y]).argmax(0)
                path.append(y)
            tags[:, open_] = np.array(path[::-1], np.uint8)
        return tags


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def loss_gradients(m: Tagger, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean negative log-likelihood of the tag paths ``y`` for symbols ``x`` (both steps, windows)
    and its gradients, in the order of ``Tagger.weights``."""
    steps, n = x.shape
    letters = m.embed[:, x]
    runs = []
    for way, order in enumerate((range(steps), range(steps - 1, -1, -1))):
        h, c, trace = np.zeros((SIZE, n), np.float32), np.zeros((SIZE, n), np.float32), {}
        for t in order:
            state = np.concatenate([h, letters[:, t], np.ones((1, n), np.float32)])
            a = np.tanh(m.gates[way] @ state)
            a[:3 * SIZE] = 0.5 + 0.5 * a[:3 * SIZE]
            i, f, o, g = a[:SIZE], a[SIZE:2 * SIZE], a[2 * SIZE:3 * SIZE], a[3 * SIZE:]
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            trace[t] = state, a, before, tc, h
        runs.append((order, trace))
    hidden = np.stack([np.concatenate([runs[0][1][t][4], runs[1][1][t][4], np.ones((1, n), np.float32)]) for t in range(steps)])
    em = np.matmul(m.out, hidden)

    ahead = [em[0] + m.edge[0][:, None]]
    for t in range(1, steps):
        ahead.append(_logsum(ahead[-1][:, None] + m.step[:, :, None], 0) + em[t])
    total = _logsum(ahead[-1] + m.edge[1][:, None], 0)
    back = np.broadcast_to(m.edge[1][:, None], (TAGS, n))
    d_em, d_step = np.empty_like(em), np.zeros_like(m.step)
    for t in range(steps - 1, -1, -1):
        d_em[t] = np.exp(ahead[t] + back - total)
        if t:
            after = back + em[t]
            d_step += np.exp(ahead[t - 1][:, None] + m.step[:, :, None] + after[None] - total).sum(2)
            back = _logsum(m.step[:, :, None] + after[None], 1)
    rows = np.arange(n)
    gold = m.edge[0][y[0]] + m.edge[1][y[-1]] + em[np.arange(steps)[:, None], y, rows].sum(0) + m.step[y[:-1], y[1:]].sum(0)
    d_edge = np.stack([d_em[0].sum(1) - np.bincount(y[0], minlength=TAGS), d_em[-1].sum(1) - np.bincount(y[-1], minlength=TAGS)])
    d_em[np.arange(steps)[:, None], y, rows] -= 1
    np.subtract.at(d_step, (y[:-1].ravel(), y[1:].ravel()), 1)

    d_out = np.einsum("tkn,tjn->kj", d_em, hidden, optimize=True)
    d_hidden = np.matmul(m.out.T, d_em)
    d_letters, d_gates = np.zeros((steps, EMBED, n), np.float32), []
    for way, (order, trace) in enumerate(runs):
        d_gate, dh, dc = np.zeros_like(m.gates[way]), np.zeros((SIZE, n), np.float32), np.zeros((SIZE, n), np.float32)
        for t in reversed(order):
            state, a, before, tc, _ = trace[t]
            i, f, o, g = a[:SIZE], a[SIZE:2 * SIZE], a[2 * SIZE:3 * SIZE], a[3 * SIZE:]
            dh = dh + d_hidden[t, way * SIZE:(way + 1) * SIZE]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g, dc * before, dh * tc, dc * i])
            gates = a[:3 * SIZE]
            dz[:3 * SIZE] *= 2 * gates * (1 - gates)
            dz[3 * SIZE:] *= 1 - g * g
            d_gate += dz @ state.T
            ds = m.gates[way].T @ dz
            dh, dc = ds[:SIZE], dc * f
            d_letters[t] += ds[SIZE:-1]
        d_gates.append(d_gate)
    d_embed = np.zeros((PAD + 1, EMBED), np.float32)
    flat = x.ravel()
    order = np.argsort(flat, kind="stable")
    used, first = np.unique(flat[order], return_index=True)
    d_embed[used] = np.add.reduceat(d_letters.transpose(0, 2, 1).reshape(-1, EMBED)[order], first)
    grads = [d_embed.T, *d_gates, d_out, d_step, d_edge]
    return float((total - gold).mean()), [(g / n).astype(np.float32) for g in grads]


def fit(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Tagger:
    """A tagger from labelled tiles: symbols and tags (tiles, steps)."""
    model, r = Tagger.fresh(seed), np.random.default_rng(seed)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in model.weights()]
    done, steps = 0, epochs * -(-len(x) // BATCH)
    for _ in range(epochs):
        order = r.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at:at + BATCH]
            _, grads = loss_gradients(model, x[rows].T, y[rows].T.astype(np.int64))
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            done += 1
            rate = RATE * (1 - done / (steps + 1))
            for w, g, (m1, m2) in zip(model.weights(), grads, moments, strict=True):
                g *= min(1.0, 5 / (norm + 1e-9))
                m1 += 0.1 * (g - m1)
                m2 += 0.01 * (g * g - m2)
                w -= rate * (m1 / (1 - 0.9**done)) / (np.sqrt(m2 / (1 - 0.99**done)) + 1e-6)
    return model


def model_spans(model: Tagger, texts: list[str]) -> dict[int, list[tuple[int, int, int]]]:
    """By text number: (kind number, start, end) of the runs of one tag that the windows, decoded
    one by one and put together by position, give for the whole text."""
    sym = Symbols(texts)
    text, number = sym.windows()
    tags: dict[int, np.ndarray] = {}
    for at in range(0, len(text), 2048):
        own, no = text[at:at + 2048], number[at:at + 2048]
        got = model.decode(model.emissions(np.ascontiguousarray(sym.cut(sym.base[own] + no * STRIDE, WINDOW).T)))
        for w in np.flatnonzero(got.any(0)):
            i, start, size = int(own[w]), int(no[w]) * STRIDE, int(sym.size[own[w]])
            low = 0 if start == 0 else MARGIN
            high = size - start if start + WINDOW >= size else WINDOW - MARGIN
            tags.setdefault(i, np.zeros(size, np.uint8))[start + low:start + high] = got[low:high, w]
    out = {}
    for i, t in tags.items():
        edges = np.flatnonzero(np.diff(t, prepend=0, append=0))
        out[i] = [(int(t[a]) - 1, int(a), int(b)) for a, b in zip(edges[:-1], edges[1:], strict=True) if t[a]]
    return out


def added_spans(text: str, rules: list[tuple[int, int, int]], decoded: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Decoded spans, without blanks and punctuation at their ends, that touch no rule span and
    are plausible."""
    out = []
    for kind, a, b in decoded:
        while a < b and not text[a].isalnum() and text[a] not in "+(":
            a += 1
        while a < b and not text[b - 1].isalnum():
            b -= 1
        if a < b and plausible(kind, text[a:b]) and not any(a < e and s < b for _, s, e in rules):
            out.append((kind, a, b))
    return out


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    return T.chunks(texts)  # by characters


def _tiles(keep: list[float] | None):
    """Per task the number of tiles of each class, or the distinct tiles of each class whose hash,
    as a share of all hashes, is below ``keep``."""
    def run(batches):
        counts, seen = np.zeros(3, np.int64), set()
        for batch in batches:
            texts = _texts(batch.column(0))
            rows = []
            for i, j in _chunks(texts):
                sym = Symbols(texts[i:j])
                tag = np.zeros(len(sym.all), np.uint8)
                for t, b in zip(texts[i:j], sym.base, strict=True):
                    for kind, s, e in rule_spans(t):
                        tag[b + s:b + e] = kind + 1
                count = -(-sym.size // TILE)
                own = np.repeat(np.arange(j - i), count)
                start = sym.base[own] + T.repeated_arange(count) * TILE
                if not len(start):
                    continue
                # a text's last tile runs into its paddings, which are longer than a tile
                hint = (((sym.all >= 48) & (sym.all < 58)) | (sym.all == 64)).astype(np.uint8)
                kind = np.where(_any(tag, start), 0, np.where(_any(hint, start), 1, 2))
                if keep is None:
                    counts += np.bincount(kind, minlength=3)
                    continue
                name = np.array([xxhash.xxh64_intdigest(t.encode()) for t in texts[i:j]], np.uint64)
                h = T.mix64(name[own] + (start - sym.base[own]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                for w in np.flatnonzero(h / 2.0**64 < np.array(keep)[kind]):
                    if int(h[w]) not in seen:
                        seen.add(int(h[w]))
                        rows.append((int(kind[w]), int(h[w]) - (1 << 63), sym.all[start[w]:start[w] + TILE].tobytes(),
                                     tag[start[w]:start[w] + TILE].tobytes()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                    ["class", "hash", "symbols", "tags"])
        if keep is None:
            yield pa.RecordBatch.from_arrays([pa.array(counts[c:c + 1]) for c in range(3)], ["c0", "c1", "c2"])
    return run


def _any(mark: np.ndarray, start: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(mark != 0)]
    return total[start + TILE] > total[start]


def train(docs: DataFrame, tiles: int = SAMPLE_TILES) -> Tagger | None:
    """A tagger learnt from tiles of the texts of ``docs``, labelled by the rules: of each class
    (with a span; without, but with a digit or @; others) at most ``tiles`` tiles, those of the
    smallest hashes among all tiles of all texts.  None where no text holds a span.

    Two passes: one counts the tiles, the other sends tiles of hashes below a bound that about
    4 x ``tiles`` of a class meet; equal tiles at equal places of equal texts count once."""
    text = docs.select("text")
    counts = arrow_map(text, _tiles(None), "c0 long, c1 long, c2 long").agg(F.sum("c0"), F.sum("c1"), F.sum("c2")).first()
    if not counts[0]:
        return None
    keep = [min(1.0, 4 * tiles / c) if c else 0.0 for c in counts]
    drawn = staged(arrow_map(text, _tiles(keep), "class int, hash long, symbols binary, tags binary").distinct(), "tiles")
    rows = []
    for c in range(3):
        rows += drawn.filter(F.col("class") == c).orderBy("hash", "symbols", "tags").limit(tiles).collect()
    x = np.stack([np.frombuffer(r["symbols"], np.uint8) for r in rows])
    return fit(x, np.stack([np.frombuffer(r["tags"], np.uint8) for r in rows]))


def _found(model: Tagger | None):
    def run(batches):
        for batch in batches:
            texts = _texts(batch.column(1))
            for i, j in _chunks(texts):
                rules = [rule_spans(t) for t in texts[i:j]]
                decoded = model_spans(model, texts[i:j]) if model else {}
                out = []
                for n, own in enumerate(rules):
                    more = added_spans(texts[i + n], own, decoded[n]) if n in decoded else []
                    every = sorted([(*s, False) for s in own] + [(*s, True) for s in more])
                    out.append([{"kind": KINDS[k], "start": a, "end": b, "added": x} for k, a, b, x in every])
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())]))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(out, kind)], ["doc_id", "spans"])
    return run


def find_personal_data(docs: DataFrame, model: Tagger | None) -> DataFrame:
    """(doc_id, spans): for each row of ``docs`` its spans by kind, then start, in code points with
    the end exclusive; ``added`` marks those that only the network found.

    Null and empty texts have no spans; rows of repeated or null ids each keep their row; texts of
    any length are read whole; other columns are ignored; no rows give no rows.  Without a model
    there are rule spans only."""
    return arrow_map(docs.select("doc_id", "text"), _found(model), S.StructType(
        [S.StructField("doc_id", docs.schema["doc_id"].dataType)]).add("spans", S.DataType.fromDDL(SPANS)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_digest(found: DataFrame) -> DataFrame:
    """Counts of rule spans, the hash of their list, and the list of all spans."""
    base = F.filter("spans", lambda s: ~s["added"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))
