"""Vectorised helpers on texts as UTF-8 bytes (numpy only; used inside Spark tasks).

A word is a maximal run of bytes other than space and 0x09-0x0D, which on UTF-8 equals the
pattern ``[^\\x20\\x09-\\x0D]+`` on code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64), elementwise."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed 64-bit constants drawn from a seed."""
    return mix64((np.arange(1, n + 1, dtype=_U) + _U(seed * 1_000_003)) * _U(0x9E3779B97F4A7C15))


_BYTE = stream(1, 256)
_BYTE[SPACE] = 0
_POWER = np.ones(1, _U)


def _powers(n: int) -> np.ndarray:
    global _POWER
    if len(_POWER) < n:
        _POWER = np.multiply.accumulate(np.r_[_U(1), np.full(2 * n, 0xD6E8FEB86659FD93, _U)])
    return _POWER


def utf8(column: pa.Array) -> list[bytes]:
    """The bytes of a text column; null becomes empty."""
    if pa.types.is_null(column.type):
        return [b""] * len(column)
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [t or b"" for t in column.cast(kind).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [i, j) of consecutive texts of about ``limit`` bytes together; none is cut."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield i, j
            i, size = j, 0
        size += len(t) + 64
    if i < len(texts):
        yield i, len(texts)


class Words:
    """The words of several texts laid end to end.

    ``start``/``end``: byte offsets in ``buf``; words of text ``i`` are ``first[i]:first[i+1]``;
    ``base[i]`` is where text ``i`` begins in ``buf``.
    """

    def __init__(self, texts: list[bytes]):
        self.buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        space = SPACE[self.buf]
        edge = np.flatnonzero(np.diff(space, prepend=True))
        self.start, self.end = edge[::2], edge[1::2]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.base = np.r_[0, np.cumsum(sizes + 1)]
        self.first = np.searchsorted(self.start, self.base)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash for each word, from its bytes and length."""
        if not len(self.start):
            return np.zeros(0, _U)
        length = self.end - self.start
        power = _powers(int(length.max()))
        inside = np.repeat(np.arange(len(self.start)), length)
        at = np.flatnonzero(~SPACE[self.buf])
        value = _BYTE[self.buf[at]] * power[at - self.start[inside]]
        first = np.r_[0, np.cumsum(length)[:-1]]
        return mix64(np.add.reduceat(value, first) + length.astype(_U) * _U(0x9E3779B97F4A7C15))


def grams(h: np.ndarray, k: int, seed: int) -> np.ndarray:
    """A hash for each run of k consecutive values of ``h`` (len(h) - k + 1 of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    out = np.zeros(n, _U)
    for j, c in enumerate(stream(seed, k) | _U(1)):
        out += h[j:j + n] * c
        out ^= out >> _U(29)
    return mix64(out)


def window_min(key: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w consecutive values (len(key) - w + 1 of them)."""
    n = len(key)
    if n < w:
        return key[:0]
    pad = -n % w
    blocks = np.concatenate([key, np.full(pad, np.iinfo(key.dtype).max, key.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def repeated_arange(counts: np.ndarray) -> np.ndarray:
    """0..c-1 for each c of counts, laid end to end."""
    total = int(counts.sum())
    return np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
