"""Vectorised word, line and shingle hashing of whole texts (NumPy, inside Spark tasks).

A block of texts is joined with newlines into one byte array.  Words are runs of bytes other than
``[\\x20\\x09-\\x0D]``.  Every word, line and shingle gets a 64-bit value from a position-weighted
prefix sum over a fixed random byte table, so equal byte strings get equal values and different
ones differ up to 64-bit collisions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 1 << 19          # texts are handled in blocks of about this many bytes
_BASE = 0x9E3779B97F4A7C15     # odd, so that powers have an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_POWERS: dict = {}


def _powers(n: int):
    size = max(BLOCK_BYTES * 2, 1 << int(n).bit_length()) if n else BLOCK_BYTES * 2
    if size not in _POWERS:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        if len(_POWERS) > 1:
            _POWERS.clear()
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def mix(x):
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def blocks(encoded: list[bytes], size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges ``[i, j)`` of consecutive texts of about ``size`` bytes (at least one text)."""
    i = total = 0
    for j, b in enumerate(encoded):
        total += len(b) + 1
        if total >= size:
            yield i, j + 1
            i, total = j + 1, 0
    if i < len(encoded):
        yield i, len(encoded)


def encode(column) -> list[bytes]:
    """UTF-8 bytes of a column of strings; null is the empty text."""
    return [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in column]


class Block:
    """Words and lines of a block of texts.

    ``start``/``end``/``word`` are the byte range and the value of each word, ``doc`` the text it
    belongs to; ``first[d]:first[d + 1]`` are the words of text ``d``.
    """

    def __init__(self, encoded: list[bytes], lower: bool = True):
        self.n = len(encoded)
        raw = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
        self.raw = raw
        sizes = np.fromiter((len(b) for b in encoded), np.int64, self.n)
        self.sizes = sizes
        self.offset = np.concatenate([[0], np.cumsum(sizes + 1)])      # byte offset of each text
        up, self._down = _powers(len(raw) + 1)
        weights = _TABLE[LOWER[raw] if lower else raw]
        weights *= up[:len(raw)]
        self._sum = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(weights, out=self._sum[1:])
        space = SPACE[raw]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(raw) and not space[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.end = edge[0::2], edge[1::2]
        self.word = self.value(self.start, self.end)
        self.first = np.searchsorted(self.start, self.offset)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(self.n), self.counts)

    def value(self, start, end):
        """64-bit value of the byte ranges ``[start, end)``."""
        h = (self._sum[end] - self._sum[start]) * self._down[start]
        return mix(h + (end - start).astype(np.uint64))

    def lines(self):
        """``(start, end, doc)`` of every newline-split line."""
        end = np.flatnonzero(self.raw == 10)
        start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
        doc = np.searchsorted(self.offset, start, side="right") - 1
        return start, end, doc

    def grams(self, k: int):
        """``(value, inside)`` of the ``k``-word run at every word that has ``k - 1`` followers in
        the array; ``inside`` tells whether the run stays in one text."""
        w = self.word
        m = max(0, len(w) - k + 1)
        h = np.zeros(m, np.uint64)
        for i in range(k):
            h = h * np.uint64(0x2545F4914F6CDD1D | 1) + w[i:i + m]
        return mix(h), self.doc[:m] == self.doc[k - 1:k - 1 + m]

    def shingle_sets(self, k: int = 5) -> list:
        """Sorted distinct shingle values of each text: its ``k``-word runs, or with fewer words
        the whole sequence as one; empty without words."""
        h, inside = self.grams(k)
        out = []
        for d in range(self.n):
            n, s = int(self.counts[d]), int(self.first[d])
            if n >= k:
                out.append(np.unique(h[s:s + n - k + 1]))
            elif n:
                v = np.array([n], np.uint64)
                for x in self.word[s:s + n]:
                    v = mix(v * np.uint64(31) ^ x)
                out.append(v)
            else:
                out.append(np.zeros(0, np.uint64))
        return out
