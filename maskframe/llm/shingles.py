"""Sets of word shingles as sorted distinct 64-bit hashes, computed with numpy for a whole text at once."""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_PLACE = _RNG.integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_WHITE = np.isin(np.arange(256), [32, *range(9, 14)])


class _Powers:
    """Powers of the base and of its inverse mod 2**64, as far as the longest text needs."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = 1 << (n + 1).bit_length()
            self.up, self.down = (np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)]).astype(np.uint64).cumprod(dtype=np.uint64) for b in (_BASE, _BACK))
        return self.up, self.down


POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A hash for each word [^\\x20\\x09-\\x0D]+ of the text, A-Z lower-cased, in order."""
    data = np.frombuffer(text.lower(), np.uint8)
    n = len(data)
    if not n:
        return np.empty(0, np.uint64)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_WHITE[data]
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    up, down = POWERS(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], dtype=np.uint64, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def shingle_set(text: bytes, size: int = 5) -> np.ndarray:
    """The sorted distinct hashes of the runs of `size` words; of fewer words, of the whole sequence; of none, empty."""
    words = word_hashes(text)
    n = len(words)
    if not n:
        return words
    k = min(n, size)
    out = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        out += words[j : n - k + 1 + j] * _PLACE[j % 64]
    return np.unique(mix(out + np.uint64(k)))
