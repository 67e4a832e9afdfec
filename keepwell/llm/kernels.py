"""Numpy kernels on the byte buffers of Arrow strings: words, word hashes, rolling window hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from keepwell.llm.common import shipped

#: Texts are worked on in slices of about so many bytes, which bounds a task's memory.
SLICE_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over 64 bits (the public splitmix64 constants)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RollingHash:
    """Polynomial hash modulo 2**64 of any run of a sequence, from prefix sums and powers of an odd base."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.byte_values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.base = int(rng.integers(1 << 61, 1 << 62)) * 8 + 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.base &= (1 << 64) - 1
        self._grow(1 << 16)

    def _grow(self, n: int) -> None:
        self.powers = np.full(n, self.base, np.uint64)
        self.powers[0] = 1
        np.cumprod(self.powers, out=self.powers)
        self.inverses = np.full(n, self.inverse, np.uint64)
        self.inverses[0] = 1
        np.cumprod(self.inverses, out=self.inverses)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        if len(values) + 1 > len(self.powers):
            self._grow(2 * len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers[: len(values)], out=sums[1:])
        return sums

    def runs(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the runs [start, end), lengths included."""
        h = (sums[end] - sums[start]) * self.inverses[start]
        return mixed(h + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows with about ``most`` bytes; a null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each text the index of its first word (one more at the end)."""
    inside = ~_SEPARATOR[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offsets] = False  # a word never goes over from one text to the next
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[offsets] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; other bytes, and so all other characters, as they are."""
    return _LOWER[data]


shipped(__name__)
