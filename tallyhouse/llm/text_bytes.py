"""Texts of Arrow batches as byte arrays, and hashes of their words; all in NumPy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at once; one text may be longer.
AT_ONCE = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins and ends; null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, starts, data = column.buffers()
    at = np.frombuffer(starts, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), at


def slices(column: pa.Array, at_once: int = AT_ONCE) -> Iterator[tuple[int, int]]:
    """Row ranges with about ``at_once`` bytes of text."""
    _, at = utf8(column)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + at_once, side="right")) - 1)
        yield first, last
        first = last


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers; every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Powers:
    """Powers of the hash base and of its inverse, made once per worker and length."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, AT_ONCE + (1 << 16))
            cls.up = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, _BASE))])
            cls.down = np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, _INVERSE))])
        return cls.up, cls.down


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch of bytes follows, see ``stretch_hash``."""
    up, _ = Powers.of(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def stretch_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = Powers.of(len(sums))
    return mixed((sums[end] - sums[start]) * down[start])


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and each text's first word's place among them."""
    data, at = data[at[0] : at[-1]], at - at[0]
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = at[:-1][at[:-1] < at[1:]]
    begins[edges] = inside[edges]  # a word never goes over from one text to the next
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[at[1:][at[:-1] < at[1:]] - 1] = inside[at[1:][at[:-1] < at[1:]] - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return stretch_hash(prefix_sums(_LOWER[data]), start, end), np.searchsorted(start, at)
