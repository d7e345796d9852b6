"""Words, spans and their 64-bit hashes over blocks of texts, in numpy.

A block is the UTF-8 bytes of several texts on end. Span hashes come from one prefix sum per block:
with an odd base b, sum(v[x_i] * b^i) over a span, times b^-start, does not depend on where the
span lies. Values v are drawn per byte, and sums are mixed at the end; all modulo 2^64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Lower-cases A-Z alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values (splitmix64's finalizer)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    with np.errstate(over="ignore"):
        return tuple(
            np.concatenate([[np.uint64(1)], np.full(n, base, np.uint64)]).cumprod(dtype=np.uint64)
            for base in (_BASE, inverse)
        )


def _powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(20, int(n).bit_length()))


class Prefix:
    """Prefix sums of a block; ``hashes(starts, ends)`` of any of its spans."""

    def __init__(self, data: np.ndarray):
        power, self._inverse = _powers_for(len(data))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * power[: len(data)], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and for each text the first word (and all, last).

    ``bounds`` are the texts' places in the block, one more than texts. A word ends with its text.
    """
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~SPACES[data]
    starts_at = inside[1:] & ~inside[:-1]
    ends_at = inside[:-1] & ~inside[1:]
    # Where a text begins inside a run of non-spaces, one word ends and another starts.
    edges = bounds[1:-1]
    edges = edges[inside[edges] & inside[np.minimum(edges + 1, n + 1)]] if len(edges) else edges
    starts_at[edges] = True
    ends_at[edges] = True
    starts, ends = np.flatnonzero(starts_at), np.flatnonzero(ends_at)
    return starts, ends, np.searchsorted(starts, bounds)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column on end, and where each text lies; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(bounds: np.ndarray, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``size`` bytes each; a longer text is a run of its own."""
    first, n = 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Table:
    """Numbers of known 64-bit hashes: ``find`` gives each hash's position in ``keys``, or -1."""

    def __init__(self, keys: np.ndarray):
        self._bits = np.uint64(max(44, 63 - max(1, len(keys)).bit_length()))
        self._order = np.argsort(keys, kind="stable")
        self._keys = np.append(keys[self._order], np.uint64(0))
        slots = 1 << (64 - int(self._bits))
        self._first = np.searchsorted(keys[self._order] >> self._bits, np.arange(slots + 1, dtype=np.uint64))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> self._bits).astype(np.int64)
        at, end = self._first[slot], self._first[slot + 1]
        found = np.full(len(hashes), -1, np.int64)
        live = np.flatnonzero(at < end)
        at, end = at[live], end[live]
        while len(live):
            hit = self._keys[at] == hashes[live]
            found[live[hit]] = self._order[at[hit]]
            at = at + 1
            more = ~hit & (at < end)
            live, at, end = live[more], at[more], end[more]
        return found
