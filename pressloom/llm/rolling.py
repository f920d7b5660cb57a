"""Hashes of tokens and of runs of tokens over a batch of texts, by numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_RANDOM = np.random.default_rng(20)
#: A random number for each byte, for two independent hashes.
_BYTES = _RANDOM.integers(1, 2**63, (2, 256), dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def _powers(which: int, inverse: bool, n: int) -> np.ndarray:
    """The first n powers of a base, or of its inverse, modulo 2 to the 64."""
    known = _POWERS.get((which, inverse))
    if known is None or len(known) < n:
        base = pow(_BASES[which], -1, 2**64) if inverse else _BASES[which]
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _POWERS[which, inverse] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of each hash spread over the whole number."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Runs:
    """Hashes of any run of a sequence of units, in constant time each."""

    def __init__(self, units: np.ndarray, which: int = 0):
        self.inverse = _powers(which, True, len(units) + 1)
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * _powers(which, False, len(units)), out=self.sums[1:])

    def hash(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])


def byte_units(buffer: np.ndarray, which: int = 0) -> np.ndarray:
    return _BYTES[which][buffer]


def bounds(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one buffer with a space between them, and where each starts and ends."""
    buffer = np.frombuffer(b" ".join(texts), np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1) - 1
    return buffer, ends - lengths, ends


def batches(texts: list[bytes], limit: int = 2_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``limit`` bytes, with the place of the first."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if held and size + len(text) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


def minimisers(
    units: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray, size: int, gram: int
) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows of ``size`` units that share a minimiser.

    ``units`` are two independent hashes of each unit, ``starts`` and ``ends``
    the texts' bounds.  Gives for each run its text, first window, number of
    windows, place of the minimiser, and two hashes: of the minimiser, and of
    all the run's units.  The least hash decides, then the leftmost place, so
    equal windows have their minimiser at the same place in them.
    """
    long = ends - starts >= size
    n = len(units[0])
    edge = np.zeros(n + 1, np.int8)
    edge[starts[long]] += 1
    edge[ends[long] - size + 1] -= 1
    windows = np.flatnonzero(np.cumsum(edge[:n], dtype=np.int8))
    if not len(windows):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    grams = Runs(units[0]).hash(slice(0, n - gram + 1), slice(gram, n + 1))
    low = np.uint64(32)
    least = (grams >> low << low) | np.arange(len(grams), dtype=np.uint64)
    span, width = 1, size - gram + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    places = (least[windows] & np.uint64(2**32 - 1)).astype(np.int64)
    new = np.flatnonzero((np.diff(places, prepend=-1) != 0) | (np.diff(windows, prepend=-2) != 1))
    first, place = windows[new], places[new]
    count = np.diff(np.append(new, len(windows)))
    whole = Runs(units[1], 1).hash(first, first + count - 1 + size)
    owner = np.searchsorted(starts, first, side="right") - 1
    return owner, first - starts[owner], count, place - first, grams[place], whole
