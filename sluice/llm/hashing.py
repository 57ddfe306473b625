"""Words of texts and their hashes, over byte buffers in numpy."""

from __future__ import annotations

import numpy as np

from sluice.llm.common import Slice

_rng = np.random.default_rng(20240229)
_BYTES = _rng.integers(1, 1 << 63, 256, np.uint64)
#: The same with A-Z as a-z.
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_GAP = np.zeros(256, bool)
_GAP[[9, 10, 11, 12, 13, 32]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base and its inverse raised to 0 .. n - 1, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 21)
        rows = [np.full(size, base, np.uint64) for base in (_BASE, _INVERSE)]
        for row in rows:
            row[0] = 1
            np.cumprod(row, out=row)
        _powers[:] = rows
    return _powers[0][:n], _powers[1][:n]


def sums(data: np.ndarray, fold: bool) -> np.ndarray:
    """Running polynomial sums: ``sums[i]`` covers ``data[:i]``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _BYTES)[data] * powers(len(data))[0], out=out[1:])
    return out


def hashes(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ``data[starts:ends]``, equal for equal bytes wherever they stand."""
    return mix((running[ends] - running[starts]) * powers(len(running))[1][starts])


def words(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``part``, and per row the number of the first word at or after its start."""
    gap = np.ones(len(part.data) + 2, bool)
    gap[1:-1] = _GAP[part.data]
    starts = np.flatnonzero(gap[:-2] & ~gap[1:-1])
    ends = np.flatnonzero(~gap[1:-1] & gap[2:]) + 1
    return starts, ends, np.searchsorted(starts, np.append(part.starts, len(part.data)))
