"""Hashes of words and of sliding windows, computed on arrays for many texts at once.

A window's hash is a difference of two prefix sums of random values times powers of an odd number, modulo
2^64, brought back to the window's start and mixed. Long inputs are worked through in blocks.
"""

from __future__ import annotations

import numpy as np

from tabwright.llm.common import by_value

by_value(__name__)

BLOCK = 1 << 18
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS: dict = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number that follows from the seed, and of its inverse."""
    if len(_POWERS.get(seed, ((),))[0]) < n:
        base = int(np.random.default_rng(seed).integers(1 << 62, 1 << 63)) * 2 + 1
        size = max(n, BLOCK + 2)
        both = []
        for b in (base % 2**64, pow(base, -1, 2**64)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps, dtype=np.uint64))
        _POWERS[seed] = tuple(both)
    return _POWERS[seed]


def _sums(values: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values times powers, with a leading zero, and the inverse powers."""
    up, down = _powers(seed, len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return total, down


def windows(values: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of every window of `width` consecutive 64-bit values (none if there are fewer)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    for lo in range(0, n, BLOCK):
        hi = min(n, lo + BLOCK)
        sums, down = _sums(values[lo : hi + width - 1], seed)
        out[lo:hi] = mix((sums[width:] - sums[:-width]) * down[: hi - lo])
    return out


def spans(sums: np.ndarray, down: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of arbitrary ranges, from the prefix sums of one block (`byte_sums`)."""
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def byte_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def byte_sums(data: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    return _sums(byte_table(seed)[data], seed + 1)


def words(data: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of every word of the bytes: runs between the six ASCII white space bytes."""
    space = SPACE[data]
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    out = np.empty(len(starts), dtype=np.uint64)
    table = byte_table(seed)
    lo = 0
    while lo < len(starts):
        # as many words as a block holds, one at least
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK)))
        first = starts[lo]
        sums, down = _sums(table[data[first : ends[hi - 1]]], seed + 1)
        s, e = starts[lo:hi] - first, ends[lo:hi] - first
        out[lo:hi] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        lo = hi
    return out, starts, ends


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts as one array with a line feed after each, and where each begins (one more entry at the end)."""
    data = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return data, begins


def first_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of `width` values the position of its smallest value, the leftmost among equals.

    Values are compared by their upper 40 bits; the lower bits of a key hold the position. Minima of blocks,
    running from the left and from the right, meet in every window.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    out = np.empty(n, dtype=np.int64)
    low = np.uint64((1 << 24) - 1)
    step = max(BLOCK, 4 * width)
    for lo in range(0, n, step):
        hi = min(n, lo + step)
        size = hi - lo + width - 1
        padded = np.full(-(-size // width) * width, ~np.uint64(0), dtype=np.uint64)
        padded[:size] = (values[lo : lo + size] & ~low) | np.arange(size, dtype=np.uint64)
        blocks = padded.reshape(-1, width)
        from_left = np.minimum.accumulate(blocks, axis=1).ravel()
        from_right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        best = np.minimum(from_right[: hi - lo], from_left[width - 1 : size])
        out[lo:hi] = (best & low).astype(np.int64) + lo
    return out
