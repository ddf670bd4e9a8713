"""Anchors of long byte strings: equal strings of ``span`` bytes have the same anchor at the same place."""

from __future__ import annotations

import numpy as np

GRAM = 24
PIECE = 1 << 15  # places at a time, so that their arrays stay in a core's cache
PLACE = np.uint64((1 << 24) - 1)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 24 bytes from each place that has them."""
    n = max(0, len(data) - GRAM + 1)
    out = np.empty(n, np.uint64)
    for lo in range(0, n, PIECE):
        _hashes(data[lo : lo + PIECE + GRAM - 1], out[lo : lo + PIECE])
    return out


def _hashes(data: np.ndarray, a: np.ndarray) -> None:
    n = len(a)
    eight = np.ascontiguousarray(np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))).view(np.uint64).ravel()
    np.multiply(eight[:n], np.uint64(0x9E3779B97F4A7C15), out=a)
    b = eight[8 : 8 + n] * np.uint64(0xC2B2AE3D27D4EB4F)
    a ^= b
    np.right_shift(a, np.uint64(31), out=b)
    a ^= b
    np.multiply(eight[16 : 16 + n], np.uint64(0x165667B19E3779F9), out=b)
    a += b
    np.right_shift(a, np.uint64(32), out=b)
    a ^= b
    a *= np.uint64(0xBF58476D1CE4E5B9)
    np.right_shift(a, np.uint64(29), out=b)
    a ^= b


def least_places(h: np.ndarray, w: int) -> np.ndarray:
    """The place of the least of each w neighbours (by its high 40 bits; the first of equals)."""
    n = len(h) - w + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    return np.concatenate([np.int32(s) + _least(h[s : s + PIECE + w - 1], w) for s in range(0, n, PIECE)])


def _least(h: np.ndarray, w: int) -> np.ndarray:
    """By prefix and suffix minima of blocks of w; the low bits of a key hold the place."""
    n, blocks = len(h) - w + 1, -(-len(h) // w)
    grid = np.full(blocks * w, np.uint64(0xFFFFFFFFFFFFFFFF))
    grid[: len(h)] = (h & ~PLACE) | np.arange(len(h), dtype=np.uint64)
    grid = grid.reshape(blocks, w)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(after[:n], before[w - 1 : w - 1 + n]) & PLACE).astype(np.int32)


def anchored(data: np.ndarray, offs: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, text, first start, starts) of each run of ``span``-byte strings with one anchor."""
    h = gram_hashes(data)
    place = least_places(h, span - GRAM + 1)
    starts = np.maximum(0, np.diff(offs) - span + 1)  # strings of each text
    text = np.repeat(np.arange(len(starts), dtype=np.int32), starts)
    s = np.arange(len(text), dtype=np.int32) + np.repeat((offs[:-1] - (np.cumsum(starts) - starts)).astype(np.int32), starts)
    at = place[s]
    new = np.ones(len(s), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    return h[at[first]], text[first].astype(np.int64), s[first].astype(np.int64), np.diff(np.r_[first, len(s)])
