"""Shard Burrows-Wheeler transforms and their merge by iterative interleave refinement.

A shard's transform is built alone.  From then on only the transforms are read: last-to-first steps
count symbols in them, the strings' places come from walking those steps from each terminator, and
the merge orders all shards' suffixes by one symbol a round without comparing any two suffixes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The ranges of ``data`` one after another."""
    return data[ranges(start, size)]


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


@dataclass
class Transforms:
    """Shards' transforms one after another: the symbol before each row's suffix, whether there is none (a whole string), the row's shard."""

    symbol: np.ndarray
    whole: np.ndarray
    owner: np.ndarray
    strings: np.ndarray  # the strings' numbers, in the order of their terminators' rows

    def steps(self) -> np.ndarray:
        """The row of the suffix one symbol longer (a whole string's row: itself).

        In a shard the terminators' rows come first; after them, rows by the symbol before them and, for
        one symbol, in their own order: so a row's place is a count over its shard's transform.
        """
        n = len(self.symbol)
        inner = np.flatnonzero(~self.whole)
        order = inner[np.argsort(self.symbol[inner], kind="stable")]
        order = order[np.argsort(self.owner[order], kind="stable")]
        out = np.arange(n, dtype=np.int32)
        if n:
            shards = int(self.owner[-1]) + 1
            ends = np.bincount(self.owner, self.whole, shards).astype(np.int64)  # strings, so terminators, of each shard
            before = np.cumsum(ends)[self.owner[order]]  # terminators of this shard and those before
            out[order] = np.arange(len(order)) + before
        return out

    def places(self, step: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(string, offset) of each row's suffix, by walking from the terminators to the strings' starts."""
        n = len(self.symbol)
        string, offset = np.zeros(n, np.int32), np.full(n, -1, np.int32)
        if not n:
            return string, offset
        base = np.searchsorted(self.owner, np.arange(int(self.owner[-1]) + 2))
        ends = np.bincount(self.owner, self.whole, len(base) - 1).astype(np.int64)
        row = gather(np.arange(n), base[:-1], ends)
        own, at = self.strings, size[self.strings].astype(np.int32)
        while len(row):
            string[row], offset[row] = own, at
            on = ~self.whole[row] & (at > 0)
            row, own, at = step[row[on]], own[on], at[on] - 1
        return string, offset


def transforms(data: np.ndarray, size: np.ndarray, shard: np.ndarray) -> Transforms:
    """The transform of each shard's strings, sorted by itself; a terminator is less than any byte and that of an earlier string is the lesser.

    ``shard`` numbers the strings' shards 0, 1, ...; no number below the largest is left out.
    """
    by = np.lexsort((np.arange(len(size)), shard))
    n_of = (size + 1)[by]
    total = int(n_of.sum())
    string = np.repeat(by.astype(np.int32), n_of)
    offset = (np.arange(total) - np.repeat(np.cumsum(n_of) - n_of, n_of)).astype(np.int32)
    left = size.astype(np.int32)[string] - offset
    first = np.cumsum(size) - size  # of each string in data
    # each string with eight zeros after it, so that a word read past its end has zeros there
    apart = first + 8 * np.arange(len(size))
    flat = np.zeros(len(data) + 8 * len(size) + 8, np.uint8)
    flat[np.arange(len(data)) + np.repeat(apart - first, size)] = data
    eight = np.ascontiguousarray(np.lib.stride_tricks.as_strided(flat, (len(flat) - 7, 8), (1, 1))).view(">u8").ravel()
    place = apart[string] + offset

    def word(rows: np.ndarray, k: int) -> np.ndarray:
        """Eight bytes of each suffix from its byte k on, zeros after its end."""
        more = left[rows] > k
        return np.where(more, eight[place[rows] + np.where(more, k, 0)], 0).astype(np.uint64)

    head = eight[place].astype(np.uint64)
    head[left == 0] = 0
    owner = shard[string]
    order = np.empty(total, np.int64)
    bounds = np.searchsorted(owner, np.arange(int(owner[-1]) + 2)) if total else np.zeros(1, int)
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        order[lo:hi] = lo + np.argsort(head[lo:hi])
    h, o = head[order], owner
    same = np.zeros(total, bool)
    same[1:] = (h[1:] == h[:-1]) & (o[1:] == o[:-1])
    tied = same.copy()
    tied[:-1] |= same[1:]
    rows = order[tied]
    if len(rows):
        # only rows that share a shard and eight bytes need their other bytes; then shorter first
        keys = [string[rows], left[rows], *[word(rows, k) for k in range((int(size.max()) - 1) // 8 * 8, 0, -8)], head[rows], owner[rows]]
        order[tied] = rows[np.lexsort(keys)]
    return Transforms(flat[np.maximum(place[order] - 1, 0)], offset[order] == 0, owner, by)


def merge(shards: Transforms, size: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, interval) of suffixes whose first ``depth`` bytes occur more than once.

    The interleave starts as the shards one after another, all in one interval of common prefix 0.
    Each round sorts it stably by the symbol before each suffix and steps to the longer suffix, which
    orders the merge by one byte more; intervals split where symbol or interval differ, so the round's
    number is the common prefix within an interval, and less is common across its borders: the
    intervals after round ``depth`` are those of the longest common prefixes of ``depth`` or more.  A
    suffix alone in its interval stays alone, and is left out from then on.
    """
    step = shards.steps()
    string, offset = shards.places(step, size)
    rows = np.flatnonzero(offset >= depth).astype(np.int32)  # each repeated string ends before one of these
    block = np.zeros(len(rows), np.int32)
    for _ in range(depth):
        if not len(rows):
            break
        symbol = shards.symbol[rows]
        order = np.argsort(symbol, kind="stable")
        rows, block, symbol = rows[order], block[order], symbol[order]
        new = np.ones(len(rows) + 1, bool)
        new[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        shared = ~(new[:-1] & new[1:])
        rows = step[rows[shared]]
        block = np.cumsum(new[:-1][shared], dtype=np.int32)
    return string[rows], offset[rows], block
