"""The agenda of byte-pair merging, for many short symbol strings at once.

Of a string's adjacent pairs that have a merge, the one of best score goes
first, the leftmost of equals; the merged symbol makes new pairs with its
neighbours.  Strings are independent, so a round takes the best pair of every
string together.  Strings longer than ``WIDE`` symbols use a heap, one by one.
"""

from __future__ import annotations

import heapq

import numpy as np

WIDE = 48
NONE = np.float32(-np.inf)


class PairTable:
    """(left, right) -> (merged symbol, score), symbols below ``n``."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, float]], n: int):
        self.pairs, self.n = pairs, n
        keys = np.array([a * n + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.merged = np.array([m for m, _ in pairs.values()], np.int64)[order]
        self.score = np.array([s for _, s in pairs.values()], np.float32)[order]

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged symbols and scores; negative symbols never merge."""
        key = left * self.n + right
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        ok = (left >= 0) & (right >= 0)
        if len(self.keys):
            ok &= self.keys[at] == key
            return np.where(ok, self.merged[at], -1), np.where(ok, self.score[at], NONE)
        return np.full(key.shape, -1), np.full(key.shape, NONE, np.float32)


def merge_one(symbols: list[int], table: PairTable) -> list[int]:
    """The agenda as a heap; for long strings."""
    n = len(symbols)
    sym, before, after = list(symbols), list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[float, int, int, int]] = []

    def offer(i: int, j: int) -> None:
        if i >= 0 and j >= 0 and (hit := table.pairs.get((sym[i], sym[j]))):
            heapq.heappush(heap, (-hit[1], i, sym[i], sym[j]))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if sym[i] != a or j < 0 or sym[j] != b:
            continue  # one of the two was merged meanwhile
        sym[i] = table.pairs[(a, b)][0]
        sym[j] = -2
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(before[i], i)
        offer(i, after[i])
    out, i = [], 0
    while i >= 0 and n:
        out.append(sym[i])
        i = after[i]
    return out


def _merge_block(sym: np.ndarray, size: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge the rows of a matrix whose last column is free (-1), as is all
    behind a row's ``size`` symbols."""
    out, out_size = sym.copy(), size.copy()
    width = sym.shape[1] - 1
    row, here, columns = np.arange(len(sym)), np.arange(len(sym)), np.arange(width)
    merged, score = table.look_up(sym[:, :-1], sym[:, 1:])
    while len(row):
        best = score.argmax(1)
        more = score[here, best] > NONE
        if not more.all():  # finished strings leave the block
            out[row[~more]], out_size[row[~more]] = sym[~more], size[~more]
            row, sym, size, best = row[more], sym[more], size[more], best[more]
            merged, score, here = merged[more], score[more], np.arange(len(row))
        sym[here, best] = merged[here, best]
        behind = columns > best[:, None]
        sym[:, :-1] = np.where(behind, sym[:, 1:], sym[:, :-1])
        behind = behind[:, :-1]
        merged[:, :-1] = np.where(behind, merged[:, 1:], merged[:, :-1])
        score[:, :-1] = np.where(behind, score[:, 1:], score[:, :-1])
        score[:, -1] = NONE
        for at in (np.maximum(best - 1, 0), best):
            merged[here, at], score[here, at] = table.look_up(sym[here, at], sym[here, at + 1])
        size -= 1
    return out, out_size


def merge_all(flat: np.ndarray, size: np.ndarray, table: PairTable,
              block: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Merge many strings, given end to end with their sizes, and so returned.

    Equal to ``merge_one`` on each string."""
    start = np.cumsum(size) - size
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, their symbols end to end, sizes
    order = np.argsort(size, kind="stable")
    order = order[size[order] <= WIDE]
    for at in range(0, len(order), block):
        rows = order[at:at + block]
        n = size[rows]
        inside = np.arange(n.max() + 1) < n[:, None]
        sym = np.full(inside.shape, -1, np.int64)
        sym[inside] = flat[(start[rows][:, None] + np.arange(inside.shape[1]))[inside]]
        sym, n = _merge_block(sym, n, table)
        out.append((rows, sym[np.arange(sym.shape[1]) < n[:, None]], n))
    for i in np.flatnonzero(size > WIDE):
        one = np.array(merge_one(flat[start[i]:start[i] + size[i]].tolist(), table), np.int64)
        out.append((np.array([i]), one, np.array([len(one)])))
    if not out:
        return flat[:0], size
    new_size = np.empty(len(size), np.int64)
    for rows, _, n in out:
        new_size[rows] = n
    new_start = np.cumsum(new_size) - new_size
    result = np.empty(int(new_size.sum()), np.int64)
    for rows, sym, n in out:
        within = np.arange(len(sym)) - np.repeat(np.cumsum(n) - n, n)
        result[np.repeat(new_start[rows], n) + within] = sym
    return result, new_size
