"""Prefix polynomial hashes modulo 2^64 over byte arrays, and what they give fast."""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15  # odd, so that powers can be undone
_tables: dict[str, np.ndarray] = {}


def _powers(name: str, base: int, size: int) -> np.ndarray:
    table = _tables.get(name)
    if table is None or len(table) < size:
        table = np.full(max(size, 1 << 16), base, dtype=np.uint64)
        table[0] = 1
        table = _tables[name] = np.cumprod(table, dtype=np.uint64)
    return table[:size]


def undo(size: int) -> np.ndarray:
    """Inverse powers: what brings a hash that starts at i back to 0."""
    return _powers("undo", pow(BASE, -1, 1 << 64), size)


def prefix_hashes(values: np.ndarray) -> np.ndarray:
    """H with H[j] - H[i] = hash of values[i:j] times BASE^i."""
    found = np.zeros(len(values) + 1, dtype=np.uint64)
    terms = (values.astype(np.uint64) + np.uint64(1)) * _powers("powers", BASE, len(values))
    np.cumsum(terms, out=found[1:])
    return found


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads a hash over all bits; one to one."""
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def common_extension(hashes: np.ndarray, back: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Bytes, up to ``most``, that the suffixes at a and b share: a binary search over prefix hashes."""
    low = np.zeros(len(a), dtype=np.int64)
    high = np.full(len(a), most, dtype=np.int64)
    ha, hb, ba, bb = hashes[a], hashes[b], back[a], back[b]
    size = high.copy()  # whole length first: equal suffixes need one look
    while True:
        same = (hashes[a + size] - ha) * ba == (hashes[b + size] - hb) * bb
        low = np.where(same, size, low)
        high = np.where(same, high, size - 1)
        if not (low < high).any():
            return low
        size = (low + high + 1) // 2


def suffix_order(
    values: np.ndarray, hashes: np.ndarray, back: np.ndarray, places: np.ndarray, segment: np.ndarray, most: int
) -> np.ndarray:
    """Order of the suffixes at ``places`` by their first ``most`` bytes inside each segment.

    ``segment`` is ascending. A bottom-up mergesort: every suffix finds its
    place in the neighbouring run by binary search, all runs of all segments
    at once; two suffixes are compared by their common extension.
    """
    count = len(places)
    order = np.arange(count)
    begins = np.flatnonzero(np.concatenate(([True], segment[1:] != segment[:-1])))
    sizes = np.diff(np.concatenate((begins, [count])))
    first, size = np.repeat(begins, sizes), np.repeat(sizes, sizes)
    width = 1
    while width < sizes.max():
        rows = np.flatnonzero(size > width)
        start, end = first[rows], first[rows] + size[rows]
        run = (rows - start) // width
        other = start + (run ^ 1) * width
        low, high = np.minimum(other, end), np.minimum(other + width, end)
        base = low.copy()
        item = places[order[rows]]
        right = (run & 1).astype(bool)
        todo = np.flatnonzero(low < high)
        while len(todo):
            middle = (low[todo] + high[todo]) // 2
            x, y = item[todo], places[order[middle]]
            shared = common_extension(hashes, back, x, y, most)
            at = np.minimum(shared, most - 1)
            # Equal suffixes: those of the left run stay in front.
            after = np.where(shared == most, right[todo], values[x + at] > values[y + at])
            low[todo] = np.where(after, middle + 1, low[todo])
            high[todo] = np.where(after, high[todo], middle)
            todo = todo[low[todo] < high[todo]]
        new = start + (run >> 1) * 2 * width + (rows - start) % width + (low - base)
        moved = order.copy()
        moved[new] = order[rows]
        order = moved
        width *= 2
    return order
