"""Simple-8b word-aligned coding of non-negative integers, encoded and decoded by whole arrays.

A 64-bit word holds a selector in its top four bits and a run of values of one width below. Runs never cross blocks of
``BLOCK`` values, so any block decodes by itself from its word offset. Values too wide for 60 bits escape: their word
holds an index into a table of wide values.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
#: Fixed values of the code: values per word and bits per value, by selector. Selector 0 is the escape.
COUNTS = np.array([1, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 240])
BITS = np.array([64, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0])
PAD = int(COUNTS.max())
PAYLOAD = np.uint64((1 << 60) - 1)


def widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value."""
    out = np.zeros(values.shape, np.uint8)
    top = int(values.max(initial=0)).bit_length()
    for b in range(top):
        out += values >= np.uint64(1 << b)
    return out


def encode(values: np.ndarray, wide_base: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, words per block, and wide values; a wide value's word holds ``wide_base`` plus its index."""
    blocks = -(-len(values) // BLOCK)
    if not blocks:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.uint64)
    line = BLOCK + PAD
    grid = np.zeros((blocks, line), np.uint64)
    full = np.zeros(blocks * BLOCK, np.uint64)
    full[:len(values)] = values
    grid[:, :BLOCK] = full.reshape(blocks, BLOCK)
    width = widths(grid).reshape(-1)
    # The widest of the next n values, for growing n; the densest selector that fits is the number of those that fit.
    most, have = {1: width}, 1
    sel = (width <= BITS[1]).astype(np.uint8)
    for k in range(2, 16):
        n, step = int(COUNTS[k]), None
        most_n = most[have]
        while have < n:
            step = min(have, n - have)
            longer = most_n.copy()
            longer[:-step] = np.maximum(most_n[:-step], most_n[step:])
            most_n, have = longer, have + step
        most = {have: most_n}
        sel += most_n <= BITS[k]
    sel = sel.reshape(blocks, line)
    size = np.full(blocks, BLOCK)
    size[-1] = len(values) - (blocks - 1) * BLOCK
    mark = np.zeros((blocks, BLOCK), bool)
    row, at = np.arange(blocks), np.zeros(blocks, np.int64)
    while len(row):
        mark[row, at] = True
        at = at + COUNTS[sel[row, at]]
        go = at < size[row]
        row, at = row[go], at[go]
    row, at = np.nonzero(mark)
    start, chosen = row * line + at, sel[row, at]
    flat, out = grid.reshape(-1), np.zeros(len(start), np.uint64)
    wide = np.empty(0, np.uint64)
    for k in np.unique(chosen):
        here = np.flatnonzero(chosen == k)
        if k == 0:
            wide = flat[start[here]]
            out[here] = np.arange(len(here), dtype=np.uint64) + np.uint64(wide_base)
            continue
        word = np.zeros(len(here), np.uint64)
        if BITS[k]:
            for j in range(COUNTS[k]):
                word |= flat[start[here] + j] << np.uint64(j * BITS[k])
        out[here] = word | np.uint64(int(k) << 60)
    return out, mark.sum(1), wide


def decode(words: np.ndarray, per_block: np.ndarray, count: int, wide: np.ndarray) -> np.ndarray:
    """The ``count`` values of consecutive blocks, all but the last of them full."""
    blocks = len(per_block)
    if not blocks:
        return np.empty(0, np.uint64)
    line = BLOCK + PAD
    sel = (words >> np.uint64(60)).astype(np.int64)
    many = COUNTS[sel]
    before = np.cumsum(many) - many
    block = np.repeat(np.arange(blocks), per_block)
    first = np.cumsum(per_block) - per_block
    start = before - before[first][block] + block * line
    out = np.zeros(blocks * line, np.uint64)
    for k in np.unique(sel):
        here = np.flatnonzero(sel == k)
        if k == 0:
            out[start[here]] = wide[(words[here] & PAYLOAD).astype(np.int64)]
        elif BITS[k]:
            mask = np.uint64((1 << int(BITS[k])) - 1)
            for j in range(COUNTS[k]):
                out[start[here] + j] = words[here] >> np.uint64(j * BITS[k]) & mask
    return out.reshape(blocks, line)[:, :BLOCK].reshape(-1)[:count]
