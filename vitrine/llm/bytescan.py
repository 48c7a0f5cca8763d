"""Vectorised token hashes of byte buffers (numpy only)."""

from __future__ import annotations

import functools

import numpy as np

from vitrine.llm.common import row_groups

#: Odd multiplier of the polynomial hash (any odd number has an inverse mod 2**64), and of the final mix.
BASE = 0x9E3779B97F4A7C15
MIX = 0xD6E8FEB86659FD93
PIECE = 1 << 20


def _classes() -> np.ndarray:
    c = np.full(256, 2, np.uint8)  # 2: symbols
    c[128:] = 1  # 1: letters, digits, and bytes of other scripts
    for a, b in ((48, 58), (65, 91), (97, 123)):
        c[a:b] = 1
    c[[9, 10, 11, 12, 13, 32]] = 0  # 0: white space
    return c


CLASS = _classes()
#: Bytes with A-Z folded to a-z.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


@functools.lru_cache(maxsize=4)
def powers(n: int, base: int = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse, mod 2**64, for i < n."""
    inverse = pow(base, -1, 1 << 64)

    def row(x):
        p = np.full(n, x, np.uint64)
        p[0] = 1
        return np.multiply.accumulate(p)

    return row(base), row(inverse)


@functools.lru_cache(maxsize=4)
def byte_values(base: int = BASE) -> np.ndarray:
    """A random-looking 64-bit value for each byte."""
    v = np.arange(1, 257, dtype=np.uint64) * np.uint64(base)
    return mixed(v)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(MIX)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(MIX)
    return h ^ (h >> np.uint64(32))


def table_size(n: int) -> int:
    """n rounded up, so that few tables of powers are made."""
    return max(PIECE + 2, 1 << (n + 1).bit_length())


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each data[start:end], from one prefix sum."""
    up, down = powers(table_size(len(data)))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_values()[data] * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def token_spans(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = CLASS) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of one class (white space left
    out); no token crosses a row."""
    c = classes[data]
    edge = np.ones(len(c) + 1, bool)
    edge[1:-1] = c[1:] != c[:-1]
    edge[offsets] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    word = c[starts] > 0
    return starts[word], ends[word]


def _pieces(data, offsets, limit):
    """(first row, data, offsets) of at most about ``limit`` bytes; a longer
    row is cut where white space stands, so that no token is split."""
    for a, b in row_groups(offsets, limit):
        lo, hi = int(offsets[a]), int(offsets[b])
        if hi - lo <= limit:
            yield a, data[lo:hi], offsets[a: b + 1] - lo
            continue
        while hi - lo > limit:
            cut, step = 0, limit
            while not cut and lo + step < hi:
                spaces = np.flatnonzero(CLASS[data[lo + step - limit: lo + step]] == 0)
                cut, step = (lo + step - limit + int(spaces[-1]) + 1, step) if len(spaces) else (0, step + limit)
            cut = cut or hi
            yield a, data[lo:cut], np.array([0, cut - lo])
            lo = cut
        if hi > lo:
            yield a, data[lo:hi], np.array([0, hi - lo])


def token_hashes(data: np.ndarray, offsets: np.ndarray, limit: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every token of every row, in order; A-Z count as a-z."""
    hashes, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for first, part, off in _pieces(data, offsets, limit):
        if len(part):
            starts, ends = token_spans(part, off)
            hashes.append(span_hashes(FOLD[part], starts, ends))
            rows.append(first + np.searchsorted(off, starts, side="right") - 1)
    return np.concatenate(hashes), np.concatenate(rows)
