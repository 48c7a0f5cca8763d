"""Anchors: positions chosen by content, so that equal long strings hold equal anchors."""

from __future__ import annotations

import numpy as np

from vitrine.llm.bytescan import byte_values, mixed, powers, table_size

#: Bytes of an anchor.
GRAM = 32


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) of each ``width`` neighbours, by doubling."""
    have = 1
    while 2 * have <= width:
        x = pick(x[:-have], x[have:])
        have *= 2
    return pick(x[: len(x) - (width - have)], x[width - have:]) if width > have else x


def _orders(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each gram, its order, least order of each string of ``length`` bytes)."""
    n = len(data)
    up, down = powers(table_size(n))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(byte_values()[data] * up[:n], out=sums[1:])
    h = mixed((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    order = (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1)  # never 0
    return h, order, _slide(order, length - gram + 1, np.minimum)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchors of rows laid end to end.

    Of the grams inside each string of ``length`` bytes, the one of least
    order is an anchor; where one hash repeats in a row, one of them stays in each string. Two
    equal strings of ``length`` bytes therefore both hold an anchor of the same hash."""
    n, width = len(data), length - gram + 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, order, least = _orders(data, length, gram)
    row_end = np.repeat(offsets[1:], np.diff(offsets))[: n - length + 1]
    least[np.arange(n - length + 1) + length > row_end] = 0  # strings over two rows choose nothing
    edge = np.zeros(width - 1, np.uint32)
    chosen = np.flatnonzero(_slide(np.concatenate((edge, least, edge)), width, np.maximum) == order)
    return _thin(chosen, h[chosen], width)


def reach(data: np.ndarray, at: np.ndarray, length: int, gram: int = GRAM) -> tuple[list[int], list[int]]:
    """Start and end of each anchor's context in one text: the strings of
    ``length`` bytes that hold the anchor and no gram of lesser order."""
    _, order, least = _orders(data, length, gram)
    width = length - gram + 1
    first = np.flatnonzero(np.append(True, least[1:] != least[:-1]))
    last = np.append(first[1:], len(least)) - 1
    # runs of strings by their least order: an anchor's strings lie in one run, found by order and last start
    code = least[first].astype(np.uint64) << np.uint64(32) | last.astype(np.uint64)
    by = np.argsort(code, kind="stable")
    low = np.maximum(at - width + 1, 0)
    run = by[np.minimum(np.searchsorted(code[by], order[at].astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)), len(by) - 1)]
    start, stop = np.maximum(first[run], low), np.minimum(last[run], at) + length
    return start.tolist(), stop.tolist()


def _thin(at: np.ndarray, h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of neighbours with the same hash, drops each whose neighbours in the
    same run of hashes lie close enough for every string to hold one."""
    same = h[1:] == h[:-1]
    if not same.any():
        return at, h
    keep = np.ones(len(at), bool)
    last = 0
    for i in range(1, len(at) - 1):
        if same[i - 1] and same[i] and at[i + 1] - at[last] <= width:
            keep[i] = False
        else:
            last = i
    return at[keep], h[keep]
