"""Suffix arrays by induced sorting, and permuted common prefixes, vectorised by bucket."""

from __future__ import annotations

import numpy as np

#: Reduced strings up to this length are sorted by doubling instead of by recursion.
SMALL = 1 << 13


def suffix_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; ``t`` ends with its only 0."""
    ends = np.append(np.flatnonzero(t[:-1] != t[1:]), len(t) - 1)
    smaller = np.append(t[ends[:-1]] < t[ends[:-1] + 1], True)
    return np.repeat(smaller, np.diff(ends, prepend=-1))


def _deal(sa, found, chars, at, step):
    """Write ``found`` behind the ends ``at`` of their buckets, in order."""
    order = np.argsort(chars, kind="stable")
    found, chars = found[order], chars[order]
    first = np.flatnonzero(np.append(True, chars[1:] != chars[:-1]))
    size = np.diff(first, append=len(chars))
    inside = np.arange(len(chars)) - np.repeat(first, size)
    which = chars[first]
    sa[np.repeat(at[which], size) + step * inside] = found
    at[which] += step * size


def induce(t: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, sigma: int) -> np.ndarray:
    """The suffix array that the leftmost-smaller suffixes ``seeds`` induce.
    Each bucket is read once upwards for the larger suffixes and once
    downwards for the smaller ones; what a bucket finds is dealt out at once."""
    n = len(t)
    count = np.bincount(t, minlength=sigma)
    stop = np.cumsum(count)
    start = stop - count
    larger = np.bincount(t[~smaller], minlength=sigma)
    sa = np.zeros(n, np.int32)
    buckets = np.flatnonzero(count)
    seed_at = np.searchsorted(t[seeds], np.arange(sigma + 1))
    # letter and type of each suffix in one number: one read per step. The
    # suffix before the first is the last, whose type is set so that it is never taken
    code = t.astype(np.int32) * 2 + smaller
    code[-1] = 1

    at = start.copy()
    for c in buckets.tolist():
        found, now = [], sa[start[c]: at[c]]
        while len(now):
            p = now - 1
            k = code[p]
            same = k == 2 * c
            found.append(p[(k & 1 == 0) & ~same])
            now = p[same]
            sa[at[c]: at[c] + len(now)] = now
            at[c] += len(now)
        p = seeds[seed_at[c]: seed_at[c + 1]] - 1
        found.append(p[p >= 0])
        p = np.concatenate(found)
        if len(p):
            _deal(sa, p, t[p], at, 1)

    code[-1] = 0
    at = stop - 1
    for c in buckets[::-1].tolist():
        found, now = [], sa[at[c] + 1: stop[c]][::-1]
        while len(now):
            p = now - 1
            k = code[p]
            same = k == 2 * c + 1
            found.append(p[(k & 1 == 1) & ~same])
            now = p[same]
            sa[at[c] - len(now) + 1: at[c] + 1] = now[::-1]
            at[c] -= len(now)
        p = sa[start[c]: start[c] + larger[c]][::-1] - 1
        found.append(p[code[p] & 1 == 1])
        p = np.concatenate(found)
        if len(p):
            _deal(sa, p, t[p], at, -1)
    sa[0] = n - 1
    return sa


def _names(t: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Rank of each leftmost-smaller substring, in the order ``ordered``; equal ones share a rank."""
    size = np.zeros(len(t), np.int32)
    size[lms] = np.diff(lms, append=len(t) - 1) + 1
    a, b = ordered[:-1], ordered[1:]
    differ = size[a] != size[b]
    live, k = np.flatnonzero(~differ), 0
    while len(live):
        same = t[a[live] + k] == t[b[live] + k]
        differ[live[~same]] = True
        k += 1
        live = live[same]
        live = live[size[a[live]] > k]
    return np.concatenate(([0], np.cumsum(differ)))


def _doubling(rank: np.ndarray) -> np.ndarray:
    """Suffix order of a short string of ranks."""
    n, k = len(rank), 1
    while True:
        second = np.full(n, -1, np.int64)
        second[: max(0, n - k)] = rank[k:]
        key = rank.astype(np.int64) * (n + 2) + second + 1
        order = np.argsort(key, kind="stable")
        ranks = np.concatenate(([0], np.cumsum(key[order][1:] != key[order][:-1])))
        if ranks[-1] == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = ranks
        k *= 2


def suffix_array(t: np.ndarray, sigma: int, small: int = SMALL) -> np.ndarray:
    """Suffix array of ``t`` (uint16, values below ``sigma``, the last its only 0)."""
    smaller = suffix_types(t)
    is_lms = np.zeros(len(t), bool)
    is_lms[1:] = smaller[1:] & ~smaller[:-1]
    if len(t) == 1:
        return np.zeros(1, np.int32)
    lms = np.flatnonzero(is_lms).astype(np.int32)
    # sort the leftmost-smaller substrings: induce from their first letters
    by_letter = lms[np.argsort(t[lms], kind="stable")]
    ordered = induce(t, smaller, by_letter, sigma)
    ordered = ordered[is_lms[ordered]]
    ranks = _names(t, lms, ordered)
    if ranks[-1] < len(lms) - 1:
        rank_at = np.zeros(len(t), np.int32)
        rank_at[ordered] = ranks
        reduced = rank_at[lms]
        base = int(np.ceil(np.sqrt(ranks[-1] + 1)))
        if len(reduced) <= small or 2 * len(reduced) + 1 > 0.95 * len(t):
            ordered = lms[_doubling(reduced)]
        else:
            # recursion: a rank as two digits keeps the buckets few, and the order as it is
            digits = np.zeros(2 * len(reduced) + 1, np.uint16)
            digits[0:-1:2] = reduced // base + 1
            digits[1:-1:2] = reduced % base + 1
            inner = suffix_array(digits, base + 1, small)
            inner = inner[(inner % 2 == 0) & (inner < 2 * len(reduced))]
            ordered = lms[inner // 2]
    return induce(t, smaller, ordered, sigma)


def common_prefixes(t: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Permuted common prefixes: at each position in ``order`` the length,
    counted in steps of 8 up to ``limit``, that it shares with the position
    before it in ``order``. 0 elsewhere. ``limit`` bytes must follow each position."""
    assert limit % 8 == 0
    words = np.zeros(len(t), np.uint64)
    for k in range(8):
        words[: len(t) - k] |= (t[k:].astype(np.uint64) & np.uint64(255)) << np.uint64(8 * k)
    out = np.zeros(len(t), np.int32)
    a, b = order[:-1], order[1:]
    for k in range(0, limit, 8):
        same = words[a + k] == words[b + k]
        a, b = a[same], b[same]
        if not len(a):
            break
        out[b] = k + 8
    return out
