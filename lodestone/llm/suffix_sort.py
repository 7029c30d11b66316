"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays."""

from __future__ import annotations

import numpy as np

#: Alphabets up to this size are induced bucket by bucket; larger ones come up only in the recursion.
BUCKETS = 2_048


def _types(s: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than their right neighbour; the last symbol is the smallest and unique."""
    ends = np.flatnonzero(np.r_[s[1:] != s[:-1], True])
    rising = np.r_[s[ends[:-1]] < s[ends[:-1] + 1], True]
    return np.repeat(rising, np.diff(np.r_[-1, ends]))


def _grouped(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A stable order by symbol, and the distinct symbols with their first places and counts."""
    order = np.argsort(symbols, kind="stable")
    held = symbols[order]
    first = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
    return order, held[first], first, np.diff(np.r_[first, len(held)])


def _induce(s: np.ndarray, small: np.ndarray, sizes: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The order of all suffixes that follows from the order of the leftmost-smaller ones ``lms``."""
    n, starts = len(s), np.r_[0, np.cumsum(sizes)]
    sa = np.full(n, -1, np.int64)
    order, symbols, first, counts = _grouped(s[lms])
    seeds = dict(zip(symbols.tolist(), zip(first.tolist(), (first + counts).tolist())))
    seeded = lms[order]

    def put(block: np.ndarray, places: np.ndarray, wanted: bool, step: int) -> None:
        before = block[block > 0] - 1
        before = before[small[before] == wanted]
        if before.size:
            order, symbols, first, counts = _grouped(s[before])
            at = np.repeat(places[symbols] - step * first, counts) + step * np.arange(len(before))
            sa[at] = before[order]
            places[symbols] += step * counts

    heads = starts[:-1].copy()
    for c in np.flatnonzero(sizes).tolist():
        done = int(starts[c])
        while done < heads[c]:
            upto = int(heads[c])
            put(sa[done:upto], heads, False, 1)
            done = upto
        if c in seeds:
            put(seeded[slice(*seeds[c])], heads, False, 1)
    tails = starts[1:] - 1
    tops = heads.copy()
    tails = tails.copy()
    for c in np.flatnonzero(sizes)[::-1].tolist():
        done = int(starts[c + 1]) - 1
        while done > tails[c]:
            upto = int(tails[c])
            put(sa[upto + 1 : done + 1][::-1], tails, True, -1)
            done = upto
        put(sa[int(starts[c]) : int(tops[c])][::-1], tails, True, -1)
    # The last symbol has no successor that could induce it.
    sa[0] = n - 1
    return sa


def _doubled(s: np.ndarray) -> np.ndarray:
    """Suffix array by doubling ranks, for reduced strings with too many symbols for buckets."""
    rank, width, n = np.unique(s, return_inverse=True)[1].astype(np.int64), 1, len(s)
    while True:
        key = rank * (n + 1) + np.r_[rank[width:] + 1, np.zeros(min(width, n), np.int64)]
        order = np.argsort(key, kind="stable")
        ranked = np.cumsum(np.r_[0, key[order][1:] != key[order][:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = ranked
        if ranked[-1] == n - 1:
            return order
        width *= 2


def _names(s: np.ndarray, sorted_lms: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Ranks of the sorted leftmost-smaller substrings; equal substrings share one."""
    a, b = sorted_lms[:-1], sorted_lms[1:]
    length = ends[a] - a
    same = length == ends[b] - b
    live = np.flatnonzero(same)
    step = 0
    while live.size:
        equal = s[a[live] + step] == s[b[live] + step]
        same[live[~equal]] = False
        live = live[equal]
        step += 1
        live = live[length[live] >= step]
    return np.r_[0, np.cumsum(~same)]


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Places of all suffixes of ``s`` in order; ``s`` ends with a 0 that occurs nowhere else.

    Suffixes are classified by their right neighbour. Inducing once from the leftmost
    smaller ones sorts their substrings; if substrings repeat, the string of their ranks
    is sorted recursively. From that order all suffixes are induced, bucket after bucket.
    """
    n = len(s)
    if n <= 2:
        return np.arange(n)[::-1].copy()
    sizes = np.bincount(s)
    if len(sizes) > BUCKETS:
        return _doubled(s)
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sa = _induce(s, small, sizes, lms)
    ordered = sa[is_lms[sa]]
    ends = np.empty(n, np.int64)
    ends[lms] = np.r_[lms[1:], n - 1]
    names = _names(s, ordered, ends)
    if names[-1] + 1 < len(lms):
        reduced = np.empty(n, np.int64)
        reduced[ordered] = names
        ordered = lms[suffix_array(reduced[lms])]
    return _induce(s, small, sizes, ordered)


def permuted_common_prefixes(s: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For every place, how far its suffix agrees with the one before it in order, up to ``most`` symbols.

    Only places whose left neighbours differ are compared; from each of them the value
    falls by one per place to the right.
    """
    n = len(s)
    phi = np.full(n, n - 1)
    phi[sa[1:]] = sa[:-1]
    padded = np.r_[s, np.full(most, -1, s.dtype)]
    left = np.where((np.arange(n) > 0) & (phi > 0), True, False)
    left[left] = s[np.flatnonzero(left) - 1] == s[phi[left] - 1]
    left[sa[0]] = False
    # A value held down to ``most`` no longer tells those to its right, so a chain restarts after ``most`` places.
    compared = np.flatnonzero(~left)
    values = np.zeros(n, np.int64)
    values[compared] = _agree(padded, compared, phi[compared], most)
    source = np.maximum.accumulate(np.where(left, 0, np.arange(n)))
    values = np.maximum(values[source] - (np.arange(n) - source), 0)
    cut = np.flatnonzero(left & (np.minimum(values[source], most) == most))
    values[cut] = _agree(padded, cut, phi[cut], most)
    values[sa[0]] = 0
    return values


def _agree(padded: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """How many symbols from ``a`` on equal those from ``b`` on, up to ``most``."""
    found = np.full(len(a), most)
    live = np.arange(len(a))
    for step in range(most):
        differ = padded[a[live] + step] != padded[b[live] + step]
        found[live[differ]] = step
        live = live[~differ]
        if not live.size:
            break
    return found
