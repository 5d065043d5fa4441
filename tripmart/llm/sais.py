"""Suffix arrays by induced sorting, and permuted common prefixes, on numpy arrays.

Suffixes are classified as smaller or larger than their right neighbour. The
substrings between leftmost-smaller positions are sorted by one round of
inducing, named, and their order is found by recursion if names repeat; a
second round induces the order of all suffixes in linear time. A round handles
whole stretches of a bucket at once, which pays for small alphabets; a reduced
text with more names than that ends the recursion and is sorted by doubling.
"""

from __future__ import annotations

import numpy as np

#: Largest alphabet whose buckets are worth a vectorised step each.
SMALL = 512


def classify(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its right neighbour; the last one is."""
    n = len(text)
    smaller = np.zeros(n, bool)
    smaller[-1] = True
    if n > 1:
        rises, same = text[:-1] < text[1:], text[:-1] == text[1:]
        # An equal neighbour passes its own type on: take the next unequal place.
        place = np.where(same, n, np.arange(n - 1))
        place = np.minimum.accumulate(place[::-1])[::-1]
        smaller[:-1] = np.where(place < n, rises[np.minimum(place, n - 2)], True)
    return smaller


def leftmost(smaller: np.ndarray) -> np.ndarray:
    return np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1


def _grouped(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by symbol, the sorted symbols and each one's number in its group."""
    order = np.argsort(symbols, kind="stable")
    own = symbols[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    rank = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
    return order, own, rank


def _induce(text, smaller, starts, ends, seeds, small: int):
    """Order of all suffixes induced from the given order of leftmost-smaller ones."""
    n = len(text)
    text = text.astype(np.uint16)  # short symbols are sorted by radix
    suffixes = np.full(n, -1, np.int64)
    count = np.bincount(text[seeds], minlength=small)
    if len(seeds):
        order, own, rank = _grouped(text[seeds])
        suffixes[ends[own] - count[own] + rank] = seeds[order]

    head = starts.copy()

    def put_larger(batch):
        before = batch - 1
        before = before[before >= 0]
        before = before[~smaller[before]]
        if len(before):
            order, own, rank = _grouped(text[before])
            suffixes[head[own] + rank] = before[order]
            head[:] += np.bincount(own, minlength=small)

    for c in range(small):
        at = starts[c]
        while at < head[c]:
            at, batch = head[c], suffixes[at : head[c]].copy()
            put_larger(batch)
        if count[c]:
            put_larger(suffixes[ends[c] - count[c] : ends[c]].copy())

    tail = ends.copy()

    def put_smaller(batch):
        before = batch[::-1] - 1
        before = before[before >= 0]
        before = before[smaller[before]]
        if len(before):
            order, own, rank = _grouped(text[before])
            suffixes[tail[own] - 1 - rank] = before[order]
            tail[:] -= np.bincount(own, minlength=small)

    # The last suffix has no right neighbour that could induce it.
    last = text[n - 1]
    for c in range(small - 1, -1, -1):
        if c == last:
            tail[c] -= 1
            suffixes[tail[c]] = n - 1
            at = tail[c] + 1
            put_smaller(suffixes[tail[c] : at].copy())
            at = at - 1
        else:
            at = ends[c]
        while at > tail[c]:
            at, batch = tail[c], suffixes[tail[c] : at].copy()
            put_smaller(batch)
        if head[c] > starts[c]:
            put_smaller(suffixes[starts[c] : head[c]].copy())
    return suffixes


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffix array by ranks of doubled length; only ranks that are still shared are sorted again."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    rank = np.zeros(n, np.int64)
    own = names[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    rank[order] = np.repeat(first, np.diff(np.r_[first, n]))
    length = 1
    while True:
        size = np.diff(np.r_[np.flatnonzero(np.r_[True, np.diff(rank[order]) > 0]), n])
        shared = np.flatnonzero(np.repeat(size, size) > 1)
        if not len(shared):
            return order
        at = order[shared]
        following = np.where(at + length < n, rank[np.minimum(at + length, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + following
        sort = np.argsort(key, kind="stable")
        at, key = at[sort], key[sort]
        order[shared] = at
        # The rank is the place of the first of equal ones.
        new = np.r_[True, key[1:] != key[:-1]]
        rank[at] = shared[np.flatnonzero(new)][np.cumsum(new) - 1]
        length *= 2


def _names(text, found, order) -> tuple[np.ndarray, int]:
    """Numbers of the leftmost-smaller substrings in their sorted order; equal ones share one."""
    n = len(text)
    following = np.full(n + 1, n - 1, np.int64)
    following[found[:-1]] = found[1:]
    a, b = order[:-1], order[1:]
    length = following[b] - b
    same = following[a] - a == length
    alive = np.flatnonzero(same)
    step = 0
    while len(alive):
        equal = text[a[alive] + step] == text[b[alive] + step]
        same[alive[~equal]] = False
        alive = alive[equal]
        step += 1
        alive = alive[length[alive] >= step]
    names = np.zeros(len(order), np.int64)
    names[1:] = np.cumsum(~same)
    return names, int(names[-1]) + 1


def suffix_array(text: np.ndarray, small: int) -> np.ndarray:
    """Suffix array of symbols below ``small``; the last one has to be the single 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    if small > SMALL:
        return _by_doubling(text)
    smaller = classify(text)
    found = leftmost(smaller)
    sizes = np.bincount(text, minlength=small)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    rough = _induce(text, smaller, starts, ends, found, small)
    marked = np.zeros(n, bool)
    marked[found] = True
    order = rough[marked[rough]]
    names, count = _names(text, found, order)
    if count < len(order):
        reduced = np.zeros(n, np.int64)
        reduced[order] = names
        reduced = reduced[found]
        order = found[suffix_array(reduced, count)]
    return _induce(text, smaller, starts, ends, order, small)


def common_prefixes(text: np.ndarray, suffixes: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each position's suffix with the one sorted before it, cut at ``most``.

    Permuted order: entry i belongs to position i, found for all positions at
    once by comparing ever later symbols of those that still agree.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[suffixes[1:]] = suffixes[:-1]
    out = np.zeros(n, np.int64)
    alive = np.flatnonzero(before >= 0)
    for symbols in (4, 1):
        if symbols == 4 and (most < 4 or text.max(initial=0) > 0xFFFF):
            continue
        # Four symbols at a time in one word, then what is left one by one. The
        # end compares unequal to everything, so nothing runs past it.
        own = np.r_[text, np.zeros(symbols - 1, text.dtype)].astype(np.uint64)
        word = sum(own[j : n + j] << np.uint64(16 * j) for j in range(symbols))
        todo, other, at = alive, before[alive], out[alive]
        for _ in range(most // symbols):
            fits = (todo + at + symbols <= n) & (other + at + symbols <= n) & (at + symbols <= most)
            todo, other, at = todo[fits], other[fits], at[fits]
            equal = word[todo + at] == word[other + at]
            todo, other, at = todo[equal], other[equal], at[equal] + symbols
            if not len(todo):
                break
            out[todo] = at
    return out
