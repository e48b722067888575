"""Suffix arrays by induced sorting, in whole-array steps, and permuted common prefixes."""

from __future__ import annotations

import numpy as np


def _next_set(mask_of, start: int, size: int, step: int) -> int:
    """First index from ``start`` on (in direction ``step``) for which ``mask_of`` holds; ``size`` or -1 if none."""
    width = 256
    while 0 <= start < size:
        if step > 0:
            part = mask_of(start, min(size, start + width))
        else:
            part = mask_of(max(0, start - width + 1), start + 1)[::-1]
        at = int(part.argmax())
        if part[at]:
            return start + step * at
        start += step * len(part)
        width *= 2
    return size if step > 0 else -1


def _place(sa: np.ndarray, at: np.ndarray, items: np.ndarray, letters: np.ndarray, step: int) -> None:
    """Write ``items`` to the buckets of ``letters`` in order, moving the bucket pointers ``at`` by ``step``."""
    order = np.argsort(letters, kind="stable")
    items, letters = items[order], letters[order]
    first = np.flatnonzero(np.concatenate([[True], letters[1:] != letters[:-1]]))
    counts = np.diff(np.append(first, len(letters)))
    rank = np.arange(len(letters)) - np.repeat(first, counts)
    sa[at[letters] + step * rank] = items
    at[letters[first]] += step * counts


def _induce(text: np.ndarray, small: np.ndarray, lms: np.ndarray, starts: np.ndarray, ends: np.ndarray, larger: np.ndarray) -> np.ndarray:
    """The suffix array that the given order of leftmost-smaller suffixes induces.

    ``larger`` counts the L-type suffixes of each bucket, which fill its front. A sweep takes all entries up to the first slot
    still empty at once: what they induce lies behind them.
    """
    n = len(text)
    sa = np.full(n, -1, np.int32)
    tails = ends - 1
    _place(sa, tails, lms[::-1], text[lms[::-1]], -1)
    front = np.zeros(n + 1, np.int32)
    np.add.at(front, starts, 1)
    np.add.at(front, starts + larger, -1)
    front = np.cumsum(front[:-1]) > 0
    heads, p = starts.copy(), 0
    while p < n:
        q = _next_set(lambda a, b: front[a:b] & (sa[a:b] < 0), p, n, 1)
        if q == p:
            raise AssertionError("a bucket slot was never induced")
        block = sa[p:q]
        before = block[block > 0] - 1
        before = before[~small[before]]
        if len(before):
            _place(sa, heads, before, text[before], 1)
        p = q
    sa[1:][~front[1:]] = -1
    tails, p = ends - 1, n - 1
    while p >= 0:
        q = _next_set(lambda a, b: sa[a:b] < 0, p, n, -1)
        block = sa[q + 1 : p + 1][::-1]
        before = block[block > 0] - 1
        before = before[small[before]]
        if len(before):
            _place(sa, tails, before, text[before], -1)
        if q == p:
            raise AssertionError("a bucket slot was never induced")
        p = q
    return sa


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``names``, of which a prefix is the smaller one, by doubling the length they are compared by.

    Induction would need a sweep for nearly every few names, as there are many different ones; here a round is a sort, and
    only suffixes that are not told apart yet take part.
    """
    n = len(names)
    order = np.argsort(names, kind="stable")
    rank = np.zeros(n + 1, np.int64)  # first slot of the suffixes that are equal so far, from 1; 0 is behind the end
    slots, sorted_by, size = np.arange(n), names[order], 1
    while True:
        new = np.ones(len(slots) + 1, bool)
        new[1:-1] = sorted_by[1:] != sorted_by[:-1]
        first = np.maximum.accumulate(np.where(new[:-1], np.arange(len(slots)), 0))
        rank[order[slots]] = slots[first] + 1
        slots = slots[~(new[:-1] & new[1:])]
        if not len(slots):
            return order
        at = order[slots]
        sorted_by = rank[at] * (n + 1) + rank[np.minimum(at + size, n)]
        turn = np.argsort(sorted_by)
        order[slots], sorted_by = at[turn], sorted_by[turn]
        size *= 2


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of ``text``, whose last symbol is its only 0 and its least.

    Suffixes are classified as smaller or larger than their successor; the substrings between leftmost-smaller
    positions are sorted by one induction and named; if names repeat, :func:`_sorted_names` sorts the suffixes of the names; a second
    induction gives the array.
    """
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int32)
    step = np.sign(text[1:].astype(np.int64) - text[:-1].astype(np.int64))
    change = np.where(step != 0, np.arange(n - 1), n)
    change = np.minimum.accumulate(change[::-1])[::-1]
    small = np.ones(n, bool)
    small[:-1] = step[np.minimum(change, n - 2)] > 0
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(np.int32)
    counts = np.bincount(text)
    ends = np.cumsum(counts)
    starts = ends - counts
    larger = np.bincount(text[~small], minlength=len(counts))
    if len(lms) > 1:
        rough = _induce(text, small, lms, starts, ends, larger)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        order = rough[is_lms[rough]]
        # Length of the substring from each leftmost-smaller position to the next one, both included.
        length = np.zeros(n, np.int64)
        length[lms] = np.diff(np.append(lms, n - 1)) + 1
        a, b = order[:-1].astype(np.int64), order[1:].astype(np.int64)
        same = (length[a] == length[b]) & (length[a] > 1)
        at = np.flatnonzero(same)
        if len(at):
            sizes = length[a[at]]
            offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            equal = text[np.repeat(a[at], sizes) + offset] == text[np.repeat(b[at], sizes) + offset]
            same[at] = np.logical_and.reduceat(equal, np.cumsum(sizes) - sizes)
        names = np.zeros(len(order), np.int32)
        names[1:] = np.cumsum(~same)
        if names[-1] + 1 < len(order):
            named = np.zeros(n, np.int32)
            named[order] = names
            order = lms[_sorted_names(named[lms])]
        lms = order
    return _induce(text, small, lms, starts, ends, larger)


def permuted_prefixes(text: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each position its predecessor in suffix order (-1 for the first) and the length of their common prefix.

    Where the symbols before both are equal the length is one less than at the position before; only the other
    positions are compared, eight bytes at a time. ``text`` is of bytes.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    at = np.arange(n)
    known = np.flatnonzero(before >= 0)
    derived = np.zeros(n, bool)
    inner = known[(known > 0) & (before[known] > 0)]
    derived[inner] = (text[inner - 1] == text[before[inner] - 1]) & (before[inner - 1] == before[inner] - 1)
    left = known[~derived[known]]
    words = np.ndarray((n,), "<u8", np.concatenate([text, np.zeros(8, np.uint8)]).tobytes(), 0, (1,))
    prefix = np.zeros(n, np.int64)
    x, y = left, before[left]
    while len(x):
        shift = prefix[left]
        differ = words[np.minimum(x + shift, n - 1)] ^ words[np.minimum(y + shift, n - 1)]
        low = differ & (~differ + np.uint64(1))
        step = np.searchsorted(np.uint64(1) << (np.arange(1, 8, dtype=np.uint64) * np.uint64(8)), low, side="right")
        step = np.where(differ == 0, 8, step)
        prefix[left] = shift + step
        going = differ == 0
        left, x, y = left[going], x[going], y[going]
    source = np.maximum.accumulate(np.where(derived, -1, at))
    return before, np.where(derived, prefix[np.maximum(source, 0)] - (at - source), prefix)
