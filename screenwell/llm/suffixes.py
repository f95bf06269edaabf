"""Suffix arrays by induced sorting and permuted common prefixes, vectorised over whole buckets."""

from __future__ import annotations

import numpy as np


def suffix_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one after it; the last, a unique 0, counts as such."""
    change = np.flatnonzero(t[1:] != t[:-1])
    up = t[change + 1] > t[change]
    out = np.ones(len(t), bool)
    out[:-1] = np.repeat(up, np.diff(np.concatenate([[-1], change])))
    return out


def dealt(held: list[list[np.ndarray]], found: np.ndarray, symbol: np.ndarray) -> None:
    """Append the positions ``found`` to the buckets of their symbols, in order."""
    if not len(found):
        return
    own = symbol[found]
    order = np.argsort(own, kind="stable")
    found, own = found[order], own[order]
    cut = np.flatnonzero(own[1:] != own[:-1]) + 1
    for c, part in zip(own[np.concatenate([[0], cut])].tolist(), np.split(found, cut), strict=True):
        held[c].append(part)


def induce(t: np.ndarray, small: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes, from the leftmost-smaller ones in the order ``seeds``.

    One scan upwards induces the larger types from what stands before, one scan downwards the smaller
    types. A bucket is scanned as a whole; what it induces in itself (runs of a symbol) comes in
    further waves.
    """
    larger: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    first: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    dealt(first, seeds, t)
    none = np.zeros(0, np.int64)
    up = [none] * symbols
    for c in range(symbols):
        waves, out = [], []
        now = np.concatenate(larger[c]) if larger[c] else none
        while len(now):
            waves.append(now)
            before = now[now > 0] - 1
            before = before[~small[before]]
            same = t[before] == c
            out.append(before[~same])
            now = before[same]
        for part in first[c]:
            before = part[part > 0] - 1
            out.append(before[~small[before]])
        up[c] = np.concatenate(waves) if waves else none
        if out:
            dealt(larger, np.concatenate(out), t)
    smaller: list[list[np.ndarray]] = [[] for _ in range(symbols)]
    smaller[0].append(np.array([len(t) - 1]))
    parts: list[np.ndarray] = []
    for c in range(symbols - 1, -1, -1):
        waves, out = [], []
        now = np.concatenate(smaller[c]) if smaller[c] else none
        while len(now):
            waves.append(now)
            before = now[now > 0] - 1
            before = before[small[before]]
            same = t[before] == c
            out.append(before[~same])
            now = before[same]
        before = up[c][::-1]
        before = before[before > 0] - 1
        out.append(before[small[before]])
        parts.append(np.concatenate(waves)[::-1] if waves else none)
        parts.append(up[c])
        dealt(smaller, np.concatenate(out), t)
    return np.concatenate(parts[::-1])


def names_of(t: np.ndarray, order: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ranks of the sorted leftmost-smaller substrings t[i:end[i] + 1]; equal ones share a rank."""
    size = end[order] - order + 1
    alike = size[1:] == size[:-1]
    at = np.flatnonzero(alike)
    if len(at):
        lengths = size[at]
        start = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        step = np.arange(int(lengths.sum())) - np.repeat(start, lengths)
        odd = t[np.repeat(order[at], lengths) + step] != t[np.repeat(order[at + 1], lengths) + step]
        alike[at] = np.add.reduceat(odd, start) == 0
    return np.concatenate([[0], np.cumsum(~alike)])


def sorted_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of a string of names: ranks of ever longer pieces, twice as long each
    time, until no two are equal."""
    rank, width = names.astype(np.int64), 1
    while True:
        order = np.argsort(rank, kind="stable")
        fresh = np.concatenate([[0], np.cumsum(rank[order][1:] != rank[order][:-1])])
        rank = np.empty_like(rank)
        rank[order] = fresh
        if fresh[-1] == len(rank) - 1:
            return order
        after = np.zeros_like(rank)
        after[:-width] = rank[width:] + 1
        rank = rank * (len(rank) + 1) + after
        width *= 2


def suffix_array(t: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of ``t``, whose last symbol is 0 and stands nowhere else."""
    if len(t) < 2:
        return np.arange(len(t))
    small = suffix_types(t)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    rough = induce(t, small, lms, symbols)
    leftmost = np.zeros(len(t), bool)
    leftmost[lms] = True
    order = rough[leftmost[rough]]
    end = np.zeros(len(t), np.int64)
    end[lms] = np.concatenate([lms[1:], [len(t) - 1]])
    name = np.zeros(len(t), np.int64)
    name[order] = names_of(t, order, end)
    return induce(t, small, lms[sorted_names(name[lms])], symbols)


def permuted_prefixes(t: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position the common prefix with the suffix sorted before it.

    Where the symbols before both differ, it is compared directly; anywhere else it is one less than
    that of the position before.
    """
    before = np.full(len(t), -1)
    before[order[1:]] = order[:-1]
    position = np.arange(len(t))
    whole = (before <= 0) | (position == 0) | (t[position - 1] != t[np.maximum(before - 1, 0)])
    start = np.flatnonzero(whole & (before >= 0))
    other, length = before[start], np.zeros(len(start), np.int64)
    live = np.arange(len(start))
    top = len(t) - 1
    while len(live):
        a, b = start[live] + length[live], other[live] + length[live]
        same = (t[np.minimum(a, top)] == t[np.minimum(b, top)]) & (a < top) & (b < top)
        live = live[same]
        length[live] += 1
    out = np.zeros(len(t), np.int64)
    out[start] = length
    last = np.maximum.accumulate(np.where(whole, position, 0))
    return np.where(whole, out, out[last] - (position - last))


def repeated(texts: list[bytes], size: int) -> list[tuple[int, int, int]]:
    """(text, from, to): maximal runs of ``texts`` covered by strings of ``size`` bytes that also
    start elsewhere in ``texts``."""
    joined = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    t = joined.astype(np.int64) + 2
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    stop = np.cumsum(length + 1) - 1
    t[stop] = 1
    t = np.concatenate([t, [0]])
    order = suffix_array(t, 258)
    common = permuted_prefixes(t, order)
    owner = np.searchsorted(stop, np.arange(len(t)))
    left = np.concatenate([stop, [len(t)]])[owner] - np.arange(len(t))
    hit = np.minimum(common, left) >= size
    hit[order[:-1]] |= (np.minimum(common[order[1:]], left[order[:-1]]) >= size)
    at = np.flatnonzero(hit)
    if not len(at):
        return []
    apart = np.flatnonzero((np.diff(at) > size) | (np.diff(owner[at]) != 0)) + 1
    first = at[np.concatenate([[0], apart])]
    final = at[np.concatenate([apart - 1, [len(at) - 1]])] + size
    begin = np.concatenate([[0], stop[:-1] + 1])
    return [(int(owner[a]), int(a - begin[owner[a]]), int(b - begin[owner[a]])) for a, b in zip(first, final, strict=True)]
