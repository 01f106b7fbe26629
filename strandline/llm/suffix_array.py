"""Suffix arrays by induced sorting, in numpy, a bucket at a time."""

from __future__ import annotations

import numpy as np

from strandline.llm import tokens

BUCKETS = 1024  # up to which suffixes of one bucket are gone through together


def smaller_type(s: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one (type S); the last one is."""
    n = len(s)
    differs = np.flatnonzero(s[1:] != s[:-1])
    smaller = np.zeros(n, bool)
    smaller[differs] = s[differs] < s[differs + 1]
    # A run of equal symbols has the type of its last one.
    ends = np.append(differs, n - 1)
    smaller[n - 1] = True
    run = np.searchsorted(ends, np.arange(n))
    return smaller[ends[run]]


def induce(s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, size: int) -> np.ndarray:
    """The suffix array that sorted leftmost-smaller suffixes ``seeds`` imply: larger
    suffixes from left to right, then smaller ones from right to left. Entries of a
    bucket that are known at one time are gone through together."""
    n = len(s)
    counts = np.bincount(s, minlength=size)
    ends = np.cumsum(counts)
    starts = ends - counts
    out = np.full(n, -1, np.int64)

    head = starts.copy()
    symbols = s[seeds]
    order = np.argsort(symbols, kind="stable")
    by_symbol = seeds[order]
    edges = np.searchsorted(symbols[order], np.arange(size + 1))

    def place(block: np.ndarray, kind: bool, at: np.ndarray, way: int) -> None:
        before = block[block > 0] - 1
        before = before[smaller[before] == kind]
        if not len(before):
            return
        symbol = s[before]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        first = np.flatnonzero(np.diff(symbol.astype(np.int64), prepend=-1))
        times = np.diff(np.append(first, len(symbol)))
        rank = np.arange(len(symbol)) - np.repeat(first, times)
        out[at[symbol] + way * rank] = before
        at[symbol[first]] += way * times

    for c in range(size):
        at = starts[c]
        while at < head[c]:
            block = out[at : head[c]].copy()
            at = head[c]
            place(block, False, head, 1)
        if edges[c + 1] > edges[c]:
            place(by_symbol[edges[c] : edges[c + 1]], False, head, 1)
    # The last suffix is induced by the end of the text; it is smaller by type.
    tail = ends - 1
    tail[s[n - 1]] -= 1
    out[ends[s[n - 1]] - 1] = n - 1
    for c in range(size - 1, -1, -1):
        at = ends[c] - 1
        while at > tail[c]:
            block = out[tail[c] + 1 : at + 1][::-1].copy()
            at = tail[c]
            place(block, True, tail, -1)
        place(out[starts[c] : head[c]][::-1].copy(), True, tail, -1)
    return out


def suffix_array(s: np.ndarray, size: int) -> np.ndarray:
    """The sorted suffixes of ``s``, symbols below ``size``, the last one 0 and no other.

    Leftmost-smaller substrings are sorted by one induction and named; the string of
    names is sorted in turn, by the same steps; a second induction brings in all other
    suffixes.
    """
    n = len(s)
    if n < 2:
        return np.arange(n)
    smaller = smaller_type(s)
    leftmost = smaller.copy()
    leftmost[0] = False
    leftmost[1:] &= ~smaller[:-1]
    found = np.flatnonzero(leftmost)
    # Buckets pay where they are few; nearly every name has one of its own.
    way = induce if size <= BUCKETS else induce_singly
    sorted_ = way(s, smaller, found, size)
    sorted_ = sorted_[leftmost[sorted_]]

    # Equal substrings get one name; they reach to the next leftmost-smaller symbol.
    number = np.full(n, 0)
    number[found] = np.arange(len(found))
    ends = np.append(found[1:], n - 1)[number[sorted_]]
    lengths = ends - sorted_ + 1
    new = np.ones(len(sorted_), bool)
    same = np.flatnonzero(lengths[1:] == lengths[:-1])
    one, two = sorted_[1:][same], sorted_[:-1][same]
    new[1:][same] = common(s, one, two, lengths[1:][same]) < lengths[1:][same]
    if new.all():
        return way(s, smaller, sorted_, size)
    names = np.empty(len(found), np.int64)
    names[number[sorted_]] = np.cumsum(new) - 1
    order = suffix_array(names, int(new.sum()))
    return way(s, smaller, found[order], size)


def induce_singly(
    s: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, size: int
) -> np.ndarray:
    """``induce``, one suffix at a time."""
    n = len(s)
    ends = np.cumsum(np.bincount(s, minlength=size))
    # By suffix, the symbol before it where that is of the kind sought; else -1, as for
    # the places not filled yet, which hold a -1 themselves.
    before, kind = s[:-1].astype(np.int64), smaller[:-1]
    larger_before = [-1, *np.where(kind, -1, before).tolist(), -1]
    smaller_before = [-1, *np.where(kind, before, -1).tolist(), -1]
    out = [-1] * n
    symbols = s[seeds]
    order = np.argsort(symbols, kind="stable")
    symbols = symbols[order]
    last = np.searchsorted(symbols, symbols, side="right")
    places = ends[symbols] - (last - np.arange(len(seeds)))
    for place, seed in zip(places.tolist(), seeds[order].tolist(), strict=True):
        out[place] = seed
    head = [0, *ends[:-1].tolist()]
    for suffix in out:  # sees what is placed further on
        symbol = larger_before[suffix]
        if symbol >= 0:
            place = head[symbol]
            out[place] = suffix - 1
            head[symbol] = place + 1
    tail = ends.tolist()
    tail[s[n - 1]] -= 1  # the last suffix stays
    for suffix in reversed(out):
        symbol = smaller_before[suffix]
        if symbol >= 0:
            place = tail[symbol] - 1
            out[place] = suffix - 1
            tail[symbol] = place
    return np.array(out, np.int64)


def common(s: np.ndarray, one: np.ndarray, two: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes at ``one`` and ``two`` share from their start, up to
    ``most``: eight bytes of symbols at a time, as long as they agree."""
    width = 8 // s.itemsize
    room = np.zeros(len(s) + width, s.dtype)
    room[: len(s)] = s
    words = np.lib.stride_tricks.as_strided(
        room.view(np.uint8), (len(s), 8), (s.itemsize, 1)
    )
    words = np.ascontiguousarray(words).view(np.uint64).ravel()
    shared = np.zeros(len(one), np.int64)
    live = np.flatnonzero(most > 0)
    at = 0
    while len(live):
        apart = words[one[live] + at] ^ words[two[live] + at]
        agree = apart == 0
        # The first byte apart, from the lowest up, tells the symbols that agree.
        lowest = apart[~agree] & (~apart[~agree] + np.uint64(1))
        bits = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
        shared[live[~agree]] = at + bits // (8 * s.itemsize)
        live = live[agree]
        at += width
        shared[live] = at
        # A suffix that ends here shares no more.
        longest = np.minimum(most[live], len(s) - np.maximum(one[live], two[live]))
        live = live[longest > at]
    return np.minimum(shared, np.minimum(most, len(s) - np.maximum(one, two)))


def permuted_prefixes(s: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """By place in the text: how many symbols a suffix shares with the one before it in
    the suffix array, up to ``most``. In this order a value is at least the last one less
    one, so after a suffix is measured the following ones start from what is known."""
    n = len(s)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    out = np.zeros(n, np.int64)
    # Every so many places, then the places halfway between: what the left neighbour
    # leaves is known to be shared and not compared again.
    step = 1
    while step * 2 < most:
        step *= 2
    done = np.zeros(n, bool)
    while step:
        places = np.arange(0, n, step)
        places = places[(before[places] >= 0) & ~done[places]]
        left = np.maximum(places - step, 0)
        known = np.where(done[left] & (places >= step), np.maximum(out[left] - step, 0), 0)
        one, two = places + known, before[places] + known
        fits = np.maximum(one, two) < n
        found = np.zeros(len(places), np.int64)
        found[fits] = common(s, one[fits], two[fits], most - known[fits])
        out[places] = np.minimum(known + found, most)
        done[places] = True
        step //= 2
    return out


def running_sums(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = tokens.powers(len(s) + 1)
    values = tokens.mix(np.arange(int(s.max()) + 1, dtype=np.uint64) + np.uint64(0x5A15))
    sums = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(values[s] * up[: len(s)], out=sums[1:])
    return sums, down


def between(sums: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [start, end)."""
    return tokens.mix((sums[0][end] - sums[0][start]) * sums[1][start])


def reaching(s: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """By place in the text: whether a suffix shares ``length`` symbols or more with the
    one before it in the suffix array."""
    return permuted_prefixes(s, order, length) >= length
