"""Repeated windows of a block of strings, by interval expansion on its Burrows-Wheeler transform.

Suffixes are sorted to the window's depth: by a first key of as many symbols as 63 bits
hold, then by three ranks at a time, among those still tied only. That gives the
transform. Then the intervals of suffixes with a common prefix are derived breadth-first:
from the interval of a string w of length l, a backward step by each character c that
precedes its suffixes gives the interval of cw. The first interval to end at a place marks
the common prefix there as l. Values come in increasing order, so the work stops at the
minimum length; places without a mark then have a common prefix of at least that length.
The first key is a table of all strings of its length: the expansion begins with their
intervals, and places between them are marked by it. Intervals whose right end is marked
already aren't followed, so each place is marked once. Separators aren't stepped to:
windows that matter lie inside a string.
"""

from __future__ import annotations

import numpy as np


def dense(text: np.ndarray) -> tuple[np.ndarray, int]:
    """Symbols as 0, 1, ... in the same order, and the bits of one."""
    present = np.zeros(int(text.max()) + 1, bool)
    present[text] = True
    code = (np.cumsum(present) - 1).astype(np.int64)
    return code[text], max(1, int(code[-1]).bit_length())


def first_keys(sym: np.ndarray, bits: int, depth: int) -> tuple[np.ndarray, int]:
    """For each suffix its first symbols as one number, and how many they are."""
    have = min(depth, 63 // bits)
    key = np.zeros(len(sym), np.int64)
    for k in range(have):
        key <<= bits
        key[: max(0, len(sym) - k)] |= sym[k:]
    return key, have


def suffix_order(key: np.ndarray, have: int, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols at least, from keys of the first ``have``; ties are in any order."""
    n = len(key)
    order = np.argsort(key)
    places, some, key = np.arange(n), order, key[order]
    rank = np.zeros(n + 2 * depth + 1, np.int64)  # of a suffix past the end: 0
    bits = n.bit_length()
    three = 3 * bits <= 63  # else two ranks at a time
    while True:
        head = np.append(True, key[1:] != key[:-1]) if n else np.zeros(0, bool)
        first = np.flatnonzero(head)
        size = np.diff(np.append(first, len(key)))
        rank[some] = np.repeat(places[first], size) + 1
        tied = np.repeat(size > 1, size)
        places, some = places[tied], some[tied]
        if have >= depth or not len(places):
            return order
        key = rank[some] << bits | rank[some + have]
        if three:
            key = key << bits | rank[some + 2 * have]
        turn = np.argsort(key)
        some, key = some[turn], key[turn]
        order[places] = some  # a tie's places follow its rank, so all ties are sorted at once
        have *= 3 if three else 2


def deep_prefixes(sym: np.ndarray, key: np.ndarray, bits: int, have: int, order: np.ndarray, depth: int) -> np.ndarray:
    """True at place i where suffixes at places i-1 and i share at least ``depth`` symbols. Symbol 0 is the separator."""
    n = len(sym)
    if not n:
        return np.zeros(0, bool)
    before = sym[order - 1]  # the transform; before the first symbol stands the last
    inside = before != 0
    back = np.argsort(before.astype(np.uint16), kind="stable")
    lf = np.empty(n, np.int32)  # place of the suffix that is one symbol longer to the left
    lf[back] = np.arange(n, dtype=np.int32)
    symbol = np.sort(sym).astype(np.int32)  # the first symbol of each place's suffix
    ranked = key[order]
    marked = np.append(np.append(True, ranked[1:] != ranked[:-1]), True)
    bounds = np.flatnonzero(marked)
    lo, hi = bounds[:-1].astype(np.int32), bounds[1:].astype(np.int32)
    # those whose right neighbour shares all symbols but the last end at a common prefix of just that length
    inner = hi < n
    exact = np.zeros(len(hi), bool)
    exact[inner] = ranked[hi[inner] - 1] >> bits == ranked[hi[inner]] >> bits
    lo, hi = lo[exact], hi[exact]
    for _ in range(have, depth):
        if not len(lo):
            break
        size = hi - lo
        single = size == 1
        one = lo[single]
        one = lf[one[inside[one]]]
        lo, size = lo[~single], size[~single]
        # the intervals of cw for all intervals of w: equal symbols of an interval lead to places side by side
        ends = np.cumsum(size, dtype=np.int64)
        at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(lo - (ends - size), size)
        of = np.repeat(np.arange(len(lo)), size)
        keep = inside[at]
        to = of[keep] << 32 | lf[at[keep]]
        to.sort()
        place = (to & 0xFFFFFFFF).astype(np.int32)
        tag = (to >> 32) << 16 | symbol[place]
        cut = np.flatnonzero(np.append(np.ones(min(1, len(to)), bool), tag[1:] != tag[:-1]))
        last = place[np.append(cut[1:], len(to))[: len(cut)] - 1]
        lo, hi = np.concatenate([one, place[cut]]), np.concatenate([one, last]) + 1
        # of two intervals that end at one place, one is enough: both are of strings of one length, so they are equal
        new = ~marked[hi]
        lo, hi = lo[new], hi[new]
        marked[hi] = True
    return ~marked[:n]


def repeated(strings: list[bytes], weights: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each string, where its windows of ``depth`` bytes begin that stand elsewhere too.

    A string of weight 2 or more stands for that many equal ones. Each string must be at
    least ``depth`` bytes long and differ from all others.
    """
    size = np.array([len(s) for s in strings], np.int64)
    text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int16) + 1
    ends = np.cumsum(size + 1) - 1
    text[ends] = 0
    sym, bits = dense(text)
    key, have = first_keys(sym, bits, depth)
    order = suffix_order(key, have, depth)
    joins = deep_prefixes(sym, key, bits, have, order, depth)
    del key
    owner = np.repeat(np.arange(len(strings)), size + 1)
    left = np.repeat(ends, size + 1) - np.arange(len(text))  # symbols before the string's end
    group = np.cumsum(~joins) - 1
    valid = left[order] >= depth
    load = np.bincount(group[valid], np.minimum(np.asarray(weights), 2)[owner[order[valid]]], int(group[-1]) + 1)
    hit = order[valid & (load[group] >= 2)]
    hit.sort()
    begin = ends - size
    bounds = np.searchsorted(hit, np.append(begin, len(text)))
    return [hit[a:b] - s for a, b, s in zip(bounds, bounds[1:], begin, strict=False)]
