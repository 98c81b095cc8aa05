"""Content-defined segments of texts, so that equal windows of fixed width meet.

A window's anchor is the smallest hash of the short runs inside it, which its content
alone decides. A segment is a stretch of windows one after the other with the same
anchor, at most as many as a window has runs. Equal windows have equal anchors, wherever
they stand; so whether a window stands elsewhere is decided among segments of one anchor.
"""

from __future__ import annotations

import numpy as np

from tilewright.llm.arrays import spread
from tilewright.llm.wordhash import least_of, mix


def cut(run_hash: np.ndarray, first: np.ndarray, size: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of texts whose units stand at first[i]..first[i]+size[i] of one sequence.

    run_hash: hashes of all runs of ``run`` units of the sequence. Returns the text of
    each segment, where its first window begins (in the sequence), its number of windows,
    its anchor, and whether its anchor's run stands in it more than once (only then can a
    window repeat inside the segment).
    """
    inner = window - run + 1
    has = np.flatnonzero(size >= window)
    if not len(has):
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64), np.zeros(0, bool)
    low = least_of(run_hash, inner)
    change = np.append(True, low[1:] != low[:-1])
    begin, end = first[has], first[has] + size[has] - window + 1
    change[begin] = True
    ends = end[end < len(change)]
    change[ends] = True  # windows across texts begin a stretch of their own, which is left out
    starts = np.flatnonzero(change)
    stops = np.append(starts[1:], len(low))
    text = np.searchsorted(begin, starts, "right") - 1
    ok = (text >= 0) & (starts < end[np.maximum(text, 0)])
    starts, stops, text = starts[ok], stops[ok], text[ok]
    # long stretches (periodic text) are cut
    n = stops - starts
    parts = -(-n // inner)
    if (parts > 1).any():
        k = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, stops, text = np.repeat(starts, parts) + k * inner, np.repeat(stops, parts), np.repeat(text, parts)
        n = np.minimum(stops - starts, inner)
    # runs that are the least of some window: those that no window's minimum is above
    zeros = np.zeros(inner - 1, np.uint64)
    chosen = np.flatnonzero(~least_of(~np.concatenate([zeros, low, zeros]), inner) == run_hash)
    a, b = np.searchsorted(chosen, starts), np.searchsorted(chosen, starts + n + inner - 1)
    same = run_hash[chosen[spread(a, b - a)]] == np.repeat(low[starts], b - a)
    double = np.bincount(np.repeat(np.arange(len(starts)), b - a), same, len(starts)) > 1
    return has[text], starts, n, mix(low[starts] ^ np.uint64(0x8EBC6AF09C88C6E3)), double
