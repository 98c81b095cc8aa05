"""Vectorized hashes of words, of runs of words, and of runs of bytes."""

from __future__ import annotations

import hashlib

import numpy as np

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_MOD = 1 << 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of texts data[off[i]:off[i+1]], and the number of words of each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off) - 1, np.int64)
    ink = ~_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True  # a word ends where its text ends
    before = np.append(False, ink[:-1])
    starts = np.flatnonzero(ink & (~before | edge[:-1]))
    after = np.append(ink[1:], False)
    ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
    n = np.searchsorted(starts, off[1:]) - np.searchsorted(starts, off[:-1])
    return starts, ends, n


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each data[starts[i]:ends[i]], by differences of running sums modulo 2^64."""
    base = (_BASE * (2 * seed + 1) ^ (seed << 17)) % _MOD | 1
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed))
    p = _powers(len(data) + 1, base)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * p[:-1], out=sums[1:])
    back = _powers(len(data) + 1, pow(base, -1, _MOD))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


#: Words of more bytes are hashed by blake2b, as sums modulo 2^64 of long self-similar words can be equal.
LONG = 64


def hash_words(data: np.ndarray, off: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, words of each text, and the words' starts and ends."""
    starts, ends, n = word_bounds(data, off)
    h = hash_spans(data, starts, ends, seed)
    for i in np.flatnonzero(ends - starts > LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, key=b"%d" % seed).digest(), "little")
    return h, n, starts, ends


def runs(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of each h[i:i+width], whatever texts they belong to; its length is len(h) - width + 1, or 0."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    out, have, parts = None, h, []
    size, at, left = 1, 0, width
    # width as a sum of powers of two, low bits first; `have` holds hashes of runs of `size`
    while left:
        if left & 1:
            parts.append((at, have))
            at += size
        left >>= 1
        if left:
            have = mix(have[:-size] * np.uint64(_BASE) + (have[size:] ^ np.uint64(size)))
            size *= 2
    n = len(h) - width + 1
    for at, part in parts:
        piece = part[at : at + n]
        out = piece if out is None else mix(out * np.uint64(0xC2B2AE3D27D4EB4F) + piece)
    return out


def least_of(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each x[i:i+width]."""
    if len(x) < width:
        return x[:0]
    size, m = 1, x
    while size * 2 <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    return np.minimum(m[: len(x) - width + 1], m[width - size : width - size + len(x) - width + 1])


def byte_runs(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of each data[i:i+width] of bytes."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = (_BASE * 7) % _MOD | 1
    table = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _powers(len(data), base), out=sums[1:])
    return mix((sums[width:] - sums[:n]) * _powers(n, pow(base, -1, _MOD)))


def hash_stretches(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each values[starts[i]:ends[i]] of 64-bit values."""
    base = (_BASE * 11) % _MOD | 1
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(mix(values ^ np.uint64(0x589965CC75374CC3)) * _powers(len(values), base), out=sums[1:])
    back = _powers(len(values) + 1, pow(base, -1, _MOD))
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
