"""The first 32 bits of many short texts' MD5 at once, in numpy: texts that differ in some digits and a letter at their end.

``hashlib`` takes half a microsecond a text, most of it for objects; here a step of MD5 is
done for all texts before the next one. Of the 64 steps the first ones, over what the texts
have in common, are done once, and the last three don't touch the first 32 bits.
"""

from __future__ import annotations

import hashlib
import math
import struct
from functools import lru_cache

import numpy as np

#: Fixed by the standard: constants, shifts, order of words, and the state at the beginning.
_K = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_SHIFT = [s for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in four * 4]
_WORD = [(i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16 for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_STEPS, _ONE_BLOCK, _FEW = 61, 55, 256
_ALL = 0xFFFFFFFF


@lru_cache(64)
def _tails(digits: int, tags: str, offset: int) -> tuple[np.ndarray, ...]:
    """Three words for each tag and number of so many digits: digits, a bar, the tag and the closing bit, behind ``offset`` zero bytes."""
    out = np.zeros((len(tags), 10**digits, 12), np.uint8)
    n = np.arange(10**digits)
    for i in range(digits):
        out[:, :, offset + i] = 48 + n // 10 ** (digits - 1 - i) % 10
    for i, tag in enumerate(tags):
        out[i, :, offset + digits : offset + digits + 3] = (ord("|"), ord(tag), 0x80)
    return tuple(np.ascontiguousarray(w) for w in out.reshape(-1, 12).view("<u4").astype(np.uint32).T)


def _mixed(i: int, b: np.ndarray, c: np.ndarray, d: np.ndarray, out: np.ndarray) -> np.ndarray:
    """The function of step i, into ``out``."""
    if i < 16:
        np.bitwise_xor(c, d, out=out)
        np.bitwise_and(out, b, out=out)
        return np.bitwise_xor(out, d, out=out)
    if i < 32:
        np.bitwise_xor(b, c, out=out)
        np.bitwise_and(out, d, out=out)
        return np.bitwise_xor(out, c, out=out)
    if i < 48:
        np.bitwise_xor(b, c, out=out)
        return np.bitwise_xor(out, d, out=out)
    np.invert(d, out=out)
    np.bitwise_or(out, b, out=out)
    return np.bitwise_xor(out, c, out=out)


def heads(prefix: bytes, digits: int, tags: str, which: slice | np.ndarray = slice(None)) -> np.ndarray:
    """The first four bytes of the MD5 of prefix, number, bar and tag (a letter), as a big-endian number.

    The texts are those that ``which`` picks of all, first by tag and then by number: all with so many digits
    (at most five), zeros in front.
    """
    length = len(prefix) + digits + 2
    few = isinstance(which, np.ndarray) and len(which) <= _FEW
    if few or length > _ONE_BLOCK:
        n, letters = np.arange(len(tags) * 10**digits)[which].tolist(), tags.encode()
        return np.frombuffer(b"".join(hashlib.md5(prefix + b"%0*d|%c" % (digits, t % 10**digits, letters[t // 10**digits])).digest()[:4] for t in n), ">u4").astype(np.uint32)
    at = len(prefix) // 4
    tails = [w[which] for w in _tails(digits, tags, len(prefix) % 4)]
    words = list(struct.unpack("<16I", prefix.ljust(56, b"\0") + struct.pack("<Q", 8 * length)))
    a, b, c, d = _START
    for i in range(at):
        t = (a + (d ^ (b & (c ^ d))) + _K[i] + words[i]) & _ALL
        a, b, c, d = d, (b + (t << _SHIFT[i] | t >> (32 - _SHIFT[i]))) & _ALL, b, c
    a, b, c, d = (np.uint32(v) for v in (a, b, c, d))
    t, u = np.empty_like(tails[0]), np.empty_like(tails[0])
    for i in range(at, _STEPS):
        word = _WORD[i]
        _mixed(i, b, c, d, t)
        np.add(t, a, out=t)
        np.add(t, np.uint32((_K[i] + words[word]) & _ALL), out=t)
        if at <= word < at + 3:
            np.add(t, tails[word - at], out=t)
        np.left_shift(t, np.uint32(_SHIFT[i]), out=u)
        np.right_shift(t, np.uint32(32 - _SHIFT[i]), out=t)
        np.bitwise_or(t, u, out=t)
        new = np.add(t, b, out=a if a.shape else np.empty_like(t))
        a, b, c, d = d, new, b, c
    return (b + np.uint32(_START[0])).byteswap()
