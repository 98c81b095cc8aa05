"""A minimal acyclic transducer from words to id lists, as flat arrays in one byte string.

Words are inserted in sorted order into an automaton whose equal suffixes are shared. Each
arc carries the number of words that sort before those it leads to, so the sum along a
word's path is the word's rank, which indexes the id lists. The arrays can be mapped
from a file; lookups walk all words of a batch at once, a byte a step.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

_MAGIC = b"TWTR0001"


def build(entries: list[tuple[bytes, tuple[int, ...]]]) -> bytes:
    """Compiles distinct non-empty words with their ids."""
    entries = sorted(entries)
    # a node: [final, {byte: node}, words below and here]; the register shares equal ones
    register: dict = {}
    root: list = [False, {}, None]
    path = [root]
    before = b""

    def settle(depth: int) -> None:
        while len(path) > depth + 1:
            node, above = path.pop(), path[-1]
            key = (node[0], *((b, id(n)) for b, n in node[1].items()))
            same = register.get(key)
            if same is None:
                register[key] = same = node
                node[2] = int(node[0]) + sum(n[2] for n in node[1].values())
            above[1][before[len(path) - 1]] = same

    for word, _ in entries:
        common = len(os.path.commonprefix((before, word)))
        settle(common)
        before = word
        for b in word[common:]:
            node = [False, {}, None]
            path[-1][1][b] = node
            path.append(node)
        path[-1][0] = True
    settle(0)
    numbers, order, todo = {id(root): 0}, [root], [root]
    while todo:
        node = todo.pop()
        for n in node[1].values():
            if id(n) not in numbers:
                numbers[id(n)] = len(order)
                order.append(n)
                todo.append(n)
    keys, targets, skips = [], [], []
    for state, node in enumerate(order):
        skip = int(node[0])
        for b in sorted(node[1]):
            n = node[1][b]
            keys.append(state << 8 | b)
            targets.append(numbers[id(n)])
            skips.append(skip)
            skip += n[2]
    parts = (
        np.array(keys, np.uint32),
        np.array(targets, np.uint32),
        np.array(skips, np.uint32),
        np.array([n[0] for n in order], np.uint32),
        np.cumsum([0, *(len(ids) for _, ids in entries)]).astype(np.uint32),
        np.array([i for _, ids in entries for i in ids], np.uint32),
    )
    if len(order) > 1 << 24:
        raise ValueError("too many states for 32-bit keys")
    return _MAGIC + np.array([len(p) for p in parts], np.int64).tobytes() + b"".join(p.tobytes() for p in parts)


class Transducer:
    """The compiled form, mapped from a file."""

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, np.uint8, "r")
        if raw[:8].tobytes() != _MAGIC:
            raise ValueError("not a transducer")
        sizes, at, parts = np.frombuffer(raw[8:56], np.int64), 56, []
        for n in sizes.tolist():
            parts.append(np.frombuffer(raw[at : at + 4 * n], np.uint32))
            at += 4 * n
        self.keys, self.targets, self.skips, self.final, self.starts, self.ids = parts

    @classmethod
    def mapped(cls, compiled: bytes) -> Transducer:
        """Maps a file of this process's own temporary folder. Its name is gone at once; the pages stay while they are mapped."""
        fd, path = tempfile.mkstemp(prefix="lexicon-")
        try:
            with os.fdopen(fd, "wb") as f:
                f.write(compiled)
            return cls(path)
        finally:
            os.unlink(path)

    def ranks(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Rank of each word, data[off[i]:off[i+1]]; -1 where the lexicon lacks it."""
        n = len(off) - 1
        out = np.full(n, -1, np.int64)
        if not len(self.keys) or not n:
            return out
        size = np.diff(off)
        live = np.flatnonzero(size > 0)
        live = live[np.argsort(size[live], kind="stable")]
        state, rank, at = np.zeros(len(live), np.int64), np.zeros(len(live), np.int64), off[live].astype(np.int64)
        left = size[live].astype(np.int64)
        while len(live):
            key = (state << 8 | data[at]).astype(np.uint32)
            j = np.searchsorted(self.keys, key)
            j[j == len(self.keys)] = 0
            ok = self.keys[j] == key
            live, j, at, left, rank = live[ok], j[ok], at[ok] + 1, left[ok] - 1, rank[ok]
            state, rank = self.targets[j].astype(np.int64), rank + self.skips[j]
            ended = left == 0
            if ended.any():
                hit = ended & (self.final[state] == 1)
                out[live[hit]] = rank[hit]
                go = ~ended
                live, state, rank, at, left = live[go], state[go], rank[go], at[go], left[go]
        return out
