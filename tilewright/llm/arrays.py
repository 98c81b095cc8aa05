"""Numpy helpers for functions that run over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that a function works on at once.
CHUNK = 1 << 20


def slices(sizes: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes together; a larger row is a run of its own."""
    at, ends = 0, np.cumsum(sizes)
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield at, to
        at = to


def text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null: empty), and the offsets of its rows."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if a.null_count:
        a = a.fill_null("") if pa.types.is_string(a.type) or pa.types.is_large_string(a.type) else a.fill_null(b"")
    a = a.cast(pa.large_binary())
    off = np.frombuffer(a.buffers()[1], np.int64, len(a) + 1, a.offset * 8)
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] is not None and len(a) else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i]+1, ... for sizes[i] places, one after the other."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    return np.arange(total) + np.repeat(np.asarray(starts, np.int64) - (ends - sizes), sizes)
