"""Images as bytes, in numpy and zlib alone: PNG both ways, baseline JPEG to write; simple drawing."""

from __future__ import annotations

import struct
import zlib
from functools import lru_cache

import numpy as np

_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def encode_png(image: np.ndarray) -> bytes:
    """An 8-bit RGB image, losslessly. Rows are stored as differences to the row above."""
    h, w = image.shape[:2]
    rows = image.astype(np.uint8).reshape(h, w * 3)
    up = np.diff(rows, axis=0, prepend=np.zeros((1, w * 3), np.uint8)).astype(np.uint8)
    raw = np.concatenate([np.full((h, 1), 2, np.uint8), up], axis=1).tobytes()
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return _SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """8-bit grey, RGB and RGBA images that aren't interlaced."""
    if data[:8] != _SIGNATURE:
        raise ValueError("not a PNG file")
    at, head, body = 8, None, []
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data[at + 8 : at + 8 + n])
        elif kind == b"IDAT":
            body.append(data[at + 8 : at + 8 + n])
        at += 12 + n
    w, h, depth, colour, _, _, laced = head
    channels = {0: 1, 2: 3, 4: 2, 6: 4}.get(colour)
    if depth != 8 or channels is None or laced:
        raise ValueError("only 8-bit images without a palette that aren't interlaced")
    lines = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h, w * channels), np.uint8)
    above = np.zeros(w * channels, np.uint8)
    for y in range(h):
        out[y] = above = _unfiltered(int(lines[y, 0]), lines[y, 1:], above, channels)
    return out.reshape(h, w, channels)


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, step: int) -> np.ndarray:
    if kind == 0:
        return line
    if kind == 2:
        return line + above
    if kind == 1:
        return np.add.accumulate(line.reshape(-1, step), axis=0, dtype=np.uint8).ravel()
    out, up = line.tolist(), above.tolist()
    for i in range(len(out)):
        a, b, c = out[i - step] if i >= step else 0, up[i], up[i - step] if i >= step else 0
        if kind == 3:
            guess = (a + b) // 2
        else:
            p = a + b - c
            guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
        out[i] = (out[i] + guess) & 255
    return np.array(out, np.uint8)


# Fixed values of the JPEG standard, its Annex K: quantization tables.
_LUMA = "16 11 10 16 24 40 51 61 12 12 14 19 26 58 60 55 14 13 16 24 40 57 69 56 14 17 22 29 51 87 80 62 18 22 37 56 68 109 103 77 24 35 55 64 81 104 113 92 49 64 78 87 103 121 120 101 72 92 95 98 112 100 103 99"
_CHROMA = "17 18 24 47 99 99 99 99 18 21 26 66 99 99 99 99 24 26 56 99 99 99 99 99 47 66 99 99 99 99 99 99" + " 99" * 32


@lru_cache(maxsize=1)
def _zigzag() -> np.ndarray:
    """Places of an 8 x 8 block along its diagonals, every other one upwards."""
    return np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, (i // 8 if (i // 8 + i % 8) % 2 else i % 8))))


def quantization(base: str, quality: int) -> np.ndarray:
    """A table scaled to a quality of 1 to 100, by the rule that is in common use."""
    scale = 5000 // quality if quality < 50 else 200 - 2 * quality
    return np.clip((np.array(base.split(), np.int64) * scale + 50) // 100, 1, 255)


@lru_cache(maxsize=1)
def _dct() -> np.ndarray:
    k = np.arange(8)
    m = np.cos((2 * k[None, :] + 1) * k[:, None] * np.pi / 16) / 2
    m[0] /= np.sqrt(2)
    return m


def _table(freq: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int], list[int]]:
    """A Huffman table for the symbols that occur: code and length by symbol, its counts by length, its symbols in order.

    Symbols in the order of their frequency get Golomb-like lengths: as many short codes as
    leaves room for all others within 16 bits. No code consists of ones alone.
    """
    order = sorted(np.flatnonzero(freq).tolist(), key=lambda s: -int(freq[s]))
    # package by repeated halving: lengths by the share of the symbol, then lengthened until they fit
    total = max(1, int(freq.sum()))
    length = {s: min(16, max(1, int(np.ceil(-np.log2(int(freq[s]) / total))) + 1)) for s in order}
    while sum(2.0 ** -n for n in length.values()) > 1 - 2.0**-16:
        for s in reversed(order):
            if length[s] < 16:
                length[s] += 1
                break
    order.sort(key=lambda s: (length[s], s))
    code, size, counts, now, was = np.zeros(256, np.int64), np.zeros(256, np.int64), [0] * 16, 0, 0
    for s in order:
        now <<= length[s] - was
        was = length[s]
        code[s], size[s] = now, was
        counts[was - 1] += 1
        now += 1
    return code, size, counts, order


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits of each value's magnitude."""
    return np.ceil(np.log2(np.abs(values) + 1.0)).astype(np.int64)


def encode_jpeg(image: np.ndarray, quality: int = 90) -> bytes:
    """An 8-bit RGB image as baseline JPEG, colours not subsampled, with Huffman tables made for it."""
    h, w = image.shape[:2]
    x = np.pad(image.astype(np.float64), ((0, -h % 8), (0, -w % 8), (0, 0)), "edge")
    r, g, b = x[..., 0], x[..., 1], x[..., 2]
    planes = (0.299 * r + 0.587 * g + 0.114 * b, 128 - 0.168736 * r - 0.331264 * g + 0.5 * b, 128 + 0.5 * r - 0.418688 * g - 0.081312 * b)
    m, tables = _dct(), [quantization(_LUMA, quality), quantization(_CHROMA, quality)]
    blocks = []
    for k, p in enumerate(planes):
        q = (p - 128).reshape(p.shape[0] // 8, 8, p.shape[1] // 8, 8).swapaxes(1, 2).reshape(-1, 8, 8)
        blocks.append(np.rint((m @ q @ m.T).reshape(-1, 64) / tables[min(k, 1)]).astype(np.int64)[:, _zigzag()])
    coef = np.stack(blocks, 1).reshape(-1, 64)  # the planes take turns
    dc = coef[:, 0].reshape(-1, 3)
    first = np.diff(dc, axis=0, prepend=np.zeros((1, 3), np.int64)).ravel()
    # symbols of all blocks: block, place in it, symbol, and the bits behind it
    row, at = np.nonzero(coef[:, 1:])
    value = coef[row, at + 1]
    new = np.append(True, row[1:] != row[:-1]) if len(row) else np.zeros(0, bool)
    gap = at - np.where(new, -1, np.append(-1, at[:-1])) - 1 if len(row) else at
    long = gap // 16
    owner, zero = np.repeat(row, long), np.repeat(at * 2, long)
    n = len(coef)
    open_end = np.flatnonzero(coef[:, 63] == 0)
    size = _bits(value)
    rows = np.concatenate([np.arange(n), row, owner, open_end])
    place = np.concatenate([np.full(n, -1), at * 2 + 1, zero, np.full(len(open_end), 999)])
    symbol = np.concatenate([_bits(first), (gap % 16) * 16 + size, np.full(len(owner), 0xF0), np.zeros(len(open_end), np.int64)])
    more = np.concatenate([first, value, np.zeros(len(owner) + len(open_end), np.int64)])
    count = np.concatenate([_bits(first), size, np.zeros(len(owner) + len(open_end), np.int64)])
    order = np.lexsort((place, rows))
    rows, place, symbol, more, count = (v[order] for v in (rows, place, symbol, more, count))
    is_dc = place == -1
    dc_table, ac_table = _table(np.bincount(symbol[is_dc], minlength=256)), _table(np.bincount(symbol[~is_dc], minlength=256))
    code = np.where(is_dc, dc_table[0][symbol], ac_table[0][symbol])
    width = np.where(is_dc, dc_table[1][symbol], ac_table[1][symbol])
    tail = np.where(more < 0, more + (1 << count) - 1, more)
    data = _packed((code << count) | tail, width + count)
    segment = lambda marker, body: struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body
    out = [b"\xff\xd8", segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0")]
    out += [segment(0xDB, bytes([k, *t[_zigzag()].tolist()])) for k, t in enumerate(tables)]
    out.append(segment(0xC0, struct.pack(">BHHB", 8, h, w, 3) + bytes([1, 0x11, 0, 2, 0x11, 1, 3, 0x11, 1])))
    out += [segment(0xC4, bytes([kind, *t[2], *t[3]])) for kind, t in ((0x00, dc_table), (0x10, ac_table))]
    out.append(segment(0xDA, bytes([3, 1, 0, 2, 0, 3, 0, 0, 63, 0])))
    return b"".join(out) + data + b"\xff\xd9"


def _packed(codes: np.ndarray, sizes: np.ndarray) -> bytes:
    """Codes side by side, filled up with ones; a byte of ones is followed by a zero byte."""
    total = int(sizes.sum())
    start = np.cumsum(sizes) - sizes
    bits = np.ones(total + -total % 8, np.uint8)
    for k in range(int(sizes.max(initial=0))):
        live = sizes > k
        bits[start[live] + k] = codes[live] >> (sizes[live] - 1 - k) & 1
    raw = np.packbits(bits)
    return np.insert(raw, np.flatnonzero(raw == 255) + 1, 0).tobytes()


def encode(image: np.ndarray, suffix: str, quality: int = 90) -> bytes:
    """An image in the format that a suffix names."""
    kind = suffix.lower()
    if kind in (".jpg", ".jpeg"):
        return encode_jpeg(image, quality)
    if kind == ".png":
        return encode_png(image)
    raise ValueError(f"no image format of the suffix {suffix}")


def resized(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear, between pixels' middles."""
    h, w = image.shape[:2]
    y, x = (np.arange(height) + 0.5) * h / height - 0.5, (np.arange(width) + 0.5) * w / width - 0.5
    y, x = y.clip(0, h - 1), x.clip(0, w - 1)
    a, b = y.astype(int), x.astype(int)
    c, d = np.minimum(a + 1, h - 1), np.minimum(b + 1, w - 1)
    fy, fx = (y - a)[:, None, None], (x - b)[None, :, None]
    f = image.astype(float)
    return np.rint((1 - fy) * ((1 - fx) * f[a][:, b] + fx * f[a][:, d]) + fy * ((1 - fx) * f[c][:, b] + fx * f[c][:, d])).astype(np.uint8)


def frame(image: np.ndarray, x1: int, y1: int, x2: int, y2: int, colour: tuple[int, int, int], width: int = 1) -> None:
    """The outline of a box, drawn inwards, in place."""
    for k in range(width):
        if x1 + k > x2 - k or y1 + k > y2 - k:
            return
        image[[y1 + k, y2 - k], x1 + k : x2 - k + 1] = colour
        image[y1 + k : y2 - k + 1, [x1 + k, x2 - k]] = colour


def fill(image: np.ndarray, x1: int, y1: int, x2: int, y2: int, colour: tuple[int, int, int]) -> None:
    image[max(0, y1) : y2 + 1, max(0, x1) : x2 + 1] = colour


def polygon_mask(points: np.ndarray, height: int, width: int) -> np.ndarray:
    """Pixels whose middles lie inside a polygon by the even-odd rule, and those on its edges."""
    x, y = points[:, 0].astype(float), points[:, 1].astype(float)
    x2, y2 = np.roll(x, -1), np.roll(y, -1)
    inside = np.zeros((height, width), bool)
    columns = np.arange(width)
    for row in range(max(0, int(y.min())), min(height - 1, int(y.max())) + 1):
        cross = (y <= row) != (y2 <= row)
        at = x[cross] + (row - y[cross]) * (x2[cross] - x[cross]) / (y2[cross] - y[cross])
        inside[row] = (columns[:, None] < at[None, :]).sum(1) % 2 == 1
    return inside | line_mask(points, height, width)


def line_mask(points: np.ndarray, height: int, width: int, thick: int = 1) -> np.ndarray:
    """Pixels of the closed line through the points."""
    out = np.zeros((height, width), bool)
    for (x1, y1), (x2, y2) in zip(points.tolist(), np.roll(points, -1, axis=0).tolist(), strict=True):
        n = int(max(abs(x2 - x1), abs(y2 - y1))) + 1
        xs, ys = np.rint(np.linspace(x1, x2, n)).astype(int), np.rint(np.linspace(y1, y2, n)).astype(int)
        for k in range(thick):
            for dx, dy in ((k, 0), (0, k)):
                a, b = (xs + dx).clip(0, width - 1), (ys + dy).clip(0, height - 1)
                out[b, a] = True
    return out
