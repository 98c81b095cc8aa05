"""Baseline JPEG in numpy: a lossless carrier for bytes, and a reader of DC thumbnails.

Writing: a byte is a luminance sample. A sample fills one 8x8 block, whose only
coefficient is its DC with quantizer 8, so any JPEG reader shows the sample exactly, and
the image's DC-only thumbnail is the payload. A restart interval has 192 blocks and is
byte-aligned, so intervals can be decoded side by side.

Reading: markers are parsed, scans are Huffman-decoded for all restart intervals of all
images of a batch at once (one numpy step for each symbol of an interval), AC
coefficients are skipped, and the DC values give a luminance thumbnail of one sample a
block. Images with other tables, component counts and sampling factors are read the same
way; without restart markers an image is one lane. Progressive, arithmetic-coded, 12-bit
or damaged images raise ValueError.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

ROW = 192
#: Fixed by the format: no side may be longer than 65535 samples.
MAX_BLOCKS = 65535 // 8

#: Category -> code length; categories 2..7 have 3 bits, 0, 1 and 8 have 4.
_DC_BITS, _DC_VALUES = (0, 0, 6, 3) + (0,) * 12, (2, 3, 4, 5, 6, 7, 0, 1, 8)
_AC_BITS, _AC_VALUES = (1,) + (0,) * 15, (0,)


def _codes(bits: tuple[int, ...], values: tuple[int, ...]) -> dict[int, tuple[int, int]]:
    """Symbol -> (code, length), assigned in increasing order as the format prescribes."""
    out, code, at = {}, 0, 0
    for length, n in enumerate(bits, 1):
        for v in values[at : at + n]:
            out[v] = (code, length)
            code += 1
        at += n
        code <<= 1
    return out


def _writer_table() -> tuple[np.ndarray, np.ndarray]:
    """For a difference + 255: the bits of DC symbol, amplitude and end-of-block, and how many."""
    dc, (eob, eob_len) = _codes(_DC_BITS, _DC_VALUES), _codes(_AC_BITS, _AC_VALUES)[0]
    bits, size = np.zeros(511, np.int64), np.zeros(511, np.int64)
    for d in range(-255, 256):
        cat = abs(d).bit_length()
        code, n = dc[cat]
        amp = d if d >= 0 else d + (1 << cat) - 1
        bits[d + 255], size[d + 255] = (((code << cat) | amp) << eob_len) | eob, n + cat + eob_len
    return bits, size


_BITS, _SIZE = _writer_table()


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _header(width: int, height: int, payload: int) -> bytes:
    """All before the scan. width and height count blocks."""
    quant = bytes([0]) + bytes([8]) + bytes([1]) * 63
    frame = struct.pack(">BHHBBBB", 8, height * 8, width * 8, 1, 1, 0x11, 0)
    return b"".join(
        (
            b"\xff\xd8",
            _segment(0xE0, b"JFIF\0\1\1\0\0\1\0\1\0\0"),
            _segment(0xFE, b"payload=%d" % payload),
            _segment(0xDB, quant),
            _segment(0xC0, frame),
            _segment(0xC4, bytes([0x00, *_DC_BITS, *_DC_VALUES])),
            _segment(0xC4, bytes([0x10, *_AC_BITS, *_AC_VALUES])),
            _segment(0xDD, struct.pack(">H", ROW)),
            _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
        )
    )


def _layout(n: int) -> list[tuple[int, int, int]]:
    """Images for n bytes: (width, height) in blocks and bytes of each."""
    out, most = [], ROW * (MAX_BLOCKS // ROW) * MAX_BLOCKS
    while n > 0:
        part = min(n, most)
        width = ROW * -(-part // (ROW * MAX_BLOCKS))
        out.append((width, -(-part // width), part))
        n -= part
    return out


def write(payloads: list[bytes]) -> list[bytes]:
    """One stored form (an image, or several in a row if it is very long) for each payload: bytes, some multiple of 192 of them."""
    images, parts = [], []
    for i, p in enumerate(payloads):
        if not p or len(p) % ROW:
            raise ValueError("a payload must be a positive multiple of 192 bytes")
        at = 0
        for w, h, n in _layout(len(p)):
            images.append((i, w, h, n))
            parts.append(p[at : at + n] + b" " * (w * h - n))
            at += n
    data = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64)
    diff = np.diff(data, prepend=128)
    diff[::ROW] = data[::ROW] - 128
    bits, size = _BITS[diff + 255], _SIZE[diff + 255]
    ends = np.cumsum(size.reshape(-1, ROW), 1)
    bytes_of = (ends[:, -1] + 7) // 8
    start = np.cumsum(bytes_of) - bytes_of
    at = ((start * 8)[:, None] + ends).ravel() - size
    place, word = at >> 3, bits << (24 - size - (at & 7))
    total = int(bytes_of.sum())
    out = sum(np.bincount(place + k, (word >> (16 - 8 * k)) & 255, total + 2) for k in range(3))[:total].astype(np.uint8)
    out[start + bytes_of - 1] |= ((1 << (bytes_of * 8 - ends[:, -1])) - 1).astype(np.uint8)
    # room for a zero after each 255, and for a marker after each interval
    room = 1 + (out == 255).astype(np.int64)
    last = start + bytes_of - 1
    room[last] += 2
    to = np.cumsum(room)
    scan = np.zeros(int(to[-1]), np.uint8)
    scan[to - room] = out
    mark = to[last]
    per_image = np.array([w * h // ROW for _, w, h, _ in images])
    first = np.cumsum(per_image) - per_image
    number = np.arange(len(last)) - np.repeat(first, per_image)
    scan[mark - 2] = 255
    scan[mark - 1] = 0xD0 + number % 8
    final = first + per_image - 1
    scan[mark[final] - 1] = 0xD9
    stored, raw, begin = [b""] * len(payloads), scan.tobytes(), 0
    for (i, w, h, n), end in zip(images, mark[final].tolist(), strict=True):
        stored[i] += _header(w, h, n) + raw[begin:end]
        begin = end
    return stored


@dataclass
class Image:
    width: int
    height: int
    #: luminance, one sample a block, rows x columns
    thumb: np.ndarray
    #: the comment segments
    comment: bytes


@dataclass
class _Frame:
    width: int = 0
    height: int = 0
    comps: tuple = ()  # (id, h, v, quantizer) in the frame's order
    restart: int = 0
    pattern: tuple = ()  # of an MCU's blocks: (component, DC table, AC table)
    comment: bytes = b""
    data: tuple[int, int] = (0, 0)
    end: int = 0
    dc_quant: int = 1


def _parse(raw: bytes, at: int) -> _Frame:
    """From the SOI at ``at`` to the end of the scan."""
    f, quants, tables, scanned = _Frame(), {}, {}, False
    if raw[at : at + 2] != b"\xff\xd8":
        raise ValueError("no JPEG: it doesn't begin with SOI")
    at += 2
    while True:
        while raw[at : at + 2] == b"\xff\xff":
            at += 1
        if at + 2 > len(raw) or raw[at] != 0xFF:
            raise ValueError("a marker is missing")
        marker = raw[at + 1]
        if marker == 0xD9:
            f.end = at + 2
            if not scanned:
                raise ValueError("no scan")
            return f
        if at + 4 > len(raw) or at + 2 + (size := struct.unpack_from(">H", raw, at + 2)[0]) > len(raw):
            raise ValueError("a segment is cut short")
        body = raw[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xFE:
            f.comment += body
        elif marker == 0xDB:
            k = 0
            while k < len(body):
                wide = body[k] >> 4
                quants[body[k] & 15] = struct.unpack_from(">H" if wide else ">B", body, k + 1)[0]
                k += 129 if wide else 65
        elif marker in (0xC0, 0xC1):
            depth, f.height, f.width, n = struct.unpack_from(">BHHB", body)
            if depth != 8 or not f.height or not f.width:
                raise ValueError("only 8-bit images with a known size")
            f.comps = tuple((body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n))
        elif 0xC2 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            raise ValueError("not a baseline image")
        elif marker == 0xC4:
            k = 0
            while k < len(body):
                bits = tuple(body[k + 1 : k + 17])
                n = sum(bits)
                tables[body[k]] = (bits, tuple(body[k + 17 : k + 17 + n]))
                k += 17 + n
        elif marker == 0xDD:
            f.restart = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            if scanned or not f.comps or body[0] != len(f.comps):
                raise ValueError("only one interleaved scan")
            use = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
            try:
                f.pattern = tuple((k, tables[use[c[0]] >> 4], tables[0x10 | use[c[0]] & 15]) for k, c in enumerate(f.comps) for _ in range(c[1] * c[2] if len(f.comps) > 1 else 1))
                f.dc_quant = quants[f.comps[0][3]]
            except KeyError as e:
                raise ValueError("a table is missing") from e
            end = at
            while True:
                end = raw.find(b"\xff", end)
                if end < 0 or end + 1 >= len(raw):
                    raise ValueError("the scan doesn't end")
                if raw[end + 1] == 0 or 0xD0 <= raw[end + 1] <= 0xD7:
                    end += 2
                    continue
                break
            f.data, at, scanned = (at, end), end, True


_lookups: dict = {}


def _lookup(table: tuple) -> np.ndarray:
    """For 16 bits ahead: length << 8 | symbol; 0 where no code fits."""
    if table not in _lookups:
        out = np.zeros(65536, np.int32)
        for symbol, (code, n) in _codes(*table).items():
            out[code << (16 - n) : (code + 1) << (16 - n)] = n << 8 | symbol
        _lookups[table] = out
    return _lookups[table]


def read(stored: list[bytes]) -> list[list[Image]]:
    """The images of each stored form, in order."""
    frames: list[tuple[int, _Frame]] = []
    for i, raw in enumerate(stored):
        at = 0
        while at < len(raw) or not at:
            f = _parse(raw, at)
            frames.append((i, f))
            at = f.end
    kinds: dict[tuple, list[int]] = {}
    for k, (_, f) in enumerate(frames):
        kinds.setdefault((f.pattern, f.restart), []).append(k)
    thumbs: list = [None] * len(frames)
    for (pattern, _), which in kinds.items():
        for k, t in zip(which, _thumbs([(stored[frames[k][0]], frames[k][1]) for k in which], pattern), strict=True):
            thumbs[k] = t
    out: list[list[Image]] = [[] for _ in stored]
    for (i, f), t in zip(frames, thumbs, strict=True):
        out[i].append(Image(f.width, f.height, t, f.comment))
    return out


def _thumbs(images: list[tuple[bytes, _Frame]], pattern: tuple) -> list[np.ndarray]:
    sizes = np.array([f.data[1] - f.data[0] for _, f in images])
    scan = np.frombuffer(b"".join(raw[f.data[0] : f.data[1]] for raw, f in images) + b"\0", np.uint8)
    base = np.cumsum(sizes) - sizes
    follows = np.flatnonzero(scan[:-1] == 255) + 1  # what stands after a 255: a stuffed zero, or a restart
    marks = follows[scan[follows] != 0]
    drop = np.zeros(len(scan), bool)
    drop[follows] = True
    drop[marks - 1] = True
    clean = scan[~drop]
    kept_before = np.cumsum(~drop) - ~drop
    begin = np.sort(np.concatenate([base, marks + 1]))
    lane_image = np.searchsorted(base, begin, "right") - 1
    if len(marks) and (np.searchsorted(base, marks, "right") - 1 != np.searchsorted(base, marks + 1, "right") - 1).any():
        raise ValueError("a scan ends with a restart")
    # blocks of each lane
    mcus, tall = [], []
    for _, f in images:
        hmax, vmax = (max(c[1] for c in f.comps), max(c[2] for c in f.comps)) if len(f.comps) > 1 else (1, 1)
        mcus.append((-(-f.width // (8 * hmax))) * (-(-f.height // (8 * vmax))))
        tall.append((hmax, vmax))
    mcus = np.array(mcus)
    first_lane = np.searchsorted(lane_image, np.arange(len(images)))
    ordinal = np.arange(len(begin)) - first_lane[lane_image]
    restart = images[0][1].restart or int(mcus.max())
    lane_mcus = np.minimum(restart, mcus[lane_image] - ordinal * restart)
    if (lane_mcus <= 0).any() or (np.bincount(lane_image, lane_mcus, len(images)) != mcus).any():
        raise ValueError("restart markers and size don't agree")
    order = np.argsort(-lane_mcus, kind="stable")
    lane_mcus, pos = lane_mcus[order], kept_before[begin][order] * 8
    padded = np.concatenate([clean, np.zeros(8, np.uint8)]).astype(np.uint32)
    ahead = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    limit = (len(ahead) - 4) * 8
    per = [k for k, x in enumerate(pattern) if x[0] == 0]
    most = int(lane_mcus[0])
    dc = np.zeros((len(begin), most, len(per)), np.int32)
    pred = np.zeros((len(begin), 1 + max(x[0] for x in pattern)), np.int32)

    def symbol(pos: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        got = table[(ahead[pos >> 3] >> (16 - (pos & 7)).astype(np.uint32)) & 65535]
        if not got.all():
            raise ValueError("a code that no table has")
        return got & 255, got >> 8

    for m in range(most):
        n = int(np.searchsorted(-lane_mcus, -m, "left"))  # lanes with more than m MCUs come first
        p = pos[:n]
        slot = 0
        for comp, dc_table, ac_table in pattern:
            size, used = symbol(p, _lookup(dc_table))
            p = p + used
            amp = ((ahead[p >> 3].astype(np.int64) << 16) >> (48 - (p & 7) - size)) & ((1 << size) - 1)
            pred[:n, comp] += np.where(amp < (1 << size) >> 1, amp - (1 << size) + 1, amp).astype(np.int32)
            p = p + size
            table, todo, k = _lookup(ac_table), None, np.ones(n, np.int32)
            while True:
                at = p if todo is None else p[todo]
                rs, used = symbol(at, table)
                run, bits = rs >> 4, rs & 15
                skip = used + bits
                more = (bits > 0) | (run == 15)
                if todo is None:
                    p = at + skip
                    k += run + 1
                    todo = np.flatnonzero(more & (k < 64))
                else:
                    p[todo] = at + skip
                    k[todo] += run + 1
                    todo = todo[more & (k[todo] < 64)]
                if len(todo) == 0:
                    break
                if p.max() > limit:
                    raise ValueError("a scan is cut short")
            if comp == 0:
                dc[:n, m, slot] = pred[:n, 0]
                slot += 1
            if len(p) and p.max() > limit:
                raise ValueError("a scan is cut short")
        pos[:n] = p
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    dc, lane_mcus = dc[back], lane_mcus[back]
    out = []
    for k, (_, f) in enumerate(images):
        lanes = slice(first_lane[k], first_lane[k + 1] if k + 1 < len(images) else len(begin))
        flat = dc[lanes].reshape(-1, len(per)) if lane_mcus[lanes].min() == most else np.concatenate([d[:c] for d, c in zip(dc[lanes], lane_mcus[lanes], strict=True)])
        hmax, vmax = tall[k]
        h, v = (f.comps[0][1], f.comps[0][2]) if len(f.comps) > 1 else (1, 1)
        wide, high = -(-f.width // (8 * hmax)), -(-f.height // (8 * vmax))
        grid = flat.reshape(high, wide, v, h).transpose(0, 2, 1, 3).reshape(high * v, wide * h)
        rows, cols = -(-(-(-f.height * v // vmax)) // 8), -(-(-(-f.width * h // hmax)) // 8)
        out.append(np.clip(np.rint(grid[:rows, :cols] * (f.dc_quant / 8)) + 128, 0, 255).astype(np.uint8))
    return out


def thumb_hash(thumb: np.ndarray) -> str:
    """64 bits: whether each cell of an 8x8 grid over the thumbnail is lighter than the whole."""
    h, w = thumb.shape
    rows, cols = np.arange(8) * h // 8, np.arange(8) * w // 8
    sums = np.add.reduceat(np.add.reduceat(thumb.astype(np.int64), rows, 0), cols, 1)
    area = np.add.reduceat(np.ones(h, np.int64), rows)[:, None] * np.add.reduceat(np.ones(w, np.int64), cols)[None, :]
    lighter = sums * thumb.size > area * int(thumb.sum(dtype=np.int64))
    return f"{int.from_bytes(np.packbits(lighter.ravel()).tobytes(), 'big'):016x}"
