"""Rejection sampling of negative tiles to a target of each slide's own: as many as it has annotations.

A slide is drawn from until its target is met or its tries run out, TRIES an annotation.
SQL can't stop a slide early, and making all its tries beforehand (millions) is wasteful, so
a slide's tries are made and judged in blocks of numpy. All boxes of a slide meet in one row
(32 bytes each), and so do its accepted origins.

Most slides that use up their tries have no place left that is free, so the places are
judged first, by cells: in most of them one box shows in every tile, and in most others
none does in any. Only tries in the rest are compared with boxes. Where nobody asks for the
counts by reason, a try is only made whole on a line that has a free place, and none is if
there is none. Where tries are counted, repeated origins are known by no other way than by
making them, but for those on lines (the edges, mostly) of which all places were there; the JVM
makes them, as it hashes seven times as fast as numpy. What it leaves (see _TO_JVM) is done here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import jvm, md5
from tilewright.functions.geometry import MIN_VISIBLE
from tilewright.operators.tiles import RADIUS_START, RADIUS_STEP, RADIUS_TOP, SIDE

#: Tries an annotation at most, and tries between two radii.
TRIES, EVERY = 5000, 5000
#: Digits of a try that differ within a block, at most, and tries of a block, at first and later on.
_DIGITS, _LESS, _MOST = 5, 10000, 25000
#: The least size of a cell (a power of two) and the most cells; mixed cells that are looked at place by place.
_CELL, _CELLS, _SETTLED = 32, 1 << 22, 256
#: Blocks that wait to be judged together, and tries among them that may be free.
_WAITING, _ENOUGH = 16, 256
#: Most places of a slide that the JVM makes tries of (it has a bit for each), and free places it looks for, for each annotation.
_TO_JVM, _SPARE = 1 << 29, 2
#: What a cell's tiles are: free, to be compared with the boxes, or all hit by the same box.
_FREE, _MIXED, _HIT = range(3)
_COUNTS = ("accepted", "duplicate", "annotation", "low_tissue")


def _radius() -> np.ndarray:
    """Radius after each step, by repeated addition as long as it grows."""
    out = [RADIUS_START]
    while out[-1] < RADIUS_TOP:
        out.append(min(RADIUS_TOP, out[-1] + RADIUS_STEP))
    return np.array(out)


def _shown(x0: np.ndarray, y0: np.ndarray, boxes: np.ndarray, side: int) -> np.ndarray:
    """For each origin, whether a box shows in its tile to 30 %. Large boxes go first, and tiles with one drop out."""
    hit = np.zeros(len(x0), bool)
    area = (boxes[2] - boxes[0]) * (boxes[3] - boxes[1])
    order = np.argsort(-area)
    order = order[area[order] > 0]
    for i in range(0, len(order), 64):
        x1, y1, x2, y2 = (b[order[i : i + 64]] for b in boxes)
        left = np.flatnonzero(~hit)
        for j in range(0, len(left), 1 << 14):
            at = left[j : j + (1 << 14)]
            x, y = x0[at, None].astype(float), y0[at, None].astype(float)
            w, h = np.minimum(x2, x + side) - np.maximum(x1, x), np.minimum(y2, y + side) - np.maximum(y1, y)
            hit[at] = ((w > 0) & (h > 0) & (w * h / area[order[i : i + 64]] >= MIN_VISIBLE)).any(1)
    return hit


class _Distinct:
    """Distinct whole numbers of many; they are gathered and merged when they are as many as those merged before."""

    def __init__(self, kind: type) -> None:
        self.kind, self.merged, self.waiting, self.n = kind, np.zeros(0, kind), [], 0

    def add(self, codes: np.ndarray) -> bool:
        """Whether they were merged."""
        self.waiting.append(codes.astype(self.kind))
        self.n += len(codes)
        return self.n >= max(1 << 16, len(self.merged) // 2) and bool(self.count())

    def count(self) -> int:
        if self.n:
            both = np.concatenate([self.merged, *self.waiting])
            both.sort()
            self.merged, self.waiting, self.n = both[np.append(True, both[1:] != both[:-1])], [], 0
        return len(self.merged)


class _Seen:
    """Whole numbers that were there before, in two sorted arrays, so that not all are moved each time."""

    def __init__(self) -> None:
        self.parts = [np.zeros(0, np.int64), np.zeros(0, np.int64)]

    def first(self, codes: np.ndarray) -> np.ndarray:
        """Where in ``codes`` there are new ones, each once, in order; from now on they aren't new."""
        codes, at = np.unique(codes, return_index=True)
        for part in self.parts:
            new = np.append(part, -1)[np.searchsorted(part, codes)] != codes
            codes, at = codes[new], at[new]
        old, late = self.parts
        late = np.insert(late, np.searchsorted(late, codes), codes)
        self.parts = [old, late] if len(late) < 4096 + len(old) // 4 else [np.sort(np.concatenate([old, late])), late[:0]]
        return np.sort(at)


class _Places:
    """The origins that a slide's tries can have, in cells of ``size``, and the boxes that show in their tiles."""

    def __init__(self, extents: tuple[int, int], boxes: np.ndarray, side: int) -> None:
        half = min(extents) * _radius()
        self.boxes, self.side, self.size = boxes, side, _CELL
        self.extents, self.top = extents, half[-1]
        # the bounds of all radii, by the numbers that the tries are made with
        ends = [[_at(extent, half, np.full(len(half), u), side) for u in (0.0, 4294967296.0)] for extent in extents]
        self.lo, self.hi = [int(e[0].min()) for e in ends], [int(e[1].max()) for e in ends]
        self.sides = [h - low + 1 for low, h in zip(self.lo, self.hi, strict=True)]
        while np.prod([-(-n // self.size) for n in self.sides]) > _CELLS:
            self.size *= 2
        self._judge()

    def _judge(self) -> None:
        """``state`` of all cells, by bounds of the width and height that each box shows in a cell's tiles, with some room for rounding."""
        some, every = (np.zeros([-(-n // self.size) for n in self.sides], bool) for _ in range(2))
        area = (self.boxes[2] - self.boxes[0]) * (self.boxes[3] - self.boxes[1])
        all_ = np.flatnonzero(area > 0)
        for solid in (all_[i : i + 1024] for i in range(0, len(all_), 1024)):
            spans, shows = [], []
            for k in (0, 1):
                low, high, n = self.boxes[k, solid], self.boxes[k + 2, solid], every.shape[k]
                begin = np.clip((low - self.side - self.lo[k]) // self.size, 0, n).astype(int)
                end = np.clip((high - self.lo[k]) // self.size + 1, begin, n).astype(int)
                # for each box a row of its cells, from the first one that it can show in
                cell = begin[:, None] + np.arange((end - begin).max(initial=0))
                first = self.lo[k] + self.size * cell.astype(float)
                last, low, high = first + self.size - 1, low[:, None], high[:, None]
                left, right = np.maximum(low, first), np.minimum(high, last + self.side)
                least = np.minimum(np.minimum(high, first + self.side) - left, right - np.maximum(low, last))
                spans.append(np.stack([begin, end, end - begin], 1).tolist())
                shows.append((np.maximum(right - left, 0), np.maximum(least, 0)))
            with np.errstate(divide="ignore"):
                # the height from which on a width is enough
                enough = [v * MIN_VISIBLE * area[solid, None] / show for v, show in zip((1 - 1e-9, 1 + 1e-9), shows[0], strict=True)]
            for i, ((x, x_end, nx), (y, y_end, ny)) in enumerate(zip(*spans, strict=True)):
                some[x:x_end, y:y_end] |= enough[0][i, :nx, None] <= shows[1][0][i, :ny]
                every[x:x_end, y:y_end] |= enough[1][i, :nx, None] <= shows[1][1][i, :ny]
        self.state = np.where(every, _HIT, np.where(some, _MIXED, _FREE)).astype(np.uint8)

    def settle(self) -> None:
        """Gives mixed cells the state that a look at each place gives them, if they are few; ``open`` has the lines that have a free place."""
        mixed = np.argwhere(self.state == _MIXED)
        few = len(mixed) <= _SETTLED
        which = self.state == _FREE if few else self.state != _HIT
        self.open = [np.repeat(which.any(1 - k), self.size)[: self.sides[k]] for k in (0, 1)]
        for cell in mixed[: len(mixed) * few]:
            x, y = (self.lo[k] + np.arange(cell[k] * self.size, min(self.sides[k], (cell[k] + 1) * self.size)) for k in (0, 1))
            near = np.logical_and.reduce([(self.boxes[k] < v[-1] + self.side) & (self.boxes[k + 2] > v[0]) for k, v in ((0, x), (1, y))])
            hit = _shown(np.repeat(x, len(y)), np.tile(y, len(x)), self.boxes[:, near], self.side).reshape(len(x), len(y))
            self.state[tuple(cell)] = _HIT if hit.all() else _MIXED if hit.any() else _FREE
            for k, v in ((0, x), (1, y)):
                self.open[k][v - self.lo[k]] |= ~hit.all(1 - k)

    def share(self, k: int) -> float:
        """Of draws at the largest radius, about how many are on open lines."""
        at = _at(self.extents[k], self.top, np.linspace(0, 4294967296.0, 4096), self.side)
        return float(self.open[k][at - self.lo[k]].mean())

    def states(self, x0: np.ndarray, y0: np.ndarray) -> np.ndarray:
        bits = self.size.bit_length() - 1
        return self.state.ravel()[(x0 - self.lo[0] >> bits) * self.state.shape[1] + (y0 - self.lo[1] >> bits)]


def _at(extent: int, half: np.ndarray | float, drawn: np.ndarray, side: int) -> np.ndarray:
    """Origins of draws of 32 bits, between 0 and what keeps the tile inside. (Dividing by 2 ** 32 first gives the same numbers.)"""
    v = drawn * (2 * half / 4294967296.0)
    v += extent / 2 - half
    np.rint(v, out=v)
    v -= side // 2
    return np.clip(v, 0, max(0, extent - side), out=v).astype(np.int64)


def _blocks(limit: int) -> Iterator[tuple[int, int, bytes, int, int]]:
    """Tries from 0 in order: begin, end, the digits that they begin with, how many digits follow, and the first of those numbers."""
    begin = 0
    while begin < limit:
        k = min(len(str(begin)), _DIGITS)
        high, first = divmod(begin, 10**k)
        end = min(limit, 10**k * (high + 1), begin + (_MOST if high else _LESS))
        yield begin, end, b"%d" % high if high else b"", k, first
        begin = end


def sample(slide: int, width: int, height: int, boxes: np.ndarray, tissue: Callable, *, per: int = TRIES, every: int = EVERY, seed: int = 42, side: int = SIDE, look: int = 1024, counted: bool = True) -> tuple[dict[str, int | None], np.ndarray, np.ndarray]:
    """Counts by reason and the accepted origins of one slide. boxes: rows x1, y1, x2, y2; tissue: of arrays x0 and y0.

    Unless ``counted``, only the accepted ones are counted. A try is drawn along one axis first, and along the
    other if its line is open: has a place that is free, or, where tries are counted, one that none had before.
    """
    target, extents, radius = boxes.shape[1], (width, height), _radius()
    places = _Places(extents, boxes, side)
    if counted:
        one = int(np.argmin(places.sides))
        open_ = np.ones(places.sides[one], bool)
    else:
        places.settle()
        one = int(np.argmin([places.share(k) for k in (0, 1)]))
        open_ = places.open[one]
    two, lines = 1 - one, np.arange(places.sides[one] + 1) * places.sides[1 - one]
    judged, distinct = _Seen(), _Distinct(np.uint32 if lines[-1] < 1 << 32 else np.int64)
    limit, accepted, low, made = target * per, [], 0, 0
    waiting, free = [], []
    for begin, end, digits, k, first in _blocks(limit):
        if len(accepted) >= target or not open_.any():
            break
        prefix = f"{seed}|{slide}|".encode() + digits
        # the radius grows before every so many-th try is drawn; tries count from 1 there
        step = np.minimum(np.array([begin + 1, end]) // every, len(radius) - 1)
        half = min(extents) * (radius[step[0]] if step[0] == step[1] else radius[np.minimum(np.arange(begin + 1, end + 1) // every, len(radius) - 1)])
        at = _at(extents[one], half, md5.heads(prefix, k, "xy"[one], slice(first, first + end - begin)), side)
        which = np.flatnonzero(open_[at - places.lo[one]])
        other = _at(extents[two], half[which] if np.ndim(half) else half, md5.heads(prefix, k, "xy"[two], which + first), side)
        at = at[which]
        code = (at - places.lo[one]) * places.sides[two] + (other - places.lo[two])
        state = places.states(*((at, other) if one == 0 else (other, at)))
        maybe = np.flatnonzero(state != _HIT)
        which += begin
        free.append(np.stack([v[maybe] for v in (which, at, other, code, state)]))
        waiting.append((which, code))
        if 10**_DIGITS < end < limit and len(waiting) < _WAITING and sum(f.shape[1] for f in free) < _ENOUGH:
            continue
        # places that may be free, where they come for the first time
        tries, at, other, code, state = np.concatenate(free, axis=1)
        new = judged.first(code)
        unsure = new[state[new] == _MIXED]
        pair = [at, other][:: 1 if one == 0 else -1]
        hit = np.zeros(len(tries), bool)
        hit[unsure] = _shown(pair[0][unsure], pair[1][unsure], boxes, side)
        new = new[~hit[new]]
        # images are only looked at until there are enough
        short, fits = target - len(accepted), np.zeros(len(new), bool)
        for i in range(0, len(new), look):
            if fits.sum() >= short:
                break
            some = new[i : i + look]
            fits[i : i + look] = tissue(pair[0][some], pair[1][some])
        good = new[fits][:short]
        made = int(tries[good[-1]]) + 1 if len(good) == short else end
        accepted.extend(zip(pair[0][good].tolist(), pair[1][good].tolist(), strict=True))
        low += int((tries[new[~fits]] < made).sum())
        if counted:
            for tries, code in waiting:
                if distinct.add(code[: np.searchsorted(tries, made)]):
                    open_ &= np.diff(np.searchsorted(distinct.merged, lines.astype(distinct.kind))) < places.sides[two]
        waiting, free = [], []
    count: dict[str, int | None] = dict.fromkeys(_COUNTS) | {"accepted": len(accepted)}
    if counted:
        # once all places were there, what is left to try was there too
        made, n = limit if len(accepted) < target else made, distinct.count()
        count |= {"duplicate": made - n, "annotation": n - len(accepted) - low, "low_tissue": low}
    return count, *np.array(accepted, np.int64).reshape(-1, 2).T


def _made(drawn: bytes, target: int, tissue: Callable, *, per: int = TRIES, look: int = 1024) -> tuple[dict[str, int | None], np.ndarray, np.ndarray] | None:
    """As ``sample``, of tries that the JVM has made (``Tries.java``); None if it stopped too early."""
    (_, distinct, full), free = np.split(np.frombuffer(drawn, "<i8"), [3])
    tries, x0, y0, so_far = free.reshape(-1, 4).T
    fits = np.zeros(len(tries), bool)
    for i in range(0, len(tries), look):
        if fits.sum() >= target:
            break
        fits[i : i + look] = tissue(x0[i : i + look], y0[i : i + look])
    good = np.flatnonzero(fits)[:target]
    if len(good) == target:
        made, n, low = int(tries[good[-1]]) + 1, int(so_far[good[-1]]), int(good[-1]) + 1 - target
    elif full:
        return None
    else:
        made, n, low = target * per, int(distinct), len(tries) - len(good)
    return {"accepted": len(good), "duplicate": made - n, "annotation": n - len(good) - low, "low_tissue": low}, x0[good], y0[good]


def _drawn(spark: SparkSession, *, per: int = TRIES, every: int = EVERY, seed: int = 42, side: int = SIDE, counted: bool = True, **_: int) -> Column:
    """The tries of a slide, made by the JVM; null where it doesn't."""
    tries = jvm.tries(spark) if counted else None
    if tries is None:
        return F.lit(None).cast("binary")
    numbers = F.lit([per, every, seed, side, _CELL, _CELLS, _TO_JVM, _SPARE]).cast("array<bigint>")
    shares = F.lit([MIN_VISIBLE, *_radius().tolist()]).cast("array<double>")
    return tries(*(F.col(c).cast("bigint") for c in ("slide_id", "width", "height")), F.col("boxes").cast("array<struct<x1:double,y1:double,x2:double,y2:double>>"), numbers, shares)


def sampled(slides: DataFrame, annotations: DataFrame, tissue: Callable, **options: int) -> DataFrame:
    """One row a slide that has annotations: target, counts by reason (null but the accepted ones, unless ``counted``), and the accepted origins in order."""
    n = 4 * slides.sparkSession.sparkContext.defaultParallelism
    sides = ("x1", "y1", "x2", "y2")
    boxes = annotations.join(slides, "slide_id").repartition(n, "slide_id").groupBy("slide_id").agg(F.first("width").alias("width"), F.first("height").alias("height"), F.collect_list(F.struct(*sides)).alias("boxes"))
    boxes = boxes.withColumn("drawn", _drawn(slides.sparkSession, **options))
    of_made = {k: v for k, v in options.items() if k in ("per", "look")}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, widths, heights = (b.column(i).to_pylist() for i in range(3))
            ends = np.asarray(b.column(3).offsets)
            both = np.stack([np.asarray(v) for v in b.column(3).flatten().flatten()])
            out = []
            for i in range(len(b)):
                drawn, target = b.column(4)[i].as_py(), int(ends[i + 1] - ends[i])
                made = None if drawn is None else _made(drawn, target, tissue, **of_made)
                out.append(made or sample(ids[i], widths[i], heights[i], both[:, ends[i] - ends[0] : ends[i + 1] - ends[0]], tissue, **options))
            counts = [pa.array([c[k] for c, _, _ in out], pa.int64()) for k in _COUNTS]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(ends), pa.int64()), *counts, *[pa.array([o[k] for o in out], pa.list_(pa.int64())) for k in (1, 2)]], ["slide_id", "target", *_COUNTS, "xs", "ys"])

    return boxes.mapInArrow(rows, "slide_id bigint, target bigint, " + ", ".join(f"{c} bigint" for c in _COUNTS) + ", xs array<bigint>, ys array<bigint>")


def negatives(sampled: DataFrame) -> DataFrame:
    at = sampled.select("slide_id", F.posexplode(F.arrays_zip("xs", "ys"))).select("slide_id", (F.col("pos") + 1).cast("bigint").alias("ordinal"), F.col("col.xs").alias("x0"), F.col("col.ys").alias("y0"))
    return at.withColumn("stem", F.format_string("s%d_neg_%06d_x%d_y%d", "slide_id", "ordinal", "x0", "y0"))


def reject_stats(sampled: DataFrame) -> DataFrame:
    """Accepted tries and reasons a slide; the shortfall counts as failed and as stopped by the limit of tries."""
    short = F.col("target") - F.col("accepted")
    return sampled.select("slide_id", *_COUNTS, short.alias("failed_neg"), short.alias("try_limit"))
