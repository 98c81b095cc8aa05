"""Boxes and tiles as Column functions. A box is four columns x1, y1, x2, y2; a tile is (x0, y0) and a side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MIN_VISIBLE = 0.30


def overlaps(x1: Column, y1: Column, x2: Column, y2: Column, x0: Column, y0: Column, side: int) -> Column:
    """Half-open overlap: touching edges don't count."""
    return (x2 > x0) & (x1 < x0 + side) & (y2 > y0) & (y1 < y0 + side)


def clipped(x1: Column, y1: Column, x2: Column, y2: Column, x0: Column, y0: Column, side: int) -> tuple[Column, Column, Column, Column]:
    """The part of the box inside the tile; meaningful only where they overlap."""
    return F.greatest(x1, x0.cast("double")), F.greatest(y1, y0.cast("double")), F.least(x2, (x0 + side).cast("double")), F.least(y2, (y0 + side).cast("double"))


def visible_ratio(box: tuple[Column, ...], part: tuple[Column, ...]) -> Column:
    area = (box[2] - box[0]) * (box[3] - box[1])
    return F.when(area <= 0, F.lit(0.0)).otherwise((part[2] - part[0]) * (part[3] - part[1]) / F.when(area > 0, area).otherwise(1.0))


def normalised(part: tuple[Column, ...], x0: Column, y0: Column, side: int) -> dict[str, Column]:
    """Centre and size of a clipped box in units of the tile."""
    return {"xc": ((part[0] + part[2]) / 2 - x0) / side, "yc": ((part[1] + part[3]) / 2 - y0) / side, "w": (part[2] - part[0]) / side, "h": (part[3] - part[1]) / side}


def clamp_origin(v: Column, extent: Column, side: int) -> Column:
    """Keeps a tile inside the slide; a slide smaller than the tile has the origin 0."""
    return F.greatest(F.lit(0).cast("bigint"), F.least(v, (extent - side).cast("bigint")))


def centred_origin(a: Column, b: Column, extent: Column, side: int) -> Column:
    """Origin of a tile around the middle of [a, b], which is cut toward zero."""
    return clamp_origin(((a + b) / 2).cast("bigint") - side // 2, extent, side)


def half_even(v: Column) -> Column:
    return F.rint(v).cast("bigint")


def uniform(seed: int, tag: str, *keys: Column) -> Column:
    """A number in [0, 1) that seed, keys and tag decide: the first 32 bits of an md5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys], F.lit(tag))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def six_decimals(v: Column) -> Column:
    """%.6f of a value below 1000, rounded half-even on its exact binary value."""
    return F.format_number(v, 6)
