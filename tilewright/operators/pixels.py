"""Pixel operators: as columns over rows of pixels, and as numpy over whole images."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as tissue, and the names of variants.
MIN_TISSUE = 0.10
MIN_SATURATION, MAX_VALUE = 12, 245
VARIANTS = ("orig", "clahe", "hsv", "brightness_contrast", "gamma")


def value(r: Column, g: Column, b: Column) -> Column:
    return F.greatest(r, g, b)


def saturation(r: Column, g: Column, b: Column) -> Column:
    """8-bit saturation, rounded half up in whole numbers."""
    v, low = F.greatest(r, g, b), F.least(r, g, b)
    return F.when(v == 0, 0).otherwise(F.floor((510 * (v - low) + v) / (2 * F.greatest(v, F.lit(1)))).cast("int"))


def tissue_ratio(pixels: DataFrame) -> DataFrame:
    """Share of each tile's pixels that are saturated and not bright."""
    rgb = [F.col(c) for c in "rgb"]
    on = (saturation(*rgb) > MIN_SATURATION) & (value(*rgb) < MAX_VALUE)
    return pixels.groupBy("tile_id").agg(F.count_if(on).alias("tissue"), F.count("*").alias("n")).withColumn("ratio", F.col("tissue") / F.col("n"))


def gamma_table(gamma: float) -> list[int]:
    return [int((i / 255.0) ** gamma * 255) for i in range(256)]


def gamma(v: Column, table: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in table]), v.cast("int") + 1)


def brightness_contrast(v: Column, contrast: float, brightness: float) -> Column:
    """Scaled and shifted, clipped, cut to a whole number."""
    return F.floor(F.greatest(F.lit(0.0), F.least(F.lit(255.0), v * F.lit(1 + contrast) + F.lit(brightness * 255)))).cast("int")


def shifted_hsv(r: Column, g: Column, b: Column, dh: int, ds: int, dv: int) -> tuple[Column, Column, Column]:
    """``shift_hsv`` as columns: hue, saturation and value shifted and clipped, back to red, green and blue."""
    v, low = F.greatest(r, g, b), F.least(r, g, b)
    d = v - low
    safe = F.greatest(d, F.lit(1)).cast("double")
    h = F.when(v == r, 60.0 * (g - b) / safe).when(v == g, 120 + 60.0 * (b - r) / safe).otherwise(240 + 60.0 * (r - g) / safe)
    h = F.when(d == 0, F.lit(0.0)).when(h < 0, h + 360).otherwise(h) / 2
    clip = lambda x, top: F.greatest(F.lit(0), F.least(F.lit(top), x)).cast("double")
    h = clip(F.rint(h).cast("int") % 180 + dh, 179) / 30
    s, v = clip(saturation(r, g, b) + ds, 255) / 255, clip(v + dv, 255)

    def part(n: int) -> Column:
        k = (n + h) % 6
        return F.rint(v - v * s * F.greatest(F.lit(0.0), F.least(k, 4 - k, F.lit(1.0)))).cast("int")

    return part(5), part(3), part(1)


def tissue_share(image: np.ndarray) -> float:
    """Share of an image's pixels that are saturated and not bright."""
    hsv = rgb_to_hsv(image)
    return float(((hsv[..., 1] > MIN_SATURATION) & (hsv[..., 2] < MAX_VALUE)).mean())


def rgb_to_hsv(image: np.ndarray) -> np.ndarray:
    """Hue in half degrees (0..179), saturation and value in 8 bits."""
    x = image.astype(np.int32)
    v, low = x.max(-1), x.min(-1)
    d = v - low
    r, g, b = x[..., 0], x[..., 1], x[..., 2]
    safe = np.maximum(d, 1)
    h = np.where(v == r, 60.0 * (g - b) / safe, np.where(v == g, 120 + 60.0 * (b - r) / safe, 240 + 60.0 * (r - g) / safe))
    h = np.where(d == 0, 0, np.where(h < 0, h + 360, h)) / 2
    s = np.where(v == 0, 0, (510 * d + v) // (2 * np.maximum(v, 1)))
    return np.stack([np.rint(h).astype(np.int32) % 180, s, v], -1).astype(np.uint8)


def hsv_to_rgb(image: np.ndarray) -> np.ndarray:
    h, s, v = image[..., 0] * 2.0 / 60.0, image[..., 1] / 255.0, image[..., 2].astype(float)
    k = lambda n: (n + h) % 6
    part = lambda n: v - v * s * np.maximum(0, np.minimum(np.minimum(k(n), 4 - k(n)), 1))
    return np.rint(np.stack([part(5), part(3), part(1)], -1)).clip(0, 255).astype(np.uint8)


def shift_hsv(image: np.ndarray, dh: int, ds: int, dv: int) -> np.ndarray:
    """Clips rather than wraps the hue."""
    x = rgb_to_hsv(image).astype(np.int16) + np.array([dh, ds, dv], np.int16)
    return hsv_to_rgb(np.clip(x, 0, [179, 255, 255]).astype(np.uint8))


def scale(image: np.ndarray, contrast: float, brightness: float) -> np.ndarray:
    return np.clip(image.astype(np.float32) * np.float32(1 + contrast) + np.float32(brightness * 255), 0, 255).astype(np.uint8)


def apply_gamma(image: np.ndarray, g: float) -> np.ndarray:
    return np.array(gamma_table(g), np.uint8)[image]


def clahe(channel: np.ndarray, clip: float, grid: int = 8) -> np.ndarray:
    """Contrast-limited equalisation of one 8-bit channel: a table for each cell, mixed bilinearly."""
    h, w = channel.shape
    th, tw = -(-h // grid), -(-w // grid)
    x = np.pad(channel, ((0, th * grid - h), (0, tw * grid - w)), "reflect" if min(h, w) > max(th * grid - h, tw * grid - w) else "edge")
    limit = max(1, int(clip * th * tw / 256))
    tables = np.zeros((grid, grid, 256))
    for i in range(grid):
        for j in range(grid):
            hist = np.bincount(x[i * th : (i + 1) * th, j * tw : (j + 1) * tw].ravel(), minlength=256)
            over = int(np.maximum(hist - limit, 0).sum())
            hist = np.minimum(hist, limit) + over // 256
            hist[: over % 256] += 1
            tables[i, j] = np.clip(np.cumsum(hist) * 255.0 / (th * tw), 0, 255)
    fy, fx = (np.arange(h) + 0.5) / th - 0.5, (np.arange(w) + 0.5) / tw - 0.5
    y0, x0 = np.floor(fy).astype(int), np.floor(fx).astype(int)
    wy, wx = (fy - y0)[:, None], (fx - x0)[None, :]
    at = lambda y, c: tables[np.clip(y, 0, grid - 1)[:, None], np.clip(c, 0, grid - 1)[None, :], channel]
    out = (1 - wy) * ((1 - wx) * at(y0, x0) + wx * at(y0, x0 + 1)) + wy * ((1 - wx) * at(y0 + 1, x0) + wx * at(y0 + 1, x0 + 1))
    return np.rint(out).astype(np.uint8)


#: Linear red, green and blue to X, Y and Z of the sRGB standard, relative to its white.
_XYZ = np.array([[0.412453, 0.357580, 0.180423], [0.212671, 0.715160, 0.072169], [0.019334, 0.119193, 0.950227]]) / np.array([[0.950456], [1.0], [1.088754]])


def rgb_to_lab(image: np.ndarray) -> np.ndarray:
    """Lightness 0..100, a and b, as floating-point numbers."""
    c = image / 255.0
    linear = np.where(c > 0.04045, ((c + 0.055) / 1.055) ** 2.4, c / 12.92)
    t = linear @ _XYZ.T
    f = np.where(t > (6 / 29) ** 3, np.cbrt(t), t * (29 / 6) ** 2 / 3 + 4 / 29)
    return np.stack([116 * f[..., 1] - 16, 500 * (f[..., 0] - f[..., 1]), 200 * (f[..., 1] - f[..., 2])], -1)


def lab_to_rgb(lab: np.ndarray) -> np.ndarray:
    y = (lab[..., 0] + 16) / 116
    f = np.stack([y + lab[..., 1] / 500, y, y - lab[..., 2] / 200], -1)
    t = np.where(f > 6 / 29, f**3, 3 * (6 / 29) ** 2 * (f - 4 / 29))
    linear = np.clip(t @ np.linalg.inv(_XYZ).T, 0, 1)
    c = np.where(linear > 0.0031308, 1.055 * linear ** (1 / 2.4) - 0.055, 12.92 * linear)
    return np.rint(c * 255).clip(0, 255).astype(np.uint8)


def equalised(image: np.ndarray, clip: float, grid: int = 8) -> np.ndarray:
    """Contrast-limited equalisation of the lightness alone, in 8 bits."""
    lab = rgb_to_lab(image)
    lab[..., 0] = clahe(np.rint(lab[..., 0] * 2.55).astype(np.uint8), clip, grid) / 2.55
    return lab_to_rgb(lab)


def variants(image: np.ndarray, rng, augment: bool = True) -> list[tuple[str, np.ndarray]]:  # noqa: ANN001
    """The image and its four colour variants, in a fixed order, drawn from a random.Random."""
    out = [("orig", image)]
    if not augment:
        return out
    # fixed values: the ranges of all draws
    out.append(("clahe", equalised(image, rng.uniform(1.5, 2.5))))
    out.append(("hsv", shift_hsv(image, rng.randint(-4, 4), rng.randint(-12, 12), rng.randint(-10, 10))))
    b, c = rng.uniform(-0.08, 0.08), rng.uniform(-0.10, 0.10)
    out.append(("brightness_contrast", scale(image, c, b)))
    out.append(("gamma", apply_gamma(image, rng.randint(90, 110) / 100)))
    return out
