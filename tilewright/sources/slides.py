"""Slide readers: tiles of 8-bit RGB out of images of any size, by a backend of one's choice.

A backend has ``dimensions`` (width, height), ``read_region(x0, y0, side)`` and ``close()``.
Native slide libraries are optional; arrays and PNG files need nothing.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tilewright.functions import images


def as_rgb(image: np.ndarray) -> np.ndarray:
    """Any image as 8-bit RGB: grey ones three times, further channels dropped."""
    a = np.asarray(image)
    if a.ndim == 2:
        a = a[:, :, None]
    if a.shape[-1] < 3:
        a = np.repeat(a[:, :, :1], 3, axis=2)
    return a[..., :3].astype(np.uint8)


class ArrayBackend:
    """An image in memory, or one that is made from its coordinates; beyond its edges it is black."""

    name = "array"

    def __init__(self, image: np.ndarray) -> None:
        self.image = as_rgb(image)
        self.dimensions = self.image.shape[1], self.image.shape[0]

    def read_region(self, x0: int, y0: int, side: int) -> np.ndarray:
        out = np.zeros((side, side, 3), np.uint8)
        part = self.image[y0 : y0 + side, x0 : x0 + side]
        out[: part.shape[0], : part.shape[1]] = part
        return out

    def close(self) -> None:
        self.image = None


class FileBackend(ArrayBackend):
    """A PNG file or a saved numpy array."""

    name = "file"

    def __init__(self, path: str) -> None:
        if path.lower().endswith(".npy"):
            super().__init__(np.load(path, mmap_mode="r"))
        else:
            with open(path, "rb") as f:
                super().__init__(images.decode_png(f.read()))


class OpenSlideBackend:
    name = "openslide"

    def __init__(self, path: str) -> None:
        import openslide

        self._slide = openslide.OpenSlide(path)
        self.dimensions = self._slide.dimensions

    def read_region(self, x0: int, y0: int, side: int) -> np.ndarray:
        return as_rgb(np.asarray(self._slide.read_region((x0, y0), 0, (side, side))))

    def close(self) -> None:
        self._slide.close()


class CuCIMBackend:
    name = "cucim"

    def __init__(self, path: str, device: str | None = None) -> None:
        from cucim import CuImage

        self._slide, self._device = CuImage(path), device
        self.dimensions = tuple(self._slide.resolutions["level_dimensions"][0])

    def read_region(self, x0: int, y0: int, side: int) -> np.ndarray:
        got = self._slide.read_region(location=(x0, y0), size=(side, side), level=0, **({"device": self._device} if self._device else {}))
        return as_rgb(got.get() if hasattr(got, "get") else got)

    def close(self) -> None:
        if hasattr(self._slide, "close"):
            self._slide.close()


def opened(path: str, backend: str = "auto", device: str | None = None):  # noqa: ANN201
    """The backend by name. auto: cucim if it works, else openslide; files that need no library are read without one."""
    if backend == "file" or backend == "auto" and path.lower().endswith((".npy", ".png")):
        return FileBackend(path)
    if backend in ("auto", "cucim"):
        try:
            return CuCIMBackend(path, device)
        except Exception:
            if backend == "cucim":
                raise
    return OpenSlideBackend(path)


class SlideReader:
    """A slide, whose tiles always lie inside it."""

    def __init__(self, path: str, *, open_with: Callable = opened) -> None:
        self._backend = open_with(path)

    @property
    def backend_name(self) -> str:
        return self._backend.name

    @property
    def dimensions(self) -> tuple[int, int]:
        width, height = self._backend.dimensions
        return int(width), int(height)

    def clamp_origin(self, x0: int, y0: int, side: int) -> tuple[int, int]:
        return tuple(max(0, min(v, extent - side)) for v, extent in zip((x0, y0), self.dimensions, strict=True))

    def read_tile(self, x0: int, y0: int, side: int) -> np.ndarray:
        return self._backend.read_region(*self.clamp_origin(x0, y0, side), side)

    def close(self) -> None:
        self._backend.close()

    def __enter__(self) -> SlideReader:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()
