"""Settings of a build: an immutable value, checked on the driver and sent to tasks with their functions."""

from __future__ import annotations

import dataclasses
import os
from dataclasses import dataclass

TASKS, SPLIT_MODES, IMAGE_SUFFIXES = ("detect",), ("wsi", "patch"), (".jpg", ".jpeg", ".png")


@dataclass(frozen=True)
class BuildConfig:
    # fixed values: the defaults users know
    target_dir: str = ""
    output_dir: str = "dataset"
    tile_size: int = 1024
    num_workers: int = max(1, min(12, os.cpu_count() or 4))
    train_ratio: float = 0.75
    val_ratio: float = 0.25
    split_mode: str = "patch"
    task: str = "detect"
    color_augment: bool = True
    seed: int = 42
    class_id: int = 0
    class_name: str = "micropapillary"
    image_ext: str = ".jpg"
    jpeg_quality: int = 90
    empty_label_for_negative: bool = True
    slide_backend: str = "auto"
    cucim_device: str | None = "cuda"
    dry_run: bool = False
    max_neg_tries_per_positive: int = 5000
    write_report: bool = True
    recursive: bool = True
    clahe_clip: tuple[float, float] = (1.5, 2.5)
    clahe_grid: int = 8
    hue_shift: tuple[int, int] = (-4, 4)
    sat_shift: tuple[int, int] = (-12, 12)
    val_shift: tuple[int, int] = (-10, 10)
    brightness: tuple[float, float] = (-0.08, 0.08)
    contrast: tuple[float, float] = (-0.10, 0.10)
    gamma: tuple[int, int] = (90, 110)

    def snapshot(self) -> dict:
        """All settings by name, for a report or for ``of``."""
        return dataclasses.asdict(self)

    @classmethod
    def of(cls, snapshot: dict) -> BuildConfig:
        """The settings of a snapshot; lists, as JSON has them, count as pairs."""
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in snapshot.items()})

    def report_block(self) -> dict:
        """Those settings that a report shows."""
        names = ("target_dir", "output_dir", "tile_size", "num_workers", "split_mode", "task", "color_augment", "dry_run", "seed", "slide_backend", "cucim_device")
        return {n.upper(): getattr(self, n) for n in names} | {"SPLIT_RATIOS": {"train": self.train_ratio, "val": self.val_ratio}}

    def validate(self) -> None:
        """Raises ValueError (or NotImplementedError, for an unknown task) at the first setting that can't work."""
        wrong = (
            (self.tile_size <= 0, f"tile_size must be above 0: {self.tile_size}"),
            (self.num_workers < 1, f"num_workers must be at least 1: {self.num_workers}"),
            (self.split_mode not in SPLIT_MODES, f"split_mode must be one of {SPLIT_MODES}: {self.split_mode}"),
            (abs(self.train_ratio + self.val_ratio - 1) > 0.001, f"the split ratios must add up to 1: {self.train_ratio} + {self.val_ratio}"),
            (self.train_ratio <= 0, f"train_ratio must be above 0: {self.train_ratio}"),
            (self.val_ratio <= 0, f"val_ratio must be above 0: {self.val_ratio}"),
            (self.max_neg_tries_per_positive < 1, "max_neg_tries_per_positive must be at least 1"),
        )
        for bad, what in wrong:
            if bad:
                raise ValueError(what)
        self.validate_format()

    def validate_format(self) -> None:
        if self.task not in TASKS:
            raise NotImplementedError(f"only tasks {TASKS}: {self.task}")
        wrong = (
            (isinstance(self.class_id, bool) or not isinstance(self.class_id, int) or self.class_id < 0, f"class_id must be a whole number from 0: {self.class_id}"),
            (not isinstance(self.class_name, str) or not self.class_name, "class_name must be a text that isn't empty"),
            (self.image_ext.lower() not in IMAGE_SUFFIXES, f"image_ext must be one of {IMAGE_SUFFIXES}: {self.image_ext}"),
            (not 1 <= self.jpeg_quality <= 100, f"jpeg_quality must be from 1 to 100: {self.jpeg_quality}"),
        )
        for bad, what in wrong:
            if bad:
                raise ValueError(what)

    def validate_paths(self, wsi_path: str | None = None, geojson_path: str | None = None) -> None:
        """Raises FileNotFoundError where a root isn't there."""
        root = wsi_path if wsi_path is not None else self.target_dir
        for p in (root, *([geojson_path] if geojson_path is not None else [])):
            if not os.path.exists(p):
                raise FileNotFoundError(p)
