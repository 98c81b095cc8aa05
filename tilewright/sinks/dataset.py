"""Writing a dataset: a tree of images and label files, its description, and the interface of output formats.

Tasks write a file under a temporary name beside its place and rename it, so a task that is
run again leaves the same files and none that is half written.
"""

from __future__ import annotations

import os
import shutil
import uuid
from abc import ABC, abstractmethod
from random import Random

import numpy as np

from tilewright.config import BuildConfig
from tilewright.functions import images
from tilewright.operators import pixels

SPLITS = ("train", "val")
#: What tells a tree that may be written anew from a folder of something else.
_MARKS = {"images", "labels", "dataset.yaml", "build_report.json"}


def put(path: str, data: bytes) -> None:
    """Writes a file at once: nobody sees a part of it."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}.part"
    with open(part, "wb") as f:
        f.write(data)
    os.replace(part, path)


class DatasetFormat(ABC):
    """An output format: checks its settings, lays out the folder, writes samples where they are made, and describes the whole."""

    name: str

    def __init__(self, cfg: BuildConfig) -> None:
        self.cfg = cfg

    @abstractmethod
    def validate(self) -> None: ...

    @abstractmethod
    def prepare(self) -> None: ...

    @abstractmethod
    def write(self, stem: str, split: str, image: np.ndarray, label: str) -> int:
        """Writes a sample's variants and returns how many they are."""

    @abstractmethod
    def describe(self) -> None: ...

    def variant_count(self) -> int:
        return len(pixels.VARIANTS) if self.cfg.color_augment else 1


class DetectFormat(DatasetFormat):
    """Images and one text of boxes for each: a class and four normalised numbers a line."""

    name = "yolo_detect"

    def validate(self) -> None:
        self.cfg.validate_format()

    def prepare(self) -> None:
        """Makes the tree anew. A folder that holds anything but a dataset isn't deleted."""
        root = self.cfg.output_dir
        if self.cfg.dry_run:
            return
        if os.path.isdir(root):
            other = set(os.listdir(root)) - _MARKS
            if other:
                raise FileExistsError(f"{root} holds {sorted(other)[:3]}, so it isn't taken for a dataset")
            shutil.rmtree(root)
        for kind in ("images", "labels"):
            for split in SPLITS:
                os.makedirs(os.path.join(root, kind, split))

    def write(self, stem: str, split: str, image: np.ndarray, label: str) -> int:
        """Draws of the variants hang on the seed and the stem alone."""
        if self.cfg.dry_run:
            return self.variant_count()
        made = pixels.variants(image, Random(f"{self.cfg.seed}|{stem}"), self.cfg.color_augment)
        for name, variant in made:
            at = os.path.join(self.cfg.output_dir, "images", split, f"{stem}_{name}{self.cfg.image_ext}")
            put(at, images.encode(variant, self.cfg.image_ext, self.cfg.jpeg_quality))
            self.write_label(os.path.join(self.cfg.output_dir, "labels", split, f"{stem}_{name}.txt"), label)
        return len(made)

    def write_label(self, path: str, label: str) -> None:
        """An empty label is an empty file, or none where settings say so."""
        if label or self.cfg.empty_label_for_negative:
            put(path, label.encode())
        elif os.path.exists(path):
            os.unlink(path)

    def describe(self) -> None:
        if not self.cfg.dry_run:
            root = self.cfg.output_dir.replace(os.sep, "/")
            put(os.path.join(self.cfg.output_dir, "dataset.yaml"), f"path: {root}\ntrain: images/train\nval: images/val\nnames:\n  {self.cfg.class_id}: {self.cfg.class_name}\n".encode())


FORMATS = {"detect": DetectFormat}


def dataset_format(cfg: BuildConfig) -> DatasetFormat:
    """The format of a task."""
    if cfg.task not in FORMATS:
        raise NotImplementedError(f"no format for the task {cfg.task}")
    return FORMATS[cfg.task](cfg)
