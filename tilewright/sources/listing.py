"""File listings. They are made on the driver, as Spark's own file index leaves out empty and hidden files."""

from __future__ import annotations

import os
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tilewright.operators.pairing import ANNOTATION_SUFFIXES, SLIDE_SUFFIXES


def by_parts(path: str) -> list[str]:
    """What paths are ordered by: their components, not their characters."""
    return path.split("/")


def suffix_of(path: str) -> str:
    return os.path.splitext(os.path.basename(path))[1].lower() if not path.endswith(".") else ""


def walk(root: str, recursive: bool = True) -> list[str]:
    """All files of a folder, hidden and empty ones too, in the order of paths; a file is a listing of its own."""
    if os.path.isfile(root):
        return [root]
    if not os.path.isdir(root):
        raise FileNotFoundError(root)
    found = []
    for folder, inner, names in os.walk(root):
        found += [p for n in names if os.path.isfile(p := os.path.join(folder, n))]
        if not recursive:
            inner.clear()
    return sorted(found, key=by_parts)


def normalised_suffixes(suffixes: Iterable[str]) -> tuple[str, ...]:
    """Trimmed, in lower case, with a dot, each once, in the given order; empty ones go."""
    named = (s.strip().lower() for s in suffixes)
    return tuple(dict.fromkeys(s if s.startswith(".") else "." + s for s in named if s))


def of_suffixes(root: str, suffixes: Iterable[str], recursive: bool = True) -> list[str]:
    """Files of a folder that have one of the suffixes. A root that is a file is an error."""
    if os.path.isfile(root):
        raise NotADirectoryError(root)
    wanted = set(normalised_suffixes(suffixes))
    return [p for p in walk(root, recursive) if suffix_of(p) in wanted]


def as_frame(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.createDataFrame([(p,) for p in paths], "path string")


@dataclass(frozen=True)
class Roots:
    """Where slides and annotations are looked for, and what was found there."""

    wsi_root: str
    gt_root: str
    slides: list[str]
    annotations: list[str]
    scanned: int

    @property
    def explicit(self) -> bool:
        """Both roots are files: they are a pair, whatever their names."""
        return os.path.isfile(self.wsi_root) and os.path.isfile(self.gt_root)


def scan(wsi_root: str, gt_root: str | None = None, recursive: bool = True) -> Roots:
    """Lists both roots; one that serves both is counted once. Without its own root, annotations are looked for beside the slides."""
    gt_root = gt_root or (os.path.dirname(wsi_root) if os.path.isfile(wsi_root) else wsi_root)
    one, two = walk(wsi_root, recursive), walk(gt_root, recursive)
    total = len(one) if wsi_root == gt_root else len(one) + len(two)
    return Roots(wsi_root, gt_root, [p for p in one if suffix_of(p) in SLIDE_SUFFIXES], [p for p in two if suffix_of(p) in ANNOTATION_SUFFIXES], total)


def texts(spark: SparkSession, paths: list[str], parallelism: int | None = None) -> DataFrame:
    """(path, text, error): each file read by a task, as strict UTF-8. Folders must be seen by all executors."""
    n = max(1, min(len(paths), parallelism or spark.sparkContext.defaultParallelism * 4))

    def read(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for b in batches:
            for p in b.column(0).to_pylist():
                text, error = None, None
                try:
                    with open(p, encoding="utf-8") as f:
                        text = f.read()
                except (OSError, UnicodeDecodeError) as e:
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([text], pa.string()), pa.array([error], pa.string())], ["path", "text", "error"])

    return as_frame(spark, paths).repartition(n).mapInArrow(read, "path string, text string, error string")
