"""Tools around datasets: counting annotations, checking a dataset, rendering segmentation labels."""

from __future__ import annotations

import csv
import io
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.functions import images
from tilewright.operators import geojson, labels
from tilewright.sinks.dataset import SPLITS, put
from tilewright.sources import listing

IMAGES = (".jpg", ".jpeg", ".png")
RED, WHITE, YELLOW, CYAN = (255, 0, 0), (255, 255, 255), (255, 255, 0), (0, 255, 255)


def count(spark: SparkSession, directory: str, *, recursive: bool = False, suffixes: Iterable[str] = (".geojson", ".json")) -> DataFrame:
    """(path, count, ok, error) of every annotation file of a folder."""
    if not os.path.exists(directory):
        raise FileNotFoundError(directory)
    texts = listing.texts(spark, listing.of_suffixes(directory, suffixes, recursive))
    n = geojson.count_objects(texts.select("path", F.col("text").alias("doc")), key="path")
    return n.join(texts.select("path", "error"), "path").select("path", "count", "ok", F.coalesce("error", F.when(~F.col("ok"), F.lit("ValueError: not JSON")), F.lit("")).alias("error"))


def as_csv(rows: list) -> str:
    """Rows of ``count`` as text, ok as 0 or 1."""
    out = io.StringIO()
    w = csv.writer(out)
    w.writerow(["path", "count", "ok", "error"])
    w.writerows([r["path"], r["count"], int(r["ok"]), r["error"]] for r in rows)
    return out.getvalue()


def _decoded(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, image bytes as RGB, height, width) of image files, read by Spark's own reader."""
    if not paths:
        return spark.createDataFrame([], "path string, pixels binary, height int, width int, channels int")
    return spark.read.format("image").load(["file://" + os.path.abspath(p) if "://" not in p else p for p in paths]).select(F.regexp_replace("image.origin", "^file:/+", "/").alias("path"), F.col("image.data").alias("pixels"), "image.height", "image.width", F.col("image.nChannels").alias("channels"))


def _array(row: dict) -> np.ndarray:
    """Spark's bytes (blue first) as RGB."""
    a = np.frombuffer(row["pixels"], np.uint8).reshape(row["height"], row["width"], row["channels"])
    return np.repeat(a, 3, 2) if a.shape[2] == 1 else np.ascontiguousarray(a[:, :, 2::-1])


def _exported(rows: DataFrame, draw: Callable[[dict], tuple[str, bytes]]) -> DataFrame:
    """Paths of the files that draw(row) -> (path, bytes) gives, written by tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                path, data = draw(row)
                put(path, data)
                yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

    return rows.mapInArrow(run, "path string")


def drawn_boxes(image: np.ndarray, boxes: list[dict], negative: bool) -> np.ndarray:
    """A sample with its boxes framed, or a banner where it has none, and a strip along its foot."""
    out = image.copy()
    h, w = out.shape[:2]
    for b in boxes:
        images.frame(out, *[int(b[k]) for k in ("px1", "py1", "px2", "py2")], RED, 3)
    if negative:
        images.fill(out, 0, 0, min(w - 1, 330), 28, WHITE)
    images.fill(out, 0, h - 24, min(w - 1, 620), h - 1, WHITE)
    return out


def check(spark: SparkSession, dataset: str, output: str, *, most_pos: int = 100, most_neg: int = 100, seed: int = 42, allow_missing: bool = False, say: Callable = print) -> DataFrame:
    """Integrity of a dataset's splits, one row each; at most so many samples of each split and kind are written with their boxes drawn."""
    there = [s for s in SPLITS if all(os.path.isdir(os.path.join(dataset, k, s)) for k in ("images", "labels"))]
    for s in set(SPLITS) - set(there):
        say(f"no images or labels of {s}")
    found = [(s, os.path.splitext(os.path.basename(p))[0], p, kind) for s in there for kind, suffixes in (("images", IMAGES), ("labels", (".txt",))) for p in listing.of_suffixes(os.path.join(dataset, kind, s), suffixes, False)]
    files = spark.createDataFrame(found, "split string, stem string, path string, kind string")
    pics = files.where("kind = 'images'").drop("kind")
    text = files.where("kind = 'labels'").drop("kind").join(listing.texts(spark, [f[2] for f in found if f[3] == "labels"]).drop("error"), "path")
    told = labels.integrity(pics, text)
    if not allow_missing:
        told = told.withColumn("missing_labels", F.col("missing_labels") + F.col("allowed_missing")).withColumn("allowed_missing", F.lit(0).cast("bigint"))
    boxes = labels.parsed(text).groupBy("split", "stem").agg(F.sort_array(F.collect_list(F.struct("line_no", "xc", "yc", "w", "h"))).alias("boxes"))
    pairs = labels.paired(pics, text, allow_missing).select("split", "stem").join(pics, ["split", "stem"]).join(boxes, ["split", "stem"], "left")
    kind = F.when(F.col("boxes").isNull(), "neg").otherwise("pos")
    order = F.row_number().over(labels.Window.partitionBy("split", "kind").orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), "stem")), "stem"))
    # bounded by the two limits
    picked = pairs.withColumn("kind", kind).withColumn("rank", order).where(F.col("rank") <= F.when(F.col("kind") == "pos", most_pos).otherwise(most_neg)).persist()
    wanted = [r["path"] for r in picked.select("path").collect()]

    def draw(row: dict) -> tuple[str, bytes]:
        image = _array(row)
        h, w = image.shape[:2]
        at = lambda v, top: max(0, min(top - 1, round(v)))
        corners = [{"px1": at((b["xc"] - b["w"] / 2) * w, w), "py1": at((b["yc"] - b["h"] / 2) * h, h), "px2": at((b["xc"] + b["w"] / 2) * w, w), "py2": at((b["yc"] + b["h"] / 2) * h, h)} for b in row["boxes"] or []]
        name = os.path.basename(row["path"])
        data = images.encode(drawn_boxes(image, corners, row["kind"] == "neg"), os.path.splitext(name)[1], 95)
        return os.path.join(output, row["split"], row["kind"], f"{row['rank']:04d}_{name}"), data

    joined = picked.select("path", "split", "kind", "rank", "boxes").withColumn("path", F.regexp_replace("path", "^/+", "/")).join(_decoded(spark, wanted), "path")
    say(f"samples written: {_exported(joined, draw).count()}")
    return told


def rendered(base: np.ndarray, shapes: list[dict]) -> np.ndarray:
    """Polygons over an image: filled and mixed in at 35 %, then outlined."""
    h, w = base.shape[:2]
    over, lines = base.copy(), np.zeros((h, w), bool)
    for s in shapes:
        points = np.array([[q["x"], q["y"]] for q in s["pixels"]])
        over[images.polygon_mask(points, h, w)] = YELLOW
        lines |= images.line_mask(points, h, w, 2)
    out = np.rint(0.35 * over + 0.65 * base).astype(np.uint8)
    out[lines] = CYAN
    return out


def render(spark: SparkSession, label_dir: str, output: str, *, image_dir: str | None = None, canvas: int = 1024, most: int | None = 10, say: Callable = print) -> dict:
    """Writes a picture of each of the first label files by path; returns counts of files, empty and bad ones."""
    paths = listing.of_suffixes(label_dir, (".txt",), False)[:most]
    text = listing.texts(spark, paths)
    text = text.select(F.regexp_extract("path", r"([^/]*)\.txt$", 1).alias("stem"), F.coalesce("text", F.lit("�")).alias("text")).persist()
    checked = labels.segment_files(text)
    pics = listing.of_suffixes(image_dir, IMAGES, False) if image_dir else []
    based = labels.base_images(text, listing.as_frame(spark, pics))
    shapes = labels.segments(text).select("stem", "line_no", labels.pixel_points(F.col("points"), canvas).alias("pixels")).groupBy("stem").agg(F.sort_array(F.collect_list(F.struct("line_no", "pixels"))).alias("shapes"))
    chosen = [r["path"] for r in based.where(F.col("path").isNotNull()).collect()]
    rows = checked.where(F.col("error").isNull()).select("stem").join(shapes, "stem", "left").join(based, "stem").join(_decoded(spark, chosen), "path", "left")

    def draw(row: dict) -> tuple[str, bytes]:
        base = np.full((canvas, canvas, 3), 255, np.uint8) if row["pixels"] is None else images.resized(_array(row), canvas, canvas)
        return os.path.join(output, f"{row['stem']}_render.jpg"), images.encode_jpeg(rendered(base, row["shapes"] or []), 95)

    say(f"pictures written: {_exported(rows, draw).count()}")
    return labels.segment_totals(checked).first().asDict()
