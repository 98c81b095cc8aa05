"""The build: from slide and annotation files to a dataset, its totals and its report.

Pairing, parsing, tiles, boxes and splits are one plan over all slides. Two steps read
slides, each slide in one task with one open reader: the sampling of negatives (its tissue
test looks at pixels) and the writing of tiles, which a slide's tiles are dealt to in
parts. A slide that can't be opened or parsed is a row with its error, and the others go on.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.config import BuildConfig
from tilewright.functions import paths as p
from tilewright.operators import geojson, labels, pairing, pixels, reporting, sampling, tiles
from tilewright.sinks.dataset import dataset_format, put
from tilewright.sources import listing
from tilewright.sources.slides import SlideReader, opened

#: Tiles of a slide that a task writes, at most.
PART = 64


def discover(spark: SparkSession, cfg: BuildConfig, wsi_path: str | None = None, geojson_path: str | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """Pairs (slide_id, wsi_path, gt_path, slide_stem), annotation files (path, text, error), and what was found."""
    roots = listing.scan(wsi_path or cfg.target_dir, geojson_path, cfg.recursive)
    found = listing.as_frame(spark, [*roots.slides, *roots.annotations])
    if roots.explicit:
        pair = [(roots.slides[0], roots.annotations[0], False)] if roots.slides and roots.annotations else [(s, None, False) for s in roots.slides]
        made = spark.createDataFrame(pair, "wsi_path string, gt_path string, ambiguous boolean")
    else:
        made = pairing.pairs(found)
    texts = listing.texts(spark, roots.annotations)
    checked = geojson.validate(texts.select("path", F.col("text").alias("doc")), key="path")
    counters = pairing.diagnostics(found, made, checked).first().asDict()
    counters |= {"total_files": roots.scanned, "recursive_discovery": cfg.recursive, "wsi_path": roots.wsi_root, "geojson_path": roots.gt_root}
    order = {s: i for i, s in enumerate(roots.slides)}
    ids = spark.createDataFrame([(i, s) for s, i in order.items()], "slide_id bigint, wsi_path string")
    matched = made.where(F.col("gt_path").isNotNull()).select("wsi_path", "gt_path").join(ids, "wsi_path")
    return matched.select("slide_id", "wsi_path", "gt_path", p.stem(F.col("wsi_path")).alias("slide_stem")), texts, counters


def _by_slide(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    """run(row as a dict) -> rows as dicts, over rows that stand for slides or parts of them."""
    names = [f.split()[0] for f in schema.split(", ")]

    def batches(arrow: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in arrow:
            for row in b.to_pylist():
                out = list(run(row))
                if out:
                    yield pa.RecordBatch.from_pylist([{n: r.get(n) for n in names} for r in out], schema=to_arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    to_arrow = to_arrow_schema(StructType.fromDDL(schema))
    return rows.mapInArrow(batches, schema)


def facts(pairs: DataFrame, open_with: Callable) -> DataFrame:
    """Pairs with the slide's width and height, or what went wrong when it was opened."""

    def run(row: dict) -> Iterator[dict]:
        try:
            with SlideReader(row["wsi_path"], open_with=open_with) as s:
                width, height = s.dimensions
            yield row | {"width": width, "height": height, "error": None}
        except Exception as e:  # noqa: BLE001  any failure is the slide's alone
            yield row | {"width": None, "height": None, "error": f"{type(e).__name__}: {e}"}

    return _by_slide(pairs.select("slide_id", "wsi_path", "gt_path", "slide_stem"), run, "slide_id bigint, wsi_path string, gt_path string, slide_stem string, width bigint, height bigint, error string")


def sampled(slides: DataFrame, annotations: DataFrame, cfg: BuildConfig, open_with: Callable) -> DataFrame:
    """Counts by reason and accepted origins of each slide, by the tissue of its pixels."""
    sides = ("x1", "y1", "x2", "y2")
    boxes = annotations.join(slides, "slide_id").groupBy("slide_id", "wsi_path", "width", "height").agg(F.collect_list(F.struct(*sides)).alias("boxes"))

    def run(row: dict) -> Iterator[dict]:
        flat = np.array([[b[k] for b in row["boxes"]] for k in sides], float)
        with SlideReader(row["wsi_path"], open_with=open_with) as s:
            tissue = lambda xs, ys: np.array([pixels.tissue_share(s.read_tile(int(x), int(y), cfg.tile_size)) >= pixels.MIN_TISSUE for x, y in zip(xs, ys, strict=True)], bool)
            count, xs, ys = sampling.sample(row["slide_id"], row["width"], row["height"], flat, tissue, per=cfg.max_neg_tries_per_positive, seed=cfg.seed, side=cfg.tile_size, look=16)
        yield count | {"slide_id": row["slide_id"], "target": flat.shape[1], "xs": xs.tolist(), "ys": ys.tolist()}

    return _by_slide(boxes, run, "slide_id bigint, target bigint, accepted bigint, duplicate bigint, annotation bigint, low_tissue bigint, xs array<bigint>, ys array<bigint>")


def samples(slides: DataFrame, annotations: DataFrame, tried: DataFrame, cfg: BuildConfig) -> DataFrame:
    """All tiles, positive and negative: origin, stem, split and label text."""
    pos = tiles.positives(annotations, slides.select("slide_id", "width", "height"), cfg.tile_size)
    text = labels.label_texts(tiles.visible_boxes(pos, annotations, cfg.tile_size), cfg.class_id)
    at = ["slide_id", "ordinal", "x0", "y0"]
    pos = pos.select(*at).join(text, ["slide_id", "ordinal"], "left").select(*at, F.coalesce("text", F.lit("")).alias("label"), F.lit("pos").alias("kind"))
    both = pos.unionByName(sampling.negatives(tried).select(*at, F.lit("").alias("label"), F.lit("neg").alias("kind")))
    stem = F.format_string("%s_%s_%06d_x%d_y%d", "slide_stem", "kind", "ordinal", "x0", "y0")
    out = both.join(slides.select("slide_id", "wsi_path", "slide_stem"), "slide_id").withColumn("stem", stem)
    if cfg.split_mode == "wsi":
        return out.join(tiles.slide_split(slides, cfg.train_ratio, cfg.seed).select("slide_id", "split"), "slide_id")
    return tiles.tile_split(out, cfg.train_ratio, cfg.seed)


def written(made: DataFrame, cfg: BuildConfig, open_with: Callable) -> DataFrame:
    """Writes all samples: (slide_id, split, n) by part of a slide."""
    part = F.floor((F.col("ordinal") - 1) / PART)
    tile = F.struct("stem", "split", "label", "x0", "y0")
    parts = made.groupBy("slide_id", "wsi_path", "kind", part.alias("part")).agg(F.collect_list(tile).alias("tiles"))

    def run(row: dict) -> Iterator[dict]:
        out, n = dataset_format(cfg), dict.fromkeys(("train", "val"), 0)
        with SlideReader(row["wsi_path"], open_with=open_with) as s:
            for t in row["tiles"]:
                n[t["split"]] += out.write(t["stem"], t["split"], s.read_tile(t["x0"], t["y0"], cfg.tile_size), t["label"])
        for split, k in n.items():
            yield {"slide_id": row["slide_id"], "split": split, "n": k}

    return _by_slide(parts.select("slide_id", "wsi_path", "tiles"), run, "slide_id bigint, split string, n bigint")


def results(slides: DataFrame, counts: DataFrame, tried: DataFrame, done: DataFrame) -> DataFrame:
    """One row a slide with all its counters, status, reason and error."""
    w = done.groupBy("slide_id").agg(*[F.sum(F.when(F.col("split") == s, F.col("n")).otherwise(0)).alias(f"written_{s}") for s in ("train", "val")])
    j = slides.join(counts, "slide_id", "left").join(tried.drop("xs", "ys"), "slide_id", "left").join(w, "slide_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    bad = F.coalesce("error", F.when(F.coalesce("parse_error", F.lit(True)), F.lit("the annotation file doesn't parse")))
    empty = bad.isNull() & (zero("annotation_count") == 0)
    short = zero("target") - zero("accepted")
    return j.select(
        "slide_stem",
        F.when(bad.isNotNull(), 0).otherwise(zero("annotation_count")).cast("bigint").alias("raw_pos"),
        zero("accepted").alias("raw_neg"),
        *[zero(f"written_{s}").alias(f"written_{s}") for s in ("train", "val")],
        short.alias("failed_neg"),
        F.when(bad.isNotNull(), "failed").when(empty, "skipped").otherwise("ok").alias("status"),
        F.when(empty, "empty_annotations").otherwise("").alias("skip_reason"),
        F.coalesce(bad, F.lit("")).alias("error"),
        *[zero(c).alias(f"neg_reject_{c}") for c in ("duplicate", "annotation", "low_tissue")],
        short.alias("neg_reject_try_limit"),
    )


def estimated(spark: SparkSession, pairs: DataFrame, texts: DataFrame, cfg: BuildConfig) -> DataFrame:
    """What a build would come to, from annotation counts alone."""
    docs = pairs.select("slide_id", "slide_stem", F.col("gt_path").alias("path")).join(texts, "path")
    n = dataset_format(cfg).variant_count()
    counts = geojson.validate(docs.select("slide_id", F.col("text").alias("doc")))
    made = tiles.dry_run_by_slide(counts, tiles.slide_split(pairs, cfg.train_ratio, cfg.seed), n) if cfg.split_mode == "wsi" else tiles.dry_run(counts, n, cfg.train_ratio)
    ok = F.col("status") == "ok"
    zero = F.lit(0).cast("bigint")
    j = docs.select("slide_id", "slide_stem", "error").join(made, "slide_id")
    return j.select(
        "slide_stem",
        *[F.when(ok, F.col(a)).otherwise(zero).alias(b) for a, b in (("raw_pos", "raw_pos"), ("raw_neg", "raw_neg"), ("train", "written_train"), ("val", "written_val"))],
        zero.alias("failed_neg"),
        "status",
        F.when(F.col("status") == "skipped", "empty_annotations").otherwise("").alias("skip_reason"),
        F.when(F.col("status") == "failed", F.coalesce("error", F.lit("the annotation file doesn't parse"))).otherwise("").alias("error"),
        *[zero.alias(f"neg_reject_{c}") for c in ("duplicate", "annotation", "low_tissue", "try_limit")],
    )


def run(spark: SparkSession, cfg: BuildConfig, wsi_path: str | None = None, geojson_path: str | None = None, *, open_with: Callable | None = None, say: Callable = print) -> dict:
    """The whole build; returns its report. Folders must be seen by all executors."""
    cfg.validate_paths(wsi_path, geojson_path)
    cfg.validate()
    out = dataset_format(cfg)
    out.validate()
    open_with = open_with or partial(opened, backend=cfg.slide_backend, device=cfg.cucim_device)
    pairs, texts, found = discover(spark, cfg, wsi_path, geojson_path)
    say(f"pairs: {found['matched']}, unmatched slides: {found['unmatched']}, ambiguous: {found['ambiguous']}, orphan annotation files: {found['orphans']}, invalid: {found['invalid_annotations']}, empty: {found['empty_annotations']}")
    if not found["matched"]:
        return {"discovery": found}
    out.prepare()
    if cfg.dry_run:
        made = estimated(spark, pairs, texts, cfg).persist()
    else:
        docs = pairs.select("slide_id", F.col("gt_path").alias("path")).join(texts, "path").select("slide_id", F.col("text").alias("doc"))
        slides = facts(pairs, open_with).persist()
        good = slides.where(F.col("error").isNull())
        annotations = geojson.annotations(docs).join(good.select("slide_id"), "slide_id", "left_semi").persist()
        tried = sampled(good, annotations, cfg, open_with).persist()
        done = written(samples(good, annotations, tried, cfg), cfg, open_with).persist()
        made = results(slides, geojson.validate(docs), tried, done).persist()
    total = reporting.totals(made).first().asDict()
    for line in reporting.summary(total, cfg.output_dir):
        say(line)
    document = reporting.report(cfg, found, made, total)
    out.describe()
    if cfg.dry_run:
        say(reporting.as_json(document))
    elif cfg.write_report:
        put(os.path.join(cfg.output_dir, "build_report.json"), reporting.as_json(document).encode())
    return document
