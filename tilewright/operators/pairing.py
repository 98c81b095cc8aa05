"""Slides and their annotation files, paired by stem."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.functions import paths as p

# The suffixes that count.
SLIDE_SUFFIXES = (".svs", ".tif", ".tiff", ".ndpi", ".mrxs")
ANNOTATION_SUFFIXES = (".geojson", ".json")


def of_kind(files: DataFrame, suffixes: tuple[str, ...]) -> DataFrame:
    return files.where(F.lower(p.suffix(F.col("path"))).isin(*suffixes))


def match_stems(stem: Column) -> Column:
    return F.when(stem.endswith(".ome"), F.array(stem, F.substring(stem, F.lit(1), F.char_length(stem) - 4))).otherwise(F.array(stem))


def candidates(files: DataFrame) -> DataFrame:
    """One row a slide and matching annotation file (null where none matches), and whether both are in one folder."""
    slides = of_kind(files, SLIDE_SUFFIXES).select(F.col("path").alias("wsi_path"), p.parent(F.col("path")).alias("dir"), F.explode(match_stems(p.stem(F.col("path")))).alias("stem"))
    found = of_kind(files, ANNOTATION_SUFFIXES).select(F.col("path").alias("gt_path"), p.parent(F.col("path")).alias("gt_dir"), p.stem(F.col("path")).alias("stem"))
    return slides.join(found, "stem", "left").select("wsi_path", "gt_path", F.coalesce(F.col("dir") == F.col("gt_dir"), F.lit(False)).alias("same_dir"))


def pairs(files: DataFrame) -> DataFrame:
    """Each slide's best file: in its own folder before others, then by path; null where none matches. ambiguous: several are as near."""
    rank = F.struct(~F.col("same_dir"), F.split("gt_path", "/"))
    c = candidates(files).groupBy("wsi_path").agg(F.min_by("gt_path", F.when(F.col("gt_path").isNotNull(), rank)).alias("gt_path"), F.count_if("same_dir").alias("near"), F.count_if(F.col("gt_path").isNotNull() & ~F.col("same_dir")).alias("far"))
    return c.select("wsi_path", "gt_path", F.when(F.col("near") > 0, F.col("near") > 1).otherwise(F.col("far") > 1).alias("ambiguous"))


def probed(files: DataFrame) -> DataFrame:
    """Each slide's file in its own folder alone, by suffix and then with the whole stem before the shortened one; null where there is none."""
    beside = candidates(files).where("same_dir")
    path = F.col("gt_path")
    rank = F.struct(p.suffix(path), p.stem(path) != p.stem(F.col("wsi_path")))
    lower = beside.where(p.suffix(path).isin(*ANNOTATION_SUFFIXES)).groupBy("wsi_path").agg(F.min_by("gt_path", rank).alias("gt_path"))
    slides = of_kind(files, SLIDE_SUFFIXES).select(F.col("path").alias("wsi_path"))
    return slides.join(lower, "wsi_path", "left")


def diagnostics(files: DataFrame, made: DataFrame | None = None, validated: DataFrame | None = None) -> DataFrame:
    """One row: files, slides, annotation files, matched and unmatched slides, orphan annotation files, ambiguous slides.

    validated: rows of ``geojson.validate`` with a path for each annotation file; then what is invalid or empty is counted too.
    """
    made = pairs(files) if made is None else made
    gt = of_kind(files, ANNOTATION_SUFFIXES)
    orphans = gt.join(made.select(F.col("gt_path").alias("path")), "path", "left_anti")
    one, none = F.lit(1), F.lit(0)
    names = ("total_files", "slides", "matched", "unmatched", "ambiguous", "annotation_files", "orphans", "invalid_annotations", "empty_annotations", "skipped_features")

    def flags(df: DataFrame, **told: Column) -> DataFrame:
        return df.select(*[told.get(n, none).cast("bigint").alias(n) for n in names])

    found = F.col("gt_path").isNotNull()
    rows = flags(files, total_files=one).unionByName(flags(gt, annotation_files=one)).unionByName(flags(orphans, orphans=one))
    rows = rows.unionByName(flags(made, slides=one, matched=found, unmatched=~found, ambiguous=F.col("ambiguous")))
    if validated is not None:
        bad = F.col("parse_error")
        rows = rows.unionByName(flags(validated, invalid_annotations=bad, empty_annotations=~bad & (F.col("annotation_count") == 0), skipped_features=F.col("skipped_features")))
    return rows.agg(*[F.coalesce(F.sum(n), none).alias(n) for n in (names if validated is not None else names[:7])])
