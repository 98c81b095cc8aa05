"""Label texts: writing, parsing, integrity and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions import paths
from tilewright.functions.geometry import six_decimals

#: Ends of lines, and blanks, as Python's str methods take them.
_LINES = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
_BLANK = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
_FLOAT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, f"^{_BLANK}+|{_BLANK}+$", "")


def words(line: Column) -> Column:
    return F.split(trimmed(line), f"{_BLANK}+")


def label_texts(boxes: DataFrame, cls: int = 0) -> DataFrame:
    """One text a tile: a line a box in annotation order, six decimals; boxes without extent are left out."""
    line = F.concat_ws(" ", F.lit(str(cls)), *[six_decimals(F.col(c)) for c in ("xc", "yc", "w", "h")])
    lines = boxes.where((F.col("w") > 0) & (F.col("h") > 0)).groupBy("slide_id", "ordinal").agg(F.sort_array(F.collect_list(F.struct("ann_idx", line.alias("line")))).alias("ls"))
    return lines.select("slide_id", "ordinal", F.concat(F.array_join(F.transform("ls", lambda x: x["line"]), "\n"), F.lit("\n")).alias("text"))


def parsed(files: DataFrame) -> DataFrame:
    """Lines of five numbers: class and box, and whether the box is in range. Other lines are left out."""
    lines = files.select("split", "stem", F.posexplode(F.split("text", _LINES)).alias("line_no", "line"))
    parts = lines.withColumn("p", words(F.col("line"))).where((F.size("p") == 5) & F.forall("p", lambda x: x.rlike(_FLOAT)))
    num = lambda i: F.get("p", F.lit(i)).cast("double")
    out = parts.select("split", "stem", F.col("line_no").cast("bigint").alias("line_no"), num(0).cast("bigint").alias("cls"), num(1).alias("xc"), num(2).alias("yc"), num(3).alias("w"), num(4).alias("h"))
    unit = lambda c: (F.col(c) >= 0) & (F.col(c) <= 1)
    side = lambda c: (F.col(c) > 0) & (F.col(c) <= 1)
    return out.withColumn("in_range", unit("xc") & unit("yc") & side("w") & side("h"))


def paired(images: DataFrame, labels: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Rows (split, stem, text) of images with their labels. A negative's label may be missing (text null) if that is allowed."""
    j = images.select("split", "stem").distinct().join(labels.select("split", "stem", F.coalesce("text", F.lit("")).alias("text")), ["split", "stem"], "left")
    return j.where(F.col("text").isNotNull() | (F.lit(allow_missing) & F.contains("stem", F.lit("_neg_"))))


def integrity(images: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a split: images, labels, what is missing on either side, pairs by kind, boxes out of range.

    A negative's label may be missing; a pair is positive if its label has a box.
    """
    p = parsed(labels).groupBy("split", "stem").agg(F.count("*").alias("boxes"), F.count_if(~F.col("in_range")).alias("bad"))
    side = lambda df, flag: df.select("split", "stem").distinct().withColumn(flag, F.lit(True))
    f = side(images, "has_image").join(side(labels, "has_label"), ["split", "stem"], "full").join(p, ["split", "stem"], "left").withColumn("neg", F.contains("stem", F.lit("_neg_")))
    image, label, boxes = F.coalesce("has_image", F.lit(False)), F.coalesce("has_label", F.lit(False)), F.coalesce("boxes", F.lit(0))
    pair = image & (label | F.col("neg"))
    return f.groupBy("split").agg(
        F.count_if(image).alias("images"),
        F.count_if(label).alias("labels"),
        F.count_if(image & ~label & ~F.col("neg")).alias("missing_labels"),
        F.count_if(image & ~label & F.col("neg")).alias("allowed_missing"),
        F.count_if(label & ~image).alias("missing_images"),
        F.count_if(pair).alias("pairs"),
        F.count_if(pair & (boxes > 0)).alias("positives"),
        F.count_if(pair & (boxes == 0)).alias("negatives"),
        F.sum(F.when(pair, F.coalesce("bad", F.lit(0))).otherwise(0)).alias("coord_errors"),
    )


def pixel_corners(boxes: DataFrame, width: Column, height: Column) -> DataFrame:
    """Corners of normalised boxes in whole pixels, rounded half-even and kept inside the image."""
    at = lambda centre, size, sign, extent: F.greatest(F.lit(0).cast("bigint"), F.least(extent - 1, F.rint((F.col(centre) + sign * F.col(size) / 2) * extent).cast("bigint")))
    return boxes.withColumns({"px1": at("xc", "w", -1, width), "py1": at("yc", "h", -1, height), "px2": at("xc", "w", 1, width), "py2": at("yc", "h", 1, height)})


def segments(files: DataFrame) -> DataFrame:
    """Lines of segmentation files: stem, line_no from 1, class, points as 32-bit numbers, and what is wrong with the line."""
    lines = files.where(trimmed(F.col("text")) != "").select("stem", F.posexplode(F.split(trimmed(F.col("text")), _LINES)).alias("pos", "line"))
    parts = words(F.col("line"))
    values = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x.try_cast("float"))
    points = F.transform(F.sequence(F.lit(0), F.greatest(F.size(values) / 2 - 1, F.lit(0)).cast("int")), lambda i: F.struct(F.get(values, 2 * i).alias("x"), F.get(values, 2 * i + 1).alias("y")))
    return lines.select("stem", (F.col("pos") + 1).alias("line_no"), F.get(parts, F.lit(0)).try_cast("double").try_cast("bigint").alias("cls"), points.alias("points"), segment_error(F.col("line")).alias("error"))


def segment_files(files: DataFrame) -> DataFrame:
    """One row a file: its segments, and the first line that is wrong with what is wrong; null if none is."""
    s = segments(files).groupBy("stem").agg(F.count("*").alias("n"), F.min(F.when(F.col("error").isNotNull(), F.struct("line_no", "error"))).alias("e"))
    out = files.select("stem").join(s, "stem", "left")
    error = F.concat(F.lit("line "), F.col("e.line_no").cast("string"), F.lit(": "), F.col("e.error"))
    return out.select("stem", F.when(F.col("e").isNull(), F.coalesce("n", F.lit(0))).otherwise(0).cast("bigint").alias("segments"), error.alias("error"))


def segment_totals(checked: DataFrame) -> DataFrame:
    """One row: files, those without segments, and bad ones."""
    return checked.agg(F.count("*").alias("files"), F.count_if(F.col("error").isNull() & (F.col("segments") == 0)).alias("empty_files"), F.count_if(F.col("error").isNotNull()).alias("bad_files"))


def pixel_points(points: Column, side: int) -> Column:
    """Normalised 32-bit points as whole pixels of a square canvas, rounded half-even and kept inside."""
    at = lambda v: F.greatest(F.lit(0), F.least(F.lit(side - 1), F.rint((v * F.lit(side)).cast("float")).cast("int")))
    return F.transform(points, lambda p: F.struct(at(p["x"]).alias("x"), at(p["y"]).alias("y")))


# Image suffixes, the first one found wins.
BASE_SUFFIXES = (".jpg", ".jpeg", ".png")


def base_images(stems: DataFrame, files: DataFrame) -> DataFrame:
    """(stem, path): the image that a stem's rendering is drawn on, by suffix; null where it has none."""
    rank = F.array_position(F.array(*[F.lit(x) for x in BASE_SUFFIXES]), paths.suffix(F.col("path")))
    found = files.select(paths.stem(F.col("path")).alias("stem"), "path", rank.alias("rank")).where(F.col("rank") > 0).groupBy("stem").agg(F.min_by("path", "rank").alias("path"))
    return stems.select("stem").join(found, "stem", "left")


def segment_error(line: Column) -> Column:
    """What is wrong with a segmentation line, null if nothing is. Coordinates count as 32-bit numbers."""
    parts = words(line)
    values = F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda x: x.try_cast("float"))
    finite = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    unit = F.forall(values, lambda v: (v >= 0) & (v <= 1))
    return F.when(F.size(parts) < 7, "too_few").when(F.size(parts) % 2 == 0, "odd").when(~finite, "not_finite").when(~unit, "out_of_range")


def sampled(files: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """At most n stems of each split and kind: those of the least hashes."""
    kind = F.when(F.contains("stem", F.lit("_neg_")), "neg").otherwise("pos")
    order = Window.partitionBy("split", "kind").orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), "stem")), "stem")
    return files.withColumn("kind", kind).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select("split", "kind", "stem", F.col("rank").cast("bigint").alias("rank"))


def stem_difference(images: DataFrame, labels: DataFrame) -> DataFrame:
    """Stems with an image but no label, and the other way round."""
    one, two = (df.select("split", "stem").distinct() for df in (images, labels))
    return one.join(two, ["split", "stem"], "left_anti").withColumn("missing", F.lit("label")).unionByName(two.join(one, ["split", "stem"], "left_anti").withColumn("missing", F.lit("image")))
