"""Tiles around annotations and between them, and what is visible in each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilewright.functions import geometry as g

SIDE = 1024
#: Half-widths of the square that negative origins are drawn from, as shares of the slide's smaller side: grown by repeated addition.
RADIUS_START, RADIUS_STEP, RADIUS_TOP = 0.15, 0.10, 1.5


def positives(annotations: DataFrame, slides: DataFrame, side: int = SIDE) -> DataFrame:
    """One tile an annotation, centred on it and kept inside the slide."""
    j = annotations.join(slides, "slide_id")
    x0, y0 = g.centred_origin(F.col("x1"), F.col("x2"), F.col("width"), side), g.centred_origin(F.col("y1"), F.col("y2"), F.col("height"), side)
    t = j.select("slide_id", (F.col("ann_idx") + 1).alias("ordinal"), x0.alias("x0"), y0.alias("y0"))
    return t.withColumn("stem", F.format_string("s%d_pos_%06d_x%d_y%d", "slide_id", "ordinal", "x0", "y0"))


def _in_cells(tiles: DataFrame, annotations: DataFrame, side: int) -> tuple[DataFrame, DataFrame, Column]:
    """Tiles and boxes keyed by cells of the tile's size as well as the slide, so a dense slide is many keys.

    The condition lets a pair count only in the first cell that both touch.
    """
    cell = lambda v: F.floor(v / side).cast("bigint")
    t = tiles.withColumn("cx", F.explode(F.sequence(cell(F.col("x0")), cell(F.col("x0") + side - 1)))).withColumn("cy", F.explode(F.sequence(cell(F.col("y0")), cell(F.col("y0") + side - 1)))).alias("t")
    a = annotations.withColumn("cx", F.explode(F.sequence(cell(F.col("x1")), cell(F.col("x2"))))).withColumn("cy", F.explode(F.sequence(cell(F.col("y1")), cell(F.col("y2"))))).alias("a")
    first = lambda axis, lo: F.col(f"t.c{axis}") == F.greatest(cell(F.col(f"t.{axis}0")), cell(F.col(f"a.{lo}")))
    same = (F.col("t.slide_id") == F.col("a.slide_id")) & (F.col("t.cx") == F.col("a.cx")) & (F.col("t.cy") == F.col("a.cy"))
    return t, a, same & first("x", "x1") & first("y", "y1")


def _shown(tiles: DataFrame, annotations: DataFrame, side: int, grid: bool) -> tuple[DataFrame, tuple[Column, ...]]:
    """Pairs t, a of which at least 30 % of the box shows in the tile, and the part that shows.

    By cells the join is by merging: Spark takes rows made by explode for no more than those they are made
    of, so it would broadcast all tries of all slides as if they were the slides.
    """
    if grid:
        t, a, same = _in_cells(tiles, annotations, side)
        a = a.hint("merge")
    else:
        t, a = tiles.alias("t"), annotations.alias("a")
        same = F.col("t.slide_id") == F.col("a.slide_id")
    box = tuple(F.col(f"a.{c}") for c in ("x1", "y1", "x2", "y2"))
    x0, y0 = F.col("t.x0"), F.col("t.y0")
    part = g.clipped(*box, x0, y0, side)
    return t.join(a, same & g.overlaps(*box, x0, y0, side) & (g.visible_ratio(box, part) >= g.MIN_VISIBLE)), part


def visible_boxes(tiles: DataFrame, annotations: DataFrame, side: int = SIDE, grid: bool = True) -> DataFrame:
    """Boxes of which at least 30 % show in a tile, clipped and normalised. grid: joined by cells, else by slide alone."""
    j, part = _shown(tiles, annotations, side, grid)
    n = g.normalised(part, F.col("t.x0"), F.col("t.y0"), side)
    out = j.select("t.slide_id", "t.ordinal", "a.ann_idx", *[v.alias(k) for k, v in n.items()])
    return out.where((F.col("w") > 0) & (F.col("h") > 0))


def box_digests(boxes: DataFrame) -> DataFrame:
    """One row a tile of ``visible_boxes``: how many, which, and sums of their sizes in millionths of the tile's side."""
    millionths = lambda c: F.sum(F.floor(F.col(c) * 1000000 + 0.5).cast("bigint")).alias(f"sum_{c}")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("ann_idx")), lambda x: x.cast("string")), ",")
    return boxes.groupBy("slide_id", "ordinal").agg(F.count("*").alias("boxes"), F.md5(ids).alias("ids_md5"), *[millionths(c) for c in ("xc", "yc", "w", "h")])


def without_annotation(tiles: DataFrame, annotations: DataFrame, side: int = SIDE, how: str = "left_anti") -> DataFrame:
    """Tiles in which no annotation shows to 30 % (left_semi: in which one does), joined by cells.

    The second join is by merging too: most tries are hits, and adaptive execution would broadcast them.
    """
    hit = _shown(tiles.select("slide_id", "x0", "y0").distinct(), annotations, side, True)[0].select("t.slide_id", "t.x0", "t.y0").distinct()
    return tiles.join(hit.hint("merge"), ["slide_id", "x0", "y0"], how).select(*tiles.columns)


def radii(every: int, tries: int) -> list[float]:
    """The radius of each stretch of ``every`` tries."""
    out, r = [RADIUS_START], RADIUS_START
    while len(out) * every < tries:
        r = min(RADIUS_TOP, r + RADIUS_STEP)
        out.append(r)
    return out


def candidates(slides: DataFrame, tries: int, every: int, seed: int = 42, side: int = SIDE) -> DataFrame:
    """Origins of all tries: drawn around the centre, from a square that grows every so many tries."""
    t = slides.withColumn("try", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(tries - 1).cast("bigint"))))
    radius = F.element_at(F.array(*[F.lit(r) for r in radii(every, tries)]), (F.floor(F.col("try") / every) + 1).cast("int"))
    half = F.least("width", "height") * radius

    def origin(extent: str, tag: str) -> Column:
        middle = F.col(extent) / 2
        drawn = middle - half + 2 * half * g.uniform(seed, tag, F.col("slide_id"), F.col("try"))
        return g.clamp_origin(g.half_even(drawn) - side // 2, F.col(extent), side)

    return t.select("slide_id", "try", origin("width", "x").alias("x0"), origin("height", "y").alias("y0"))


def judged(cands: DataFrame, annotations: DataFrame, target: int, tissue: Column, side: int = SIDE) -> DataFrame:
    """Tries up to the one that reaches the target, each with its reason: duplicate, annotation, low_tissue, or accepted."""
    seen = F.row_number().over(Window.partitionBy("slide_id", "x0", "y0").orderBy("try")) > 1
    hit = without_annotation(cands, annotations, side, "left_semi").select("slide_id", "try", F.lit(True).alias("hit"))
    c = cands.withColumn("seen", seen).join(hit, ["slide_id", "try"], "left")
    reason = F.when(F.col("seen"), "duplicate").when(F.col("hit"), "annotation").when(~tissue, "low_tissue").otherwise("accepted")
    c = c.select("slide_id", "try", "x0", "y0", reason.alias("reason"))
    upto = Window.partitionBy("slide_id").orderBy("try").rowsBetween(Window.unboundedPreceding, -1)
    done = F.coalesce(F.sum((F.col("reason") == "accepted").cast("bigint")).over(upto), F.lit(0).cast("bigint"))
    return c.withColumn("done", done).where(F.col("done") < target)


def negatives(tried: DataFrame) -> DataFrame:
    ordinal = F.col("done") + 1
    return tried.where(F.col("reason") == "accepted").select("slide_id", ordinal.alias("ordinal"), "x0", "y0", F.format_string("s%d_neg_%06d_x%d_y%d", "slide_id", ordinal, "x0", "y0").alias("stem"))


def reject_stats(tried: DataFrame, target: int) -> DataFrame:
    """Accepted tries and reasons a slide; the shortfall counts as failed and as stopped by the limit of tries."""
    n = lambda r: F.count_if(F.col("reason") == r)
    out = tried.groupBy("slide_id").agg(n("accepted").alias("accepted"), n("duplicate").alias("duplicate"), n("annotation").alias("annotation"), n("low_tissue").alias("low_tissue"))
    return out.withColumn("failed_neg", F.lit(target) - F.col("accepted")).withColumn("try_limit", F.col("failed_neg"))


def tile_split(tiles: DataFrame, ratio: float = 0.75, seed: int = 42) -> DataFrame:
    return tiles.withColumn("split", F.when(g.uniform(seed, "split", F.col("stem")) < ratio, "train").otherwise("val"))


def train_slides(n: Column, ratio: float) -> Column:
    """How many of n slides train: none of none, one of one, else at least one and not all."""
    return F.when(n <= 1, n).otherwise(F.greatest(F.lit(1).cast("bigint"), F.least(n - 1, g.half_even(n * ratio))))


def slide_split(slides: DataFrame, ratio: float = 0.75, seed: int = 42) -> DataFrame:
    """Whole slides to train or val: the first of a seeded order.

    The order is that of hashes; slides are ranked among those of the same first three
    digits, and what comes before is added from a table of at most 4096 counts.
    """
    keyed = slides.select("slide_id", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("slide_id").cast("string"))).alias("h")).withColumn("part", F.substring("h", 1, 3))
    counts = keyed.groupBy("part").agg(F.count("*").alias("c"))
    order = Window.partitionBy(F.lit(1)).orderBy("part")
    before = counts.select("part", (F.sum("c").over(order) - F.col("c")).alias("before"), F.sum("c").over(Window.partitionBy(F.lit(1))).alias("n"))
    ranked = keyed.withColumn("own", F.row_number().over(Window.partitionBy("part").orderBy("h", "slide_id")) - 1).join(F.broadcast(before), "part")
    index = (F.col("before") + F.col("own")).cast("bigint")
    return ranked.select("slide_id", index.alias("slide_index"), F.when(index < train_slides(F.col("n"), ratio), "train").otherwise("val").alias("split"))


def dry_run(counts: DataFrame, variants: int = 5, ratio: float = 0.75) -> DataFrame:
    """What a build would write, from annotation counts alone: as many negatives as positives, times the variants."""
    n = F.col("annotation_count")
    total = 2 * n * variants
    train = g.half_even(total * ratio)
    return counts.select("slide_id", n.alias("raw_pos"), n.alias("raw_neg"), total.alias("total"), train.alias("train"), (total - train).alias("val"), F.when(F.col("parse_error"), "failed").when(n == 0, "skipped").otherwise("ok").alias("status"))


def dry_run_by_slide(counts: DataFrame, splits: DataFrame, variants: int = 5) -> DataFrame:
    """The same where whole slides go to one split (rows of ``slide_split``)."""
    out = dry_run(counts, variants).join(splits.select("slide_id", "split"), "slide_id")
    side = lambda s: F.when(F.col("split") == s, F.col("total")).otherwise(F.lit(0).cast("bigint"))
    return out.withColumns({"train": side("train"), "val": side("val")}).drop("split")


def written_by_split(tiles: DataFrame, variants: int = 5) -> DataFrame:
    """One row a slide: images written to each split; tiles have a split, and all variants of a tile go there."""
    n = lambda s: (F.count_if(F.col("split") == s) * variants).alias(f"written_{s}")
    return tiles.groupBy("slide_id").agg(n("train"), n("val"))


def totals(estimates: DataFrame) -> DataFrame:
    s = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
    n = lambda v: F.count_if(F.col("status") == v).alias(f"slides_{v}")
    return estimates.agg(s("raw_pos"), s("raw_neg"), s("total"), s("train"), s("val"), n("ok"), n("skipped"), n("failed"))
