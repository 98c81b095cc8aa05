"""Constants and edge cases of single functions."""

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from tilewright.functions import geometry as g
from tilewright.functions import paths
from tilewright.operators import geojson, labels, pairing, pixels, tiles
from tilewright.sources.views import view


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def lits(*v):
    return [F.lit(float(x)) for x in v]


def test_half_open_edges(spark):
    side, zero = 32, F.lit(0)
    assert one(spark, *[g.overlaps(*lits(*b), zero, zero, side) for b in ((7, 31, 90, 32), (32, 3, 40, 9), (-8, -2, 0.5, 30))]) == (True, False, True)


def test_clip_ratio_and_normalised(spark):
    x0, y0, side, box = 40, 8, 64, (24.0, 16.0, 72.0, 136.0)
    want = (max(box[0], x0), max(box[1], y0), min(box[2], x0 + side), min(box[3], y0 + side))
    ratio = (want[2] - want[0]) * (want[3] - want[1]) / ((box[2] - box[0]) * (box[3] - box[1]))
    centre = ((want[0] + want[2]) / 2 - x0) / side, ((want[1] + want[3]) / 2 - y0) / side
    part = g.clipped(*lits(*box), F.lit(x0), F.lit(y0), side)
    n = g.normalised(part, F.lit(x0), F.lit(y0), side)
    assert one(spark, *part, g.visible_ratio(tuple(lits(*box)), part), *n.values()) == (*want, ratio, *centre, (want[2] - want[0]) / side, (want[3] - want[1]) / side)


def test_no_area_has_no_ratio(spark):
    box = tuple(lits(3, 8, 3, 21))
    assert one(spark, g.visible_ratio(box, box)) == (0.0,)


def test_train_slides_rounds_half_even(spark):
    want = tuple(n if n < 2 else max(1, min(n - 1, round(n * 0.75))) for n in range(24))
    assert one(spark, *[tiles.train_slides(F.lit(n).cast("bigint"), 0.75) for n in range(24)]) == want


def test_paths(spark):
    names = ["d/.svs", "a.", "..x.tif", "d/a.ome.tif", "x"]
    assert [one(spark, paths.stem(F.lit(n)), paths.suffix(F.lit(n))) for n in names] == [(".svs", ""), ("a.", ""), ("..x", ".tif"), ("a.ome", ".tif"), ("x", "")]


def test_six_decimals_half_even(spark):
    assert one(spark, g.six_decimals(F.lit(1 / 128))) == ("0.007812",)


def test_geojson_ids_and_skips(spark):
    ring = "[[0,0],[4,0],[4,4]]"
    f = lambda geometry, extra="": '{"type":"Feature","geometry":%s%s}' % (geometry, extra)
    doc = '{"features":[%s]}' % ",".join([f('{"type":"Polygon","coordinates":[%s]}' % ring, ',"id":0'), f('{"type":"MultiPolygon","coordinates":[[%s],[[[1,1]]]]}' % ring, ',"id":"m"'), f("null"), f('{"type":"Polygon","coordinates":[[["1",0],[4,0],[4,4]]]}')])
    d = spark.createDataFrame([(1, doc), (2, "not json"), (3, None)], "slide_id long, doc string")
    assert [r.feature_id for r in geojson.annotations(d).orderBy("ann_idx").collect()] == ["ann_0", "m_1"]
    assert {r[0]: tuple(r)[1:] for r in geojson.validate(d).collect()} == {1: (2, 3, False), 2: (0, 0, True), 3: (0, 0, True)}


def test_segment_errors(spark):
    lines = ["1 0 0 1 0 1 1", "1 0 0", "1 0 0 1 0 1 1 1", "1 0 x 1 0 1 1", "1 0 2 1 0 1 1"]
    assert [one(spark, labels.segment_error(F.lit(x)))[0] for x in lines] == [None, "too_few", "odd", "not_finite", "out_of_range"]


def test_set_based_sampling_equals_a_loop(spark):
    slides = spark.createDataFrame([(1, 4000, 3000), (2, 1500, 900)], "slide_id long, width long, height long")
    rng = random.Random(4)
    boxes = [(s, i, float(x), float(y), float(x + 300), float(y + 200)) for s in (1, 2) for i in range(6) for x, y in [(rng.randint(0, 3000), rng.randint(0, 2000))]]
    ann = spark.createDataFrame(boxes, "slide_id long, ann_idx long, x1 double, y1 double, x2 double, y2 double")
    cands = tiles.candidates(slides, 120, 40)
    got = {r.slide_id: (r.accepted, r.duplicate, r.annotation, r.low_tissue) for r in tiles.reject_stats(tiles.judged(cands, ann, 8, F.col("x0") % 5 != 0), 8).collect()}
    want = {}
    for s in (1, 2):
        seen, n = set(), dict.fromkeys(("accepted", "duplicate", "annotation", "low_tissue"), 0)
        for r in sorted((r for r in cands.collect() if r.slide_id == s), key=lambda r: r["try"]):
            if n["accepted"] >= 8:
                break
            hit = False
            for t, _, x1, y1, x2, y2 in boxes:
                w, h = min(x2, r.x0 + 1024) - max(x1, r.x0), min(y2, r.y0 + 1024) - max(y1, r.y0)
                hit |= t == s and w > 0 and h > 0 and w * h / ((x2 - x1) * (y2 - y1)) >= 0.3
            why = "duplicate" if (r.x0, r.y0) in seen else "annotation" if hit else "low_tissue" if r.x0 % 5 == 0 else "accepted"
            seen.add((r.x0, r.y0))
            n[why] += 1
        want[s] = tuple(n.values())
    assert got == want


def test_pixel_variants():
    rng = np.random.default_rng(3)
    image = rng.integers(0, 256, (40, 33, 3)).astype(np.uint8)
    made = pixels.variants(image, random.Random(9))
    assert [n for n, _ in made] == list(pixels.VARIANTS) and len(pixels.variants(image, random.Random(9), False)) == 1
    assert all(v.shape == image.shape and v.dtype == np.uint8 for _, v in made)
    assert (pixels.apply_gamma(image, 1.0) == np.array(pixels.gamma_table(1.0), np.uint8)[image]).all()
    # two units of half a degree, and roundings
    assert np.abs(pixels.hsv_to_rgb(pixels.rgb_to_hsv(image)).astype(int) - image).max() <= 6
    assert np.abs(pixels.lab_to_rgb(pixels.rgb_to_lab(image)).astype(int) - image).max() <= 1


def test_equalising_touches_the_lightness_alone():
    rng = np.random.default_rng(5)
    image = (rng.integers(90, 130, (64, 64, 1)) + np.array([6, 0, 3])).astype(np.uint8)
    out = pixels.equalised(image, 2.0)
    before, after = pixels.rgb_to_lab(image), pixels.rgb_to_lab(out)
    assert after[..., 0].std() > 1.5 * before[..., 0].std() and np.abs(after[..., 1:] - before[..., 1:]).max() < 3


def test_shifted_hsv_columns_equal_the_image_form(spark):
    rng = np.random.default_rng(6)
    image = rng.integers(0, 256, (30, 1, 3)).astype(np.uint8)
    df = spark.createDataFrame([(i, *map(int, image[i, 0])) for i in range(30)], "i int, r int, g int, b int")
    made = pixels.shifted_hsv(F.col("r"), F.col("g"), F.col("b"), -3, 7, 8)
    got = np.array([tuple(r) for r in df.orderBy("i").select(*made).collect()])
    assert (got == pixels.shift_hsv(image, -3, 7, 8)[:, 0].astype(int)).all()


def test_lines_end_in_any_way(spark):
    text = "0 .25 .5 .125 .5\r\n1 .75 .5 .25 .25\r2 .5 .5 .5 .5\u2028\tbad\n 3\t.5 .5\x1f.5 .5 "
    df = spark.createDataFrame([("train", "a", text)], "split string, stem string, text string")
    assert [(r.line_no, r.cls) for r in labels.parsed(df).orderBy("line_no").collect()] == [(0, 0), (1, 1), (2, 2), (4, 3)]


def test_only_a_small_ome_is_stripped(spark):
    df = spark.createDataFrame([("d/a.OME.tif",), ("d/b.ome.tif",), ("d/a.geojson",), ("d/b.geojson",), ("d/b.ome.json",)], "path string")
    assert {r.wsi_path: r.gt_path for r in pairing.pairs(df).collect()} == {"d/a.OME.tif": None, "d/b.ome.tif": "d/b.geojson"}
    assert {r.wsi_path: r.gt_path for r in pairing.probed(df).collect()} == {"d/a.OME.tif": None, "d/b.ome.tif": "d/b.geojson"}


def test_cells_find_what_the_slide_join_finds(spark):
    rng = random.Random(12)
    tile_rows = [(s, i, rng.randint(0, 9000), rng.randint(0, 7000)) for s in (1, 2) for i in range(40)]
    boxes = [(s, i, float(x), float(y), float(x + rng.randint(1, 3000)), float(y + rng.randint(1, 900))) for s in (1, 2) for i in range(60) for x, y in [(rng.randint(-200, 9500), rng.randint(-200, 7500))]]
    t = spark.createDataFrame(tile_rows, "slide_id long, ordinal long, x0 long, y0 long")
    a = spark.createDataFrame(boxes, "slide_id long, ann_idx long, x1 double, y1 double, x2 double, y2 double")
    one_way, other = (sorted(map(tuple, tiles.visible_boxes(t, a, grid=grid).collect())) for grid in (True, False))
    assert one_way == other and one_way
    with_some = {r[:2] for r in one_way}
    assert {(r.slide_id, r.ordinal) for r in tiles.without_annotation(t, a, how="left_semi").collect()} == with_some
    assert {(r.slide_id, r.ordinal) for r in tiles.without_annotation(t, a).collect()} == {r[:2] for r in tile_rows} - with_some


def test_slides_are_ranked_by_their_hashes(spark):
    got = {r.slide_id: r.slide_index for r in tiles.slide_split(spark.range(300).select(F.col("id").alias("slide_id"))).collect()}
    order = sorted(range(300), key=lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest())
    assert got == {i: k for k, i in enumerate(order)}


def test_views_leave_users_views_alone(spark):
    spark.range(3).createOrReplaceTempView("orders")
    try:
        assert view(spark, "/root/testdata/sf0.001", "files").count() > 0
        assert spark.table("orders").count() == 3
        assert [t.name for t in spark.catalog.listTables() if t.isTemporary] == ["orders"]
    finally:
        spark.catalog.dropTempView("orders")
