"""Listing, image codecs, the build from files to a dataset, and the tools around it."""

import csv
import json
import os
import random

import numpy as np
import pytest

from tilewright import cli
from tilewright.config import BuildConfig
from tilewright.functions import images
from tilewright.plans import build, tools
from tilewright.sinks.dataset import DetectFormat, dataset_format
from tilewright.sources import listing, slides

SIDE = 64


def polygon(x, y, w, h, **more):
    ring = [[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]
    return {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": {}, **more}


def tissue(width, height, seed):
    """Saturated everywhere but for a pale strip on the left."""
    rng = np.random.default_rng(seed)
    out = np.stack([rng.integers(150, 220, (height, width)), rng.integers(40, 90, (height, width)), rng.integers(120, 180, (height, width))], -1).astype(np.uint8)
    out[:, : width // 5] = 250
    return out


@pytest.fixture()
def corpus(tmp_path):
    """Three slides with files, one without, one that can't be opened, one whose file doesn't parse, one without polygons, and files of no use."""
    root = tmp_path / "slides"
    (root / "deep").mkdir(parents=True)
    boxes = {"one": [(300, 200, 40, 30), (310, 260, 20, 20), (500, 400, 90, 60)], "deep/two.ome": [(200, 150, 30, 30)], "three": []}
    for i, (name, some) in enumerate(boxes.items()):
        (root / f"{name}.tif").write_bytes(images.encode_png(tissue(700, 520, i)))
        (root / f"{name.removesuffix('.ome')}.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [polygon(*b) for b in some]}))
    (root / "alone.svs").write_bytes(b"")
    (root / "broken.svs").write_bytes(b"no image")
    (root / "broken.json").write_text(json.dumps({"features": [polygon(1, 1, 9, 9)]}))
    (root / "unparsed.tif").write_bytes(images.encode_png(tissue(100, 100, 9)))
    (root / "unparsed.json").write_bytes(b"")
    (root / ".hidden.json").write_text("{}")
    (root / "notes.txt").write_text("")
    return root


def _reader():
    # made in a function, so that it is sent to workers by value
    def read(path):
        with open(path, "rb") as f:
            return slides.ArrayBackend(images.decode_png(f.read()))

    return read


reader = _reader()


def settings(root, out, **more):
    return BuildConfig(**{"target_dir": str(root), "output_dir": str(out), "tile_size": SIDE, "image_ext": ".png", "max_neg_tries_per_positive": 400} | more)


def test_listing_keeps_empty_and_hidden_files(corpus):
    found = listing.scan(str(corpus))
    assert [os.path.basename(p) for p in found.slides] == ["alone.svs", "broken.svs", "two.ome.tif", "one.tif", "three.tif", "unparsed.tif"]
    assert len(found.annotations) == 6 and found.scanned == 13
    assert [os.path.basename(p) for p in listing.of_suffixes(str(corpus), ["GEOJSON "], False)] == ["one.geojson", "three.geojson"]
    assert listing.normalised_suffixes([" .A", "b", "", "a"]) == (".a", ".b")
    with pytest.raises(NotADirectoryError):
        listing.of_suffixes(found.slides[0], [".svs"])
    with pytest.raises(FileNotFoundError):
        listing.walk(str(corpus / "nowhere"))


def test_png_and_jpeg(spark, tmp_path):
    rng = np.random.default_rng(2)
    flat = np.repeat(np.repeat(rng.integers(0, 256, (5, 7, 3)), 8, 0), 8, 1).astype(np.uint8)[:37, :51]
    assert (images.decode_png(images.encode_png(flat)) == flat).all()
    (tmp_path / "a.jpg").write_bytes(images.encode_jpeg(flat, 100))
    (tmp_path / "a.png").write_bytes(images.encode_png(flat))
    got = {os.path.basename(r["path"]): tools._array(r.asDict()) for r in tools._decoded(spark, [str(tmp_path / n) for n in ("a.jpg", "a.png")]).collect()}
    assert (got["a.png"] == flat).all()
    assert got["a.jpg"].shape == flat.shape and np.abs(got["a.jpg"].astype(int) - flat).mean() < 2
    smooth = np.clip(np.add.outer(np.arange(64), np.arange(80))[..., None] + np.array([3, 40, 90]), 0, 255).astype(np.uint8)
    assert len(images.encode_jpeg(smooth, 20)) < len(images.encode_jpeg(smooth, 95))
    with pytest.raises(ValueError, match="suffix"):
        images.encode(flat, ".gif")


def test_readers_keep_tiles_inside():
    image = tissue(90, 70, 1)
    r = slides.SlideReader("x", open_with=lambda _: slides.ArrayBackend(image))
    assert r.dimensions == (90, 70) and r.clamp_origin(60, -4, 32) == (58, 0) and r.clamp_origin(5, 5, 200) == (0, 0)
    assert (r.read_tile(999, 999, 32) == image[38:, 58:]).all() and r.backend_name == "array"
    assert slides.as_rgb(np.zeros((3, 4))).shape == slides.as_rgb(np.zeros((3, 4, 4))).shape == (3, 4, 3)
    with pytest.raises(ImportError):
        slides.opened("x.svs", "cucim")


def test_settings_are_checked(tmp_path):
    for bad in ({"tile_size": 0}, {"num_workers": 0}, {"split_mode": "x"}, {"train_ratio": 0.5}, {"train_ratio": 1.0, "val_ratio": 0.0}, {"max_neg_tries_per_positive": 0}, {"class_id": -1}, {"class_id": True}, {"class_name": ""}, {"image_ext": ".bmp"}, {"jpeg_quality": 0}):
        with pytest.raises(ValueError):
            BuildConfig(**bad).validate()
    with pytest.raises(NotImplementedError):
        dataset_format(BuildConfig(task="seg"))
    with pytest.raises(FileNotFoundError):
        BuildConfig(target_dir=str(tmp_path / "no")).validate_paths()
    cfg = BuildConfig(hue_shift=(-1, 1))
    assert BuildConfig.of(json.loads(json.dumps(cfg.snapshot()))) == cfg
    (tmp_path / "thesis.doc").write_text("")
    with pytest.raises(FileExistsError):
        DetectFormat(BuildConfig(output_dir=str(tmp_path))).prepare()


def test_build_from_files_to_dataset(spark, corpus, tmp_path):
    out = tmp_path / "set"
    made = build.run(spark, settings(corpus, out), open_with=reader, say=lambda _: None)
    by = {s["slide_stem"]: s for s in made["slides"]}
    assert {k: v["status"] for k, v in by.items()} == {"one": "ok", "two.ome": "ok", "three": "skipped", "broken": "failed", "unparsed": "failed"}
    assert (by["one"]["raw_pos"], by["one"]["raw_neg"], by["two.ome"]["raw_pos"], by["two.ome"]["raw_neg"]) == (3, 3, 1, 1)
    assert by["three"]["skip_reason_text"] and "ValueError" in by["broken"]["error"]
    found = made["discovery"]
    assert (found["matched"], found["unmatched"], found["orphans"], found["invalid_annotations"], found["empty_annotations"]) == (5, 1, 1, 1, 2)
    total = made["totals"]
    assert (total["raw_pos"], total["raw_neg"], total["slides_ok"], total["slides_skipped"], total["slides_failed"]) == (4, 4, 2, 1, 2)
    pics = {s: sorted(os.listdir(out / "images" / s)) for s in ("train", "val")}
    texts = {s: sorted(os.listdir(out / "labels" / s)) for s in ("train", "val")}
    assert len(pics["train"]) + len(pics["val"]) == total["written_train"] + total["written_val"] == 8 * 5
    assert all([n[:-4] for n in pics[s]] == [n[:-4] for n in texts[s]] for s in pics)
    # negatives show no box and are not pale; a positive's label is that of the boxes in it
    for s in pics:
        for n in pics[s]:
            body = (out / "labels" / s / f"{n[:-4]}.txt").read_text()
            assert ("_neg_" in n) == (body == "")
            if n.startswith("one_pos_000001") and n.endswith("_orig.png"):
                x0, y0 = 320 - 32, 215 - 32
                assert n == f"one_pos_000001_x{x0}_y{y0}_orig.png"
                assert body.splitlines()[0] == "0 " + " ".join(f"{v:.6f}" for v in (32 / 64, 32 / 64, 40 / 64, 30 / 64))
                assert (images.decode_png((out / "images" / s / n).read_bytes()) == tissue(700, 520, 0)[y0 : y0 + 64, x0 : x0 + 64]).all()
    assert (out / "dataset.yaml").read_text().splitlines()[1:] == ["train: images/train", "val: images/val", "names:", "  0: micropapillary"]
    assert json.loads((out / "build_report.json").read_text())["totals"] == total
    # the same again, and by slide without variants or empty labels
    again = build.run(spark, settings(corpus, out, split_mode="wsi", color_augment=False, empty_label_for_negative=False), open_with=reader, say=lambda _: None)
    assert again["totals"]["written_train"] + again["totals"]["written_val"] == 8
    assert sum(len(os.listdir(out / "labels" / s)) for s in ("train", "val")) == 4
    told = tools.check(spark, str(out), str(tmp_path / "seen"), most_pos=2, most_neg=1, allow_missing=True, say=lambda _: None).collect()
    assert sum(r.positives for r in told) == sum(r.negatives for r in told) == 4 and sum(r.coord_errors for r in told) == 0
    assert 0 < sum(len(f) for _, _, f in os.walk(tmp_path / "seen")) <= 6


def test_dry_run_writes_nothing(spark, corpus, tmp_path):
    said = []
    made = build.run(spark, settings(corpus, tmp_path / "set", dry_run=True), open_with=reader, say=said.append)
    assert made["totals"]["raw_pos"] == made["totals"]["raw_neg"] == 5 and made["totals"]["written_train"] == sum(round(20 * n / 2 * 0.75) for n in (3, 1, 1))
    assert not (tmp_path / "set").exists() and any("build" not in s and "raw_pos" in s for s in said)


def test_two_files_are_a_pair_whatever_their_names(spark, corpus):
    cfg = settings(corpus, "x")
    pairs, _, found = build.discover(spark, cfg, str(corpus / "one.tif"), str(corpus / "broken.json"))
    assert [os.path.basename(r.gt_path) for r in pairs.collect()] == ["broken.json"] and found["matched"] == 1 and found["total_files"] == 2


def test_count_tool(spark, corpus, tmp_path, capsys):
    out = tmp_path / "n" / "counts.csv"
    assert cli.main(["count", str(corpus), "-r", "--output", str(out), "--sort", "count"]) == 0
    rows = list(csv.reader(out.open()))
    assert rows[0] == ["path", "count", "ok", "error"] and [r[1] for r in rows[1:]] == ["3", "1", "1", "0", "0", "0"]
    assert "annotations: 5" in capsys.readouterr().out
    assert cli.main(["count", str(corpus), "--strict"]) == 1 and cli.main(["count", str(corpus / "no")]) == 2


def test_render_tool(spark, tmp_path):
    root = tmp_path / "labels"
    root.mkdir()
    (root / "a.txt").write_text("0 0.1 0.1 0.9 0.1 0.5 0.8\r\n")
    (root / "b.txt").write_text("\n")
    (root / "c.txt").write_text("0 0.1 0.1 0.9 0.1 0.5 0.8\n1 0.5 0.5")
    pics = tmp_path / "pics"
    pics.mkdir()
    (pics / "a.png").write_bytes(images.encode_png(tissue(50, 40, 3)))
    got = tools.render(spark, str(root), str(tmp_path / "out"), image_dir=str(pics), canvas=96, say=lambda _: None)
    assert got == {"files": 3, "empty_files": 1, "bad_files": 1} and sorted(os.listdir(tmp_path / "out")) == ["a_render.jpg", "b_render.jpg"]
    shapes = [{"pixels": [{"x": 10, "y": 10}, {"x": 80, "y": 10}, {"x": 45, "y": 75}]}]
    drawn = tools.rendered(np.zeros((96, 96, 3), np.uint8), shapes)
    assert tuple(drawn[30, 45]) == (89, 89, 0) and tuple(drawn[10, 50]) == tools.CYAN and not drawn[80, 80].any()


def test_drawn_boxes_stay_inside():
    rng = random.Random(1)
    image = np.zeros((60, 70, 3), np.uint8)
    out = tools.drawn_boxes(image, [{"px1": 5, "py1": 6, "px2": 40, "py2": 30}, {"px1": rng.randint(0, 3), "py1": 0, "px2": 69, "py2": 59}], False)
    assert tuple(out[6, 20]) == tools.RED and tuple(out[20, 20]) == (0, 0, 0) and tuple(out[50, 10]) == tools.WHITE and not image.any()
