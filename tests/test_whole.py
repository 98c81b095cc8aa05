"""Queries that must look at all rows of their tables, against plain Python and SQL without the cuts."""

import hashlib

import duckdb
import numpy as np
import pytest
from test_queries import TABLES, rows

from tilewright.functions import md5
from tilewright.operators import sampling
from tilewright.plans.queries import ORACLE_SQL, QUERIES
from tilewright.sources.views import view

SMALL = "/root/testdata/sf0.001"


def shows(boxes, x0, y0, side=1024):
    """Whether one of the boxes (x1, y1, x2, y2) shows in the tile to 30 %."""
    w = np.minimum(boxes[:, 2], x0 + side) - np.maximum(boxes[:, 0], x0)
    h = np.minimum(boxes[:, 3], y0 + side) - np.maximum(boxes[:, 1], y0)
    return bool(((w > 0) & (h > 0) & (w * h / ((boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1])) >= 0.3)).any())


def test_negatives_show_no_annotation_at_all(spark):
    ann = view(spark, SMALL, "annotations").toPandas()
    boxes = {k: v[["x1", "y1", "x2", "y2"]].to_numpy() for k, v in ann.groupby("slide_id")}
    got = QUERIES["negative_tiles"](spark, SMALL).collect()
    assert not [r for r in got if shows(boxes[r.slide_id], r.x0, r.y0)]


@pytest.mark.parametrize("name", ["geojson_explode_rings", "geojson_validate", "geojson_count", "dry_run_estimate", "dataset_totals"])
def test_documents_hold_all_annotations(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    whole = ORACLE_SQL[name]
    assert "ann_idx <" not in whole
    assert rows(QUERIES[name](spark, SMALL).toPandas()) == rows(duck.sql(whole).df())


def test_each_slide_has_a_target_of_its_own(spark):
    sizes = {1: (4000, 3000), 2: (1500, 1030), 3: (800, 900)}
    rng = np.random.default_rng(4)
    boxes = [(s, i, float(x), float(y), float(x + 300), float(y + 200)) for s, n in ((1, 9), (2, 5), (3, 3)) for i in range(n) for x, y in [rng.integers(0, 2000, 2) if s < 3 else (100, 100)]]
    slides = spark.createDataFrame([(s, *v) for s, v in sizes.items()], "slide_id long, width long, height long")
    ann = spark.createDataFrame(boxes, "slide_id long, ann_idx long, x1 double, y1 double, x2 double, y2 double")
    out = sampling.sampled(slides, ann, lambda x, y: x % 5 != 0, per=30, every=40).cache()
    stats = {r.slide_id: tuple(r)[1:] for r in sampling.reject_stats(out).collect()}
    made = sorted((r.slide_id, r.ordinal, r.x0, r.y0) for r in sampling.negatives(out).collect())
    want_made = []
    for s, (width, height) in sizes.items():
        mine = np.array([b[2:] for b in boxes if b[0] == s])
        seen, radius, n, tries = set(), 0.15, dict.fromkeys(("accepted", "duplicate", "annotation", "low_tissue"), 0), 0
        while n["accepted"] < len(mine) and tries < 30 * len(mine):
            tries += 1
            if tries % 40 == 0:
                radius = min(1.5, radius + 0.10)
            half, at = min(width, height) * radius, []
            for extent, tag in ((width, "x"), (height, "y")):
                u = int(hashlib.md5(f"42|{s}|{tries - 1}|{tag}".encode()).hexdigest()[:8], 16) / 4294967296.0
                at.append(max(0, min(round(extent / 2 - half + 2 * half * u) - 512, max(0, extent - 1024))))
            why = "duplicate" if tuple(at) in seen else "annotation" if shows(mine, *at) else "low_tissue" if at[0] % 5 == 0 else "accepted"
            seen.add(tuple(at))
            n[why] += 1
            if why == "accepted":
                want_made.append((s, n[why], *at))
        short = len(mine) - n["accepted"]
        assert stats[s] == (*n.values(), short, short)
    assert made == want_made and len({s for s, *_ in made}) > 1 and stats[3][0] == 0


def test_negatives_reach_the_positive_count_or_the_limit_of_tries(spark):
    n = dict(view(spark, SMALL, "annotations").groupBy("slide_id").count().collect())
    got = QUERIES["negative_reject_stats"](spark, SMALL).collect()
    assert len(got) == len(n)
    for r in got:
        tries = r.accepted + r.duplicate + r.annotation + r.low_tissue
        assert r.accepted + r.failed_neg == n[r.slide_id] and (r.failed_neg == 0 or tries == 5000 * n[r.slide_id])


@pytest.mark.parametrize("name", ["clean_tiles", "tile_has_annotation"])
def test_tries_are_not_broadcast(spark, name):
    """Spark takes a hundred tries a slide for one row a slide, and they must not meet in the driver for it."""
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().sparkPlan().toString()
    by_cells = [line for line in plan.splitlines() if "Join" in line and "cx#" in line]
    assert by_cells and all("SortMergeJoin" in line for line in by_cells)


@pytest.mark.parametrize("name", ["clean_tiles", "tile_has_annotation"])
def test_hits_are_not_broadcast(spark, name):
    """Adaptive execution broadcasts what turns out to be below the bound: here all tries with a hit."""
    got = QUERIES[name](spark, SMALL)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    by_origin = [line for line in plan.splitlines() if "LeftSemi" in line or "LeftAnti" in line]
    assert by_origin and all("SortMergeJoin" in line for line in by_origin)


@pytest.mark.parametrize("n", [0, 5, 22, 48, 49, 52])
def test_first_words_of_md5_equal_hashlib(n):
    prefix = b"7" * n
    for digits in (1, 3, 5):
        got = md5.heads(prefix, digits, "xy").reshape(2, -1)
        for i in range(0, 10**digits, 10**digits // 7 + 1):
            want = [hashlib.md5(prefix + f"{i:0{digits}d}|{tag}".encode()).digest()[:4] for tag in "xy"]
            assert [int(v) for v in got[:, i]] == [int.from_bytes(w, "big") for w in want]


@pytest.fixture
def texts(monkeypatch):
    """How many texts are hashed, call by call."""
    made, heads = [], md5.heads
    monkeypatch.setattr(md5, "heads", lambda *a: made.append(len(out := heads(*a))) or out)
    return made


def loop(slide, width, height, boxes, tissue, per, every):
    """Tries one by one: counts by reason and the accepted origins."""
    seen, radius, n, out = set(), 0.15, dict.fromkeys(("accepted", "duplicate", "annotation", "low_tissue"), 0), []
    for t in range(per * boxes.shape[1]):
        if n["accepted"] == boxes.shape[1]:
            break
        radius = min(1.5, radius + 0.10) if (t + 1) % every == 0 else radius
        half, at = min(width, height) * radius, []
        for extent, tag in ((width, "x"), (height, "y")):
            u = int(hashlib.md5(f"42|{slide}|{t}|{tag}".encode()).hexdigest()[:8], 16) / 4294967296.0
            at.append(max(0, min(round(extent / 2 - half + 2 * half * u) - 512, extent - 1024)))
        why = "duplicate" if tuple(at) in seen else "annotation" if shows(boxes.T, *at) else "accepted" if tissue(*at) else "low_tissue"
        seen.add(tuple(at))
        n[why] += 1
        out += [tuple(at)] * (why == "accepted")
    return n, out


def test_tries_whose_places_were_all_there_are_counted_but_not_made(texts):
    boxes = np.array([[100.0, 100.0 + 30 * i, 700.0, 2000.0 + 30 * i] for i in range(6)]).T
    count, xs, ys = sampling.sample(1, 800, 2048, boxes, lambda x, y: x + y > 5000, every=50)
    assert (count, [*zip(xs.tolist(), ys.tolist(), strict=True)]) == loop(1, 800, 2048, boxes, lambda x, y: x + y > 5000, 5000, 50)
    assert sum(count.values()) == 30000
    texts.clear()
    count, _, _ = sampling.sample(1, 800, 2048, boxes, lambda x, y: x + y > 5000, every=50, per=5_000_000)
    assert sum(count.values()) == 30_000_000 and sum(texts) < 1_000_000


def test_no_try_is_made_where_no_place_is_free(texts):
    """Without counts; with them the same places are accepted."""
    cover = np.array([[x, y, x + 700.0, y + 700.0] for x in range(0, 6000, 350) for y in range(0, 5000, 350)]).T
    assert sampling.sample(5, 6000, 5000, cover, lambda x, y: x >= 0, counted=False)[0]["accepted"] == 0 and not texts
    rng = np.random.default_rng(8)
    for slide in range(12):
        at = rng.uniform(0, 3500, (2, 20 + slide))
        boxes, tissue = np.concatenate([at, at + rng.uniform(50, 800, at.shape)]), lambda x, y: (x + y) % 4 > 0
        count, *places = sampling.sample(slide, 4000, 3000 + 100 * slide, boxes, tissue, per=900)
        less, *same = sampling.sample(slide, 4000, 3000 + 100 * slide, boxes, tissue, per=900, counted=False)
        assert less == {"accepted": count["accepted"], "duplicate": None, "annotation": None, "low_tissue": None}
        assert all((a == b).all() for a, b in zip(places, same, strict=True))


@pytest.mark.parametrize("name", ["negative_tiles", "samples_union_variants"])
def test_queries_without_counts_ask_for_none(spark, monkeypatch, name):
    asked, sampled = [], sampling.sampled
    monkeypatch.setattr(sampling, "sampled", lambda *a, **k: asked.append(k) or sampled(*a, **k))
    got = sorted(tuple(map(str, r)) for r in QUERIES[name](spark, SMALL).collect())
    assert [k.pop("counted") for k in asked] == [False]
    monkeypatch.setattr(sampling, "sampled", lambda *a, **_: sampled(*a))
    assert got == sorted(tuple(map(str, r)) for r in QUERIES[name](spark, SMALL).collect())


def test_counted_tries_are_made_in_the_jvm(spark):
    """Numpy takes some hundred nanoseconds a hash, so too long for the slides of 1 GB."""
    plan = QUERIES["negative_reject_stats"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "tilewright_tries(" in plan
    assert "tilewright_tries(" not in QUERIES["negative_tiles"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    ("options", "tissue"),
    [
        ({"per": 700}, lambda x, y: (x + y) % 4 > 0),
        ({"per": 90, "every": 1, "seed": -123456789}, lambda x, y: x % 2 == 0),
        ({"per": 40, "every": 777, "side": 333}, lambda x, y: (x + y) % 11 == 0),  # most free places don't fit: the JVM stops too early
    ],
)
@pytest.mark.parametrize("most", [1 << 29, 4_000_000])  # beyond so many places it leaves a slide to numpy
def test_tries_of_the_jvm_are_those_of_numpy(spark, monkeypatch, options, tissue, most):
    monkeypatch.setattr(sampling, "_TO_JVM", most)
    rng = np.random.default_rng(12)
    sizes = {7: (4000, 3000), 10**17: (800, 2500), 3: (1024, 1024), 40: (700, 900), 5: (9001, 2111), 6: (2500, 2500), 8: (3000, 5000)}
    boxes = {s: np.concatenate([at, at + rng.uniform(5, 900, at.shape)]) for s, (w, h) in sizes.items() for at in [rng.uniform(-100, min(w, h), (2, 25 + s % 9))]}
    boxes[6] = np.array([[0.0, 0.0, 900.0, 900.0]] * 3 + [[5.0, 5.0, 5.0, 90.0]]).T
    boxes[8] = np.array([[x, y, x + 700.0, y + 700.0] for x in range(0, 3000, 350) for y in range(0, 5000, 350)]).T
    slides = spark.createDataFrame([(s, *v) for s, v in sizes.items()], "slide_id long, width long, height long")
    ann = spark.createDataFrame([(s, *map(float, b)) for s, v in boxes.items() for b in v.T], "slide_id long, x1 double, y1 double, x2 double, y2 double")
    got = {r.slide_id: r for r in sampling.sampled(slides, ann, tissue, **options).collect()}
    for s, (w, h) in sizes.items():
        count, xs, ys = sampling.sample(s, w, h, boxes[s], tissue, **options)
        assert ({k: got[s][k] for k in count}, got[s].xs, got[s].ys) == (count, xs.tolist(), ys.tolist())
    assert len({tuple(r)[1:6] for r in got.values()}) == len(sizes)
