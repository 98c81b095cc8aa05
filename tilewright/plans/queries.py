"""The library's queries over the driver's tables, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.operators import geojson, labels, pairing, pixels, reporting, sampling, tiles
from tilewright.sources.views import duckdb_with, view

#: Tries between two radii in the queries of fixed tries.
EVERY = 50


def _tissue(x0, y0):  # noqa: ANN001, ANN202
    """Stands in for the tissue test, as the driver's tables have no images."""
    return (x0 * 7 + y0 * 13) % 10 < 8


def _ann(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "annotations")


def _pos(s: SparkSession, d: str) -> DataFrame:
    return tiles.positives(_ann(s, d), view(s, d, "slides"))


def geojson_explode_rings(s: SparkSession, d: str) -> DataFrame:
    return geojson.annotations(view(s, d, "geojson_docs"))


def geojson_validate(s: SparkSession, d: str) -> DataFrame:
    return geojson.validate(view(s, d, "geojson_docs"))


def geojson_count(s: SparkSession, d: str) -> DataFrame:
    return geojson.count_objects(view(s, d, "geojson_docs"))


def positive_tiles(s: SparkSession, d: str) -> DataFrame:
    return _pos(s, d)


def _visible(s: SparkSession, d: str) -> DataFrame:
    return tiles.visible_boxes(_pos(s, d), _ann(s, d))


def visible_boxes_grid(s: SparkSession, d: str) -> DataFrame:
    """The boxes visible in every positive tile, one row a tile: how many, which, and where in sum."""
    return tiles.box_digests(_visible(s, d))


def _sampled(s: SparkSession, d: str, counted: bool = True) -> DataFrame:
    return sampling.sampled(view(s, d, "slides"), _ann(s, d), _tissue, counted=counted)


def tile_has_annotation(s: SparkSession, d: str) -> DataFrame:
    return tiles.without_annotation(tiles.candidates(view(s, d, "slides"), 100, EVERY), _ann(s, d), how="left_semi")


def clean_tiles(s: SparkSession, d: str) -> DataFrame:
    return tiles.without_annotation(tiles.candidates(view(s, d, "slides"), 100, EVERY), _ann(s, d))


def negative_tiles(s: SparkSession, d: str) -> DataFrame:
    return sampling.negatives(_sampled(s, d, counted=False))


def negative_reject_stats(s: SparkSession, d: str) -> DataFrame:
    return sampling.reject_stats(_sampled(s, d))


def tile_split_patch(s: SparkSession, d: str) -> DataFrame:
    return tiles.tile_split(_pos(s, d)).select("slide_id", "ordinal", "split")


def slide_split_wsi(s: SparkSession, d: str) -> DataFrame:
    return tiles.slide_split(view(s, d, "slides"))


def dry_run_estimate(s: SparkSession, d: str) -> DataFrame:
    return tiles.dry_run(geojson_validate(s, d))


def dataset_totals(s: SparkSession, d: str) -> DataFrame:
    return tiles.totals(dry_run_estimate(s, d))


def pair_by_stem(s: SparkSession, d: str) -> DataFrame:
    return pairing.pairs(view(s, d, "files"))


def discovery_diagnostics(s: SparkSession, d: str) -> DataFrame:
    return pairing.diagnostics(view(s, d, "files"))


def label_lines(s: SparkSession, d: str) -> DataFrame:
    return labels.label_texts(_visible(s, d))


def label_parse(s: SparkSession, d: str) -> DataFrame:
    return labels.parsed(view(s, d, "label_texts"))


def label_integrity(s: SparkSession, d: str) -> DataFrame:
    return labels.integrity(view(s, d, "image_files"), view(s, d, "label_texts"))


def image_label_pairs(s: SparkSession, d: str) -> DataFrame:
    return labels.paired(view(s, d, "image_files"), view(s, d, "label_texts"))


def label_boxes_pixels(s: SparkSession, d: str) -> DataFrame:
    boxes = labels.parsed(view(s, d, "label_texts"))
    return labels.pixel_corners(boxes, F.lit(1024).cast("bigint"), F.lit(768).cast("bigint")).select("split", "stem", "line_no", "px1", "py1", "px2", "py2")


def seg_points_pixels(s: SparkSession, d: str) -> DataFrame:
    lines = labels.segments(view(s, d, "seg_files")).where(F.col("error").isNull())
    return lines.select("stem", "line_no", "cls", F.posexplode(labels.pixel_points(F.col("points"), 1024)).alias("i", "p")).select("stem", "line_no", "cls", "i", "p.x", "p.y")


def seg_file_status(s: SparkSession, d: str) -> DataFrame:
    return labels.segment_files(view(s, d, "seg_files"))


def seg_file_totals(s: SparkSession, d: str) -> DataFrame:
    return labels.segment_totals(seg_file_status(s, d))


def base_images(s: SparkSession, d: str) -> DataFrame:
    return labels.base_images(view(s, d, "seg_files"), view(s, d, "base_images"))


def probe_pairs(s: SparkSession, d: str) -> DataFrame:
    return pairing.probed(view(s, d, "files"))


def discovery_counters(s: SparkSession, d: str) -> DataFrame:
    return pairing.diagnostics(view(s, d, "files"), None, geojson_validate(s, d))


def geojson_count_totals(s: SparkSession, d: str) -> DataFrame:
    return geojson.count_totals(geojson_count(s, d))


def dry_run_wsi(s: SparkSession, d: str) -> DataFrame:
    return tiles.dry_run_by_slide(geojson_validate(s, d), slide_split_wsi(s, d))


def build_totals(s: SparkSession, d: str) -> DataFrame:
    return reporting.totals(view(s, d, "slide_results"))


def slide_status_text(s: SparkSession, d: str) -> DataFrame:
    return reporting.with_status_text(view(s, d, "slide_results")).select("slide_stem", "status_text", "skip_reason_text")


def written_by_split(s: SparkSession, d: str) -> DataFrame:
    return tiles.written_by_split(tiles.tile_split(_pos(s, d)), len(pixels.VARIANTS))


def seg_label_validate(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "seg_lines").select("line_id", F.coalesce(labels.segment_error(F.col("line")), F.lit("ok")).alias("result"))


def sample_per_split(s: SparkSession, d: str) -> DataFrame:
    return labels.sampled(view(s, d, "label_files"), 100)


def first_n_labels(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "label_files").where("has_label").select("stem").orderBy("stem").limit(10)


def stem_difference(s: SparkSession, d: str) -> DataFrame:
    return labels.stem_difference(view(s, d, "image_files"), view(s, d, "label_texts"))


def samples_union_variants(s: SparkSession, d: str) -> DataFrame:
    both = _pos(s, d).select("slide_id", "stem").unionByName(sampling.negatives(_sampled(s, d, counted=False)).select("slide_id", "stem"))
    return both.select("slide_id", F.explode(F.array(*[F.lit(v) for v in pixels.VARIANTS])).alias("variant"), "stem").select("slide_id", F.concat_ws("_", "stem", "variant").alias("image"))


def tissue_ratio(s: SparkSession, d: str) -> DataFrame:
    return pixels.tissue_ratio(view(s, d, "pixels"))


def augment_gamma(s: SparkSession, d: str) -> DataFrame:
    t = pixels.gamma_table(1.1)
    return view(s, d, "pixels").select("tile_id", "px", *[pixels.gamma(F.col(c), t).alias(c) for c in "rgb"])


def augment_brightness_contrast(s: SparkSession, d: str) -> DataFrame:
    return view(s, d, "pixels").select("tile_id", "px", *[pixels.brightness_contrast(F.col(c), 0.0625, 8 / 255).alias(c) for c in "rgb"])


def augment_hsv(s: SparkSession, d: str) -> DataFrame:
    """Hue, saturation and value shifted by whole steps, clipped, and back."""
    made = pixels.shifted_hsv(*[F.col(c) for c in "rgb"], 5, 9, -7)
    return view(s, d, "pixels").select("tile_id", "px", *[v.alias(c) for v, c in zip(made, "rgb", strict=True)])


_ALL = (geojson_explode_rings, geojson_validate, geojson_count, geojson_count_totals, positive_tiles, visible_boxes_grid, tile_has_annotation, clean_tiles, negative_tiles, negative_reject_stats, samples_union_variants)
_ALL += (tile_split_patch, slide_split_wsi, written_by_split, dry_run_estimate, dry_run_wsi, dataset_totals, build_totals, slide_status_text, pair_by_stem, probe_pairs, discovery_diagnostics, discovery_counters)
_ALL += (label_lines, label_parse, label_integrity, image_label_pairs, label_boxes_pixels, seg_label_validate, seg_points_pixels, seg_file_status, seg_file_totals, base_images, sample_per_split, first_n_labels, stem_difference)
_ALL += (tissue_ratio, augment_gamma, augment_brightness_contrast, augment_hsv)
QUERIES = {f.__name__: f for f in _ALL}

# ---- DuckDB ----

_POS = """pos AS (SELECT slide_id, ann_idx + 1 AS ordinal, greatest(0, least(CAST(trunc((x1 + x2) / 2) AS BIGINT) - 512, width - 1024)) AS x0,
 greatest(0, least(CAST(trunc((y1 + y2) / 2) AS BIGINT) - 512, height - 1024)) AS y0 FROM annotations JOIN slides USING (slide_id))"""


def _seen(a: str, t: str = "t") -> str:
    """Condition that annotation a shows in tile t to 30 % at least."""
    return f"{a}.x2 > {t}.x0 AND {a}.x1 < {t}.x0 + 1024 AND {a}.y2 > {t}.y0 AND {a}.y1 < {t}.y0 + 1024 AND (least({a}.x2, {t}.x0 + 1024) - greatest({a}.x1, {t}.x0)) * (least({a}.y2, {t}.y0 + 1024) - greatest({a}.y1, {t}.y0)) / (({a}.x2 - {a}.x1) * ({a}.y2 - {a}.y1)) >= 0.3"


_VISIBLE = f"""vis AS (SELECT t.slide_id, t.ordinal, a.ann_idx,
 ((greatest(a.x1, t.x0) + least(a.x2, t.x0 + 1024)) / 2 - t.x0) / 1024 AS xc, ((greatest(a.y1, t.y0) + least(a.y2, t.y0 + 1024)) / 2 - t.y0) / 1024 AS yc,
 (least(a.x2, t.x0 + 1024) - greatest(a.x1, t.x0)) / 1024 AS w, (least(a.y2, t.y0 + 1024) - greatest(a.y1, t.y0)) / 1024 AS h
 FROM pos t JOIN annotations a ON t.slide_id = a.slide_id AND {_seen("a")})"""


def _u(tag: str) -> str:
    return f"CAST('0x' || substr(md5('42|' || slide_id || '|' || try || '|{tag}'), 1, 8) AS BIGINT) / 4294967296.0"


def _cands(tries: int) -> str:
    radii = "[" + ", ".join(f"CAST({r!r} AS DOUBLE)" for r in tiles.radii(EVERY, tries)) + "]"
    at = lambda e, tag: f"greatest(0, least(CAST(round_even({e} / 2.0 - half + 2 * half * ({_u(tag)}), 0) AS BIGINT) - 512, {e} - 1024))"
    return f"""cands AS (SELECT slide_id, try, {at("width", "x")} AS x0, {at("height", "y")} AS y0
 FROM (SELECT *, least(width, height) * {radii}[try // {EVERY} + 1] AS half FROM slides, (SELECT unnest(range({tries})) AS try) n) q)"""


_SAT = "CASE WHEN greatest(r, g, b) = 0 THEN 0 ELSE (510 * (greatest(r, g, b) - least(r, g, b)) + greatest(r, g, b)) // (2 * greatest(r, g, b)) END"

_PARSED = """docs AS (SELECT slide_id, CASE WHEN json_valid(doc) THEN doc::JSON END AS j FROM geojson_docs),
feats AS (SELECT slide_id, i, json_extract(j, '$.features[' || i || ']') AS f FROM (SELECT slide_id, j, unnest(range(json_array_length(j, '$.features')::BIGINT)) AS i FROM docs WHERE j IS NOT NULL) q),
outer_rings AS (SELECT slide_id, i, f, CASE f->'geometry'->>'type' WHEN 'Polygon' THEN [json_extract(f, '$.geometry.coordinates[0]')] WHEN 'MultiPolygon' THEN json_extract(f, '$.geometry.coordinates[*][0]') ELSE [] END AS rs FROM feats),
ringed AS (SELECT slide_id, i, f, len(rs) AS raw, unnest(range(len(rs))) AS p, unnest(rs) AS ring FROM outer_rings),
points AS (SELECT *, json_extract(ring, '$[*][0]') AS xs, json_extract(ring, '$[*][1]') AS ys FROM ringed),
shaped AS (SELECT *, len(xs) >= 3 AND len(list_filter(list_concat(xs, ys), lambda v: json_type(v) NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'BOOLEAN'))) = 0 AS ok FROM points),
boxed AS (SELECT *, CASE WHEN ok THEN list_min(list_transform(xs, lambda v: CAST(v AS DOUBLE))) END AS x1, CASE WHEN ok THEN list_min(list_transform(ys, lambda v: CAST(v AS DOUBLE))) END AS y1,
 CASE WHEN ok THEN list_max(list_transform(xs, lambda v: CAST(v AS DOUBLE))) END AS x2, CASE WHEN ok THEN list_max(list_transform(ys, lambda v: CAST(v AS DOUBLE))) END AS y2 FROM shaped),
rings AS (SELECT *, ok AND coalesce(x2 > x1 AND y2 > y1, false) AS valid FROM boxed)"""

_VALID = f"""{_PARSED}, checked AS (SELECT d.slide_id, d.j IS NULL AS parse_error, coalesce(r.good, 0)::BIGINT AS annotation_count, (coalesce(r.bad, 0) + coalesce(json_array_length(d.j, '$.features'), 0) - coalesce(r.ringed, 0))::BIGINT AS skipped_features
 FROM docs d LEFT JOIN (SELECT slide_id, count(*) FILTER (valid) AS good, count(*) FILTER (NOT valid) AS bad, count(DISTINCT i) AS ringed FROM rings GROUP BY slide_id) r USING (slide_id))"""

_DRY = f"""{_VALID}, dry AS (SELECT slide_id, annotation_count AS raw_pos, annotation_count AS raw_neg, 10 * annotation_count AS total, round_even(10 * annotation_count * 0.75::DOUBLE, 0)::BIGINT AS train,
 10 * annotation_count - round_even(10 * annotation_count * 0.75::DOUBLE, 0)::BIGINT AS val, CASE WHEN parse_error THEN 'failed' WHEN annotation_count = 0 THEN 'skipped' ELSE 'ok' END AS status FROM checked)"""

_PAIRED = """parts AS (SELECT path, regexp_extract(path, '^(.*)/[^/]*$', 1) AS dir, regexp_extract(path, '([^/]*)$', 1) AS name FROM files),
named AS (SELECT path, dir, regexp_extract(name, '(\\.[^.]+)$', 1) AS ext, regexp_replace(name, '\\.[^.]+$', '') AS stem FROM parts),
wsi AS (SELECT * FROM named WHERE lower(ext) IN ('.svs', '.tif', '.tiff', '.ndpi', '.mrxs')),
gt AS (SELECT * FROM named WHERE lower(ext) IN ('.geojson', '.json')),
cand AS (SELECT w.path AS wsi_path, g.path AS gt_path, coalesce(w.dir = g.dir, false) AS same FROM wsi w LEFT JOIN gt g ON g.stem = w.stem OR (w.stem LIKE '%.ome' AND g.stem = left(w.stem, length(w.stem) - 4))),
paired AS (SELECT wsi_path, (list(gt_path ORDER BY NOT same, string_split(gt_path, '/')) FILTER (gt_path IS NOT NULL))[1] AS gt_path,
 CASE WHEN count(*) FILTER (same) > 0 THEN count(*) FILTER (same) > 1 ELSE count(*) FILTER (gt_path IS NOT NULL AND NOT same) > 1 END AS ambiguous FROM cand GROUP BY wsi_path)"""

_LINES = """lines AS (SELECT split, stem, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM (SELECT split, stem, string_split(text, chr(10)) AS ls FROM label_files WHERE has_label) q),
words AS (SELECT *, string_split_regex(trim(line), '\\s+') AS p FROM lines),
boxes AS (SELECT split, stem, line_no, CAST(CAST(p[1] AS DOUBLE) AS BIGINT) AS cls, CAST(p[2] AS DOUBLE) AS xc, CAST(p[3] AS DOUBLE) AS yc, CAST(p[4] AS DOUBLE) AS w, CAST(p[5] AS DOUBLE) AS h
 FROM words WHERE len(p) = 5 AND len(list_filter(p, lambda x: TRY_CAST(x AS DOUBLE) IS NULL)) = 0),
ranged AS (SELECT *, xc BETWEEN 0 AND 1 AND yc BETWEEN 0 AND 1 AND w > 0 AND w <= 1 AND h > 0 AND h <= 1 AS in_range FROM boxes)"""

_SEG_LINES = """seg_cut AS (SELECT stem, unnest(range(len(ls))) + 1 AS line_no, unnest(ls) AS line FROM (SELECT stem, string_split(trim(text, chr(10) || ' '), chr(10)) AS ls FROM seg_files WHERE trim(text, chr(10) || ' ') <> '') q),
seg_words AS (SELECT stem, line_no, string_split_regex(trim(line), '\\s+') AS p FROM seg_cut), seg_values AS (SELECT *, list_transform(p[2:], lambda x: TRY_CAST(x AS FLOAT)) AS vs FROM seg_words),
judged AS (SELECT *, CASE WHEN len(p) < 7 THEN 'too_few' WHEN len(p) % 2 = 0 THEN 'odd' WHEN len(list_filter(vs, lambda x: x IS NULL OR NOT isfinite(x))) > 0 THEN 'not_finite' WHEN len(list_filter(vs, lambda x: x < 0 OR x > 1)) > 0 THEN 'out_of_range' END AS error FROM seg_values)"""

_SEG_STATUS = """file_status AS (SELECT f.stem, CASE WHEN count(j.error) > 0 THEN 0 ELSE count(j.stem) END AS segments, min_by('line ' || j.line_no || ': ' || j.error, j.line_no) FILTER (j.error IS NOT NULL) AS error FROM seg_files f LEFT JOIN judged j ON j.stem = f.stem GROUP BY f.stem)"""

_A, _G, _L = duckdb_with("annotations"), duckdb_with("geojson_docs"), duckdb_with("label_files")
_STEM = lambda kind: f"printf('s%d_{kind}_%06d_x%d_y%d', slide_id, ordinal, x0, y0)"

ORACLE_SQL = {
    "geojson_explode_rings": f"{_G}, {_PARSED}, numbered AS (SELECT *, row_number() OVER (PARTITION BY slide_id ORDER BY i, p) - 1 AS n FROM rings WHERE valid) SELECT slide_id, n AS ann_idx, coalesce(nullif(f->>'id', ''), f->'properties'->>'id', 'ann_' || n) || CASE WHEN raw > 1 THEN '_' || (p + 1) ELSE '' END AS feature_id, x1, y1, x2, y2 FROM numbered",
    "geojson_validate": f"{_G}, {_VALID} SELECT slide_id, annotation_count, skipped_features, parse_error FROM checked",
    "geojson_count": f"{_G} SELECT slide_id, CASE WHEN json_valid(doc) THEN json_array_length(doc::JSON, '$.features')::BIGINT ELSE 0 END AS count, json_valid(doc) AS ok FROM geojson_docs",
    "positive_tiles": f"{_A}, {_POS} SELECT slide_id, ordinal, x0, y0, {_STEM('pos')} AS stem FROM pos",
    "visible_boxes_grid": f"{_A}, {_POS}, {_VISIBLE} SELECT slide_id, ordinal, count(*) AS boxes, md5(string_agg(ann_idx::VARCHAR, ',' ORDER BY ann_idx)) AS ids_md5, " + ", ".join(f"sum(CAST(floor({c} * 1000000 + 0.5::DOUBLE) AS BIGINT))::BIGINT AS sum_{c}" for c in ("xc", "yc", "w", "h")) + " FROM vis WHERE w > 0 AND h > 0 GROUP BY slide_id, ordinal",
    "tile_has_annotation": f"{_A}, {_cands(100)} SELECT * FROM cands t WHERE EXISTS (SELECT 1 FROM annotations a WHERE a.slide_id = t.slide_id AND {_seen('a')})",
    "clean_tiles": f"{_A}, {_cands(100)} SELECT * FROM cands t WHERE NOT EXISTS (SELECT 1 FROM annotations a WHERE a.slide_id = t.slide_id AND {_seen('a')})",
    "tile_split_patch": f"{_A}, {_POS} SELECT slide_id, ordinal, CASE WHEN CAST('0x' || substr(md5('42|' || {_STEM('pos')} || '|split'), 1, 8) AS BIGINT) / 4294967296.0 < 0.75 THEN 'train' ELSE 'val' END AS split FROM pos",
    "slide_split_wsi": f"{duckdb_with('slides')}, ranked AS (SELECT slide_id, row_number() OVER (ORDER BY md5('42|' || slide_id), slide_id) - 1 AS slide_index, count(*) OVER () AS n FROM slides) SELECT slide_id, slide_index, CASE WHEN slide_index < CASE WHEN n <= 1 THEN n ELSE greatest(1, least(n - 1, round_even(n * 0.75::DOUBLE, 0)::BIGINT)) END THEN 'train' ELSE 'val' END AS split FROM ranked",
    "dry_run_estimate": f"{_G}, {_DRY} SELECT * FROM dry",
    "dataset_totals": f"{_G}, {_DRY} SELECT sum(raw_pos)::BIGINT AS raw_pos, sum(raw_neg)::BIGINT AS raw_neg, sum(total)::BIGINT AS total, sum(train)::BIGINT AS train, sum(val)::BIGINT AS val, count(*) FILTER (status = 'ok') AS slides_ok, count(*) FILTER (status = 'skipped') AS slides_skipped, count(*) FILTER (status = 'failed') AS slides_failed FROM dry",
    "pair_by_stem": f"{duckdb_with('files')}, {_PAIRED} SELECT * FROM paired",
    "discovery_diagnostics": f"{duckdb_with('files')}, {_PAIRED} SELECT (SELECT count(*) FROM files) AS total_files, count(*) AS slides, count(gt_path) AS matched, count(*) - count(gt_path) AS unmatched, count(*) FILTER (ambiguous) AS ambiguous, (SELECT count(*) FROM gt) AS annotation_files, (SELECT count(*) FROM gt WHERE path NOT IN (SELECT gt_path FROM paired WHERE gt_path IS NOT NULL)) AS orphans FROM paired",
    "label_lines": f"{_A}, {_POS}, {_VISIBLE} SELECT slide_id, ordinal, string_agg(printf('0 %.6f %.6f %.6f %.6f', xc, yc, w, h), chr(10) ORDER BY ann_idx) || chr(10) AS text FROM vis WHERE w > 0 AND h > 0 GROUP BY slide_id, ordinal",
    "label_parse": f"{_L}, {_LINES} SELECT * FROM ranged",
    "label_integrity": f"""{_L}, {_LINES}, per AS (SELECT split, stem, count(*) AS n, count(*) FILTER (NOT in_range) AS bad FROM ranged GROUP BY split, stem),
j AS (SELECT f.*, coalesce(n, 0) AS n, coalesce(bad, 0) AS bad, contains(f.stem, '_neg_') AS neg FROM label_files f LEFT JOIN per p ON p.split = f.split AND p.stem = f.stem), k AS (SELECT *, has_image AND (has_label OR neg) AS pair FROM j)
SELECT split, count(*) FILTER (has_image) AS images, count(*) FILTER (has_label) AS labels, count(*) FILTER (has_image AND NOT has_label AND NOT neg) AS missing_labels, count(*) FILTER (has_image AND NOT has_label AND neg) AS allowed_missing, count(*) FILTER (has_label AND NOT has_image) AS missing_images,
 count(*) FILTER (pair) AS pairs, count(*) FILTER (pair AND n > 0) AS positives, count(*) FILTER (pair AND n = 0) AS negatives, sum(CASE WHEN pair THEN bad ELSE 0 END)::BIGINT AS coord_errors FROM k GROUP BY split""",
    "seg_label_validate": f"""{duckdb_with("seg_lines")}, q AS (SELECT line_id, string_split_regex(trim(line), '\\s+') AS p FROM seg_lines), v AS (SELECT line_id, len(p) AS n, list_transform(p[2:], lambda x: TRY_CAST(x AS FLOAT)) AS vs FROM q)
SELECT line_id, CASE WHEN n < 7 THEN 'too_few' WHEN n % 2 = 0 THEN 'odd' WHEN len(list_filter(vs, lambda x: x IS NULL OR NOT isfinite(x))) > 0 THEN 'not_finite' WHEN len(list_filter(vs, lambda x: x < 0 OR x > 1)) > 0 THEN 'out_of_range' ELSE 'ok' END AS result FROM v""",
    "sample_per_split": f"{_L}, q AS (SELECT split, CASE WHEN contains(stem, '_neg_') THEN 'neg' ELSE 'pos' END AS kind, stem FROM label_files), z AS (SELECT *, row_number() OVER (PARTITION BY split, kind ORDER BY md5('42|' || stem), stem) AS rank FROM q) SELECT * FROM z WHERE rank <= 100",
    "first_n_labels": f"{_L} SELECT stem FROM label_files WHERE has_label ORDER BY stem LIMIT 10",
    "stem_difference": f"{_L} SELECT split, stem, 'label' AS missing FROM label_files WHERE has_image AND NOT has_label UNION ALL SELECT split, stem, 'image' AS missing FROM label_files WHERE has_label AND NOT has_image",
    "tissue_ratio": f"{duckdb_with('pixels')} SELECT tile_id, count(*) FILTER ({_SAT} > 12 AND greatest(r, g, b) < 245) AS tissue, count(*) AS n, count(*) FILTER ({_SAT} > 12 AND greatest(r, g, b) < 245) / count(*) AS ratio FROM pixels GROUP BY tile_id",
    "augment_gamma": f"{duckdb_with('pixels')} SELECT tile_id, px, " + ", ".join(f"CAST(floor(pow({c} / 255.0::DOUBLE, 1.1::DOUBLE) * 255) AS INTEGER) AS {c}" for c in "rgb") + " FROM pixels",
    "augment_brightness_contrast": f"{duckdb_with('pixels')} SELECT tile_id, px, " + ", ".join(f"CAST(floor(greatest(0, least(255, {c} * 1.0625::DOUBLE + 8))) AS INTEGER) AS {c}" for c in "rgb") + " FROM pixels",
    "augment_hsv": f"""{duckdb_with('pixels')}, a AS (SELECT tile_id, px, r, g, b, greatest(r, g, b) AS v, greatest(r, g, b) - least(r, g, b) AS d, {_SAT} AS s FROM pixels),
h0 AS (SELECT *, CASE WHEN d = 0 THEN 0.0::DOUBLE WHEN v = r THEN 60.0::DOUBLE * (g - b) / d WHEN v = g THEN 120 + 60.0::DOUBLE * (b - r) / d ELSE 240 + 60.0::DOUBLE * (r - g) / d END AS deg FROM a),
h1 AS (SELECT tile_id, px, greatest(0, least(179, CAST(round_even((CASE WHEN deg < 0 THEN deg + 360 ELSE deg END) / 2, 0) AS INTEGER) % 180 + 5))::DOUBLE / 30 AS h, greatest(0, least(255, s + 9))::DOUBLE / 255 AS s, greatest(0, least(255, v - 7))::DOUBLE AS v FROM h0)
SELECT tile_id, px, """ + ", ".join(f"CAST(round_even(v - v * s * greatest(0.0::DOUBLE, least(({n} + h) % 6, 4 - ({n} + h) % 6, 1.0::DOUBLE)), 0) AS INTEGER) AS {c}" for n, c in ((5, "r"), (3, "g"), (1, "b"))) + " FROM h1",
    "geojson_count_totals": f"{_G}, c AS (SELECT CASE WHEN json_valid(doc) THEN json_array_length(doc::JSON, '$.features')::BIGINT ELSE 0 END AS count, json_valid(doc) AS ok FROM geojson_docs) SELECT coalesce(sum(count) FILTER (ok), 0)::BIGINT AS total, count(*) FILTER (ok) AS parsed, count(*) FILTER (NOT ok) AS failed FROM c",
    "written_by_split": f"{_A}, {_POS}, cut AS (SELECT slide_id, CAST('0x' || substr(md5('42|' || {_STEM('pos')} || '|split'), 1, 8) AS BIGINT) / 4294967296.0 < 0.75 AS train FROM pos) SELECT slide_id, 5 * count(*) FILTER (train) AS written_train, 5 * count(*) FILTER (NOT train) AS written_val FROM cut GROUP BY slide_id",
    "dry_run_wsi": f"{_G}, {_DRY}, ranked AS (SELECT slide_id, row_number() OVER (ORDER BY md5('42|' || slide_id), slide_id) - 1 AS i, count(*) OVER () AS n FROM slides), side AS (SELECT slide_id, i < CASE WHEN n <= 1 THEN n ELSE greatest(1, least(n - 1, round_even(n * 0.75::DOUBLE, 0)::BIGINT)) END AS t FROM ranked) SELECT slide_id, raw_pos, raw_neg, total, CASE WHEN t THEN total ELSE 0 END AS train, CASE WHEN t THEN 0 ELSE total END AS val, status FROM dry JOIN side USING (slide_id)",
    "build_totals": f"{duckdb_with('slide_results')} SELECT " + ", ".join(f"coalesce(sum({c}), 0)::BIGINT AS {c}" for c in reporting.COUNTERS) + ", count(*) FILTER (status = 'ok') AS slides_ok, count(*) FILTER (status = 'skipped') AS slides_skipped, count(*) FILTER (status NOT IN ('ok', 'skipped')) AS slides_failed FROM slide_results",
    "slide_status_text": f"{duckdb_with('slide_results')} SELECT slide_stem, CASE status WHEN 'ok' THEN '{reporting.STATUS_TEXT['ok']}' WHEN 'skipped' THEN '{reporting.STATUS_TEXT['skipped']}' WHEN 'failed' THEN '{reporting.STATUS_TEXT['failed']}' ELSE status END AS status_text, CASE WHEN skip_reason = 'empty_annotations' THEN '{reporting.SKIP_TEXT['empty_annotations']}' END AS skip_reason_text FROM slide_results",
    "probe_pairs": f"{duckdb_with('files')}, {_PAIRED} SELECT w.path AS wsi_path, (list(g.path ORDER BY g.ext, g.stem <> w.stem) FILTER (g.path IS NOT NULL))[1] AS gt_path FROM wsi w LEFT JOIN gt g ON g.dir = w.dir AND g.ext IN ('.geojson', '.json') AND (g.stem = w.stem OR (w.stem LIKE '%.ome' AND g.stem = left(w.stem, length(w.stem) - 4))) GROUP BY w.path",
    "discovery_counters": f"{duckdb_with('files', 'geojson_docs')}, {_PAIRED}, {_VALID} SELECT (SELECT count(*) FROM files) AS total_files, count(*) AS slides, count(gt_path) AS matched, count(*) - count(gt_path) AS unmatched, count(*) FILTER (ambiguous) AS ambiguous, (SELECT count(*) FROM gt) AS annotation_files, (SELECT count(*) FROM gt WHERE path NOT IN (SELECT gt_path FROM paired WHERE gt_path IS NOT NULL)) AS orphans, (SELECT count(*) FILTER (parse_error) FROM checked) AS invalid_annotations, (SELECT count(*) FILTER (NOT parse_error AND annotation_count = 0) FROM checked) AS empty_annotations, (SELECT sum(skipped_features)::BIGINT FROM checked) AS skipped_features FROM paired",
    "image_label_pairs": f"{_L} SELECT split, stem, CASE WHEN has_label THEN text END AS text FROM label_files WHERE has_image AND (has_label OR contains(stem, '_neg_'))",
    "label_boxes_pixels": f"{_L}, {_LINES} SELECT split, stem, line_no, " + ", ".join(f"greatest(0, least({e} - 1, CAST(round_even(({a}c {o} {b} / 2) * {e}, 0) AS BIGINT))) AS p{a}{k}" for k, o in ((1, "-"), (2, "+")) for a, b, e in (("x", "w", 1024), ("y", "h", 768))) + " FROM ranged",
    "seg_points_pixels": f"{duckdb_with('seg_files')}, {_SEG_LINES} SELECT stem, line_no, TRY_CAST(TRY_CAST(p[1] AS DOUBLE) AS BIGINT) AS cls, i, " + ", ".join(f"greatest(0, least(1023, CAST(round_even((vs[2 * i + {k}] * 1024::FLOAT)::DOUBLE, 0) AS INTEGER))) AS {c}" for k, c in ((1, "x"), (2, "y"))) + " FROM (SELECT *, unnest(range(len(vs) // 2)) AS i FROM judged WHERE error IS NULL) q",
    "seg_file_status": f"{duckdb_with('seg_files')}, {_SEG_LINES}, {_SEG_STATUS} SELECT stem, segments, error FROM file_status",
    "seg_file_totals": f"{duckdb_with('seg_files')}, {_SEG_LINES}, {_SEG_STATUS} SELECT count(*) AS files, count(*) FILTER (error IS NULL AND segments = 0) AS empty_files, count(*) FILTER (error IS NOT NULL) AS bad_files FROM file_status",
    "base_images": f"{duckdb_with('seg_files', 'base_images')}, f AS (SELECT path, regexp_extract(path, '([^/]*)\\.[^.]*$', 1) AS stem, list_position(['.jpg', '.jpeg', '.png'], regexp_extract(path, '(\\.[^.]*)$', 1)) AS rank FROM base_images) SELECT s.stem, (list(f.path ORDER BY f.rank) FILTER (f.path IS NOT NULL))[1] AS path FROM seg_files s LEFT JOIN f ON f.stem = s.stem GROUP BY s.stem",
}
