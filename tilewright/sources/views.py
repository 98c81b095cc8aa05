"""Input views derived from the driver's tables, as SQL that Spark and DuckDB both read.

Only the aggregation of text differs between the two; ``dialect`` picks it. Spark reads
the tables by their paths, so no name of a user's own view is touched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SLIDES = """SELECT CAST(s_suppkey AS BIGINT) AS slide_id,
 CAST(CASE WHEN s_suppkey % 17 = 0 THEN 800 ELSE 8000 + 1000 * (s_suppkey % 13) END AS BIGINT) AS width,
 CAST(6000 + 1000 * (s_suppkey % 11) AS BIGINT) AS height FROM supplier"""

_ANNOTATIONS = """SELECT slide_id, row_number() OVER (PARTITION BY slide_id ORDER BY ok, ln) - 1 AS ann_idx,
 CAST(x AS DOUBLE) AS x1, CAST(y AS DOUBLE) AS y1, CAST(x + bw AS DOUBLE) AS x2, CAST(y + bh AS DOUBLE) AS y2
FROM (SELECT s.slide_id, g.ok, g.ln, (g.ok * 7919 + g.ln * 104729) % s.width AS x, (g.pk * 6151 + g.ln * 15485863) % s.height AS y,
  CASE WHEN g.ok % 50 = 0 THEN 3000 ELSE 20 + (g.ok * 31 + g.ln) % 900 END AS bw, 20 + (g.pk * 17 + g.ln) % 900 AS bh
 FROM (SELECT CAST(l_suppkey AS BIGINT) AS sk, CAST(l_orderkey AS BIGINT) AS ok, CAST(l_linenumber AS BIGINT) AS ln, CAST(min(l_partkey) AS BIGINT) AS pk
  FROM lineitem GROUP BY l_suppkey, l_orderkey, l_linenumber) g JOIN slides s ON s.slide_id = g.sk) b"""

#: Feature texts by kind of annotation: eight layouts, valid and not.
_FEATURES = """SELECT slide_id, ann_idx, CASE ann_idx % 8
 WHEN 0 THEN '{"type":"Feature","id":"a' || ann_idx || '","geometry":{"type":"Polygon","coordinates":[' || ring || ']},"properties":{}}'
 WHEN 1 THEN '{"type":"Feature","geometry":{"type":"Polygon","coordinates":[' || ring || ']},"properties":{"id":"p' || ann_idx || '"}}'
 WHEN 2 THEN '{"type":"Feature","geometry":{"type":"Polygon","coordinates":[' || ring || ']},"properties":{}}'
 WHEN 3 THEN '{"type":"Feature","id":"m' || ann_idx || '","geometry":{"type":"MultiPolygon","coordinates":[[' || ring || '],[[[1,1],[2,2]]],[' || ring || ']]},"properties":{}}'
 WHEN 4 THEN '{"type":"Feature","id":"l' || ann_idx || '","geometry":{"type":"LineString","coordinates":[[1,1],[2,2]]},"properties":{}}'
 WHEN 5 THEN '{"type":"Feature","id":"t' || ann_idx || '","geometry":{"type":"Polygon","coordinates":[[[1,1],[2,2]]]},"properties":{}}'
 WHEN 6 THEN '{"type":"Feature","id":"z' || ann_idx || '","geometry":{"type":"Polygon","coordinates":[[[5,5],[5,9],[5,7]]]},"properties":{}}'
 ELSE '{"type":"Feature","id":"n' || ann_idx || '","geometry":{"type":"Polygon","coordinates":[[["1","1"],["9","1"],["9","9"]]]},"properties":{}}' END AS f
FROM (SELECT slide_id, ann_idx, '[[' || a || ',' || b || '],[' || c || ',' || b || '],[' || c || ',' || d || '],[' || a || ',' || b || ']]' AS ring
 FROM (SELECT slide_id, ann_idx, CAST(x1 AS BIGINT) AS a, CAST(y1 AS BIGINT) AS b, CAST(x2 AS BIGINT) AS c, CAST(y2 AS BIGINT) AS d FROM annotations WHERE slide_id % 20 <> 19) q) r"""

_JOINED = {"spark": "array_join(transform(sort_array(collect_list(struct(ann_idx, f))), x -> x.f), ',')", "duckdb": "string_agg(f, ',' ORDER BY ann_idx)"}

_FILES = """SELECT 'd' || (k % 7) || '/case_' || k || CASE k % 6 WHEN 0 THEN '.svs' WHEN 1 THEN '.ome.tif' WHEN 2 THEN '.NDPI' WHEN 3 THEN '.tiff' WHEN 4 THEN '.mrxs' ELSE '.txt' END AS path FROM ks WHERE k % 5 <> 4
UNION ALL SELECT 'd' || ((k + CASE WHEN k % 9 = 0 THEN 1 ELSE 0 END) % 7) || '/case_' || k || CASE WHEN k % 2 = 0 THEN '.geojson' ELSE '.json' END AS path FROM ks WHERE k % 4 <> 3
UNION ALL SELECT 'd' || (k % 7) || '/case_' || k || '.ome.json' AS path FROM ks WHERE k % 11 = 0"""

_LABELS = """SELECT slide_id, CASE WHEN ann_idx % 5 = 0 THEN 'val' ELSE 'train' END AS split,
 's' || slide_id || CASE WHEN ann_idx % 3 = 0 THEN '_neg_' ELSE '_pos_' END || ann_idx AS stem,
 ann_idx % 13 <> 0 AS has_image, ann_idx % 11 <> 0 AS has_label,
 CASE WHEN ann_idx % 3 = 0 THEN '' WHEN ann_idx % 29 = 1 THEN '0 0.4 1.7 0.3 0.15' WHEN ann_idx % 31 = 1 THEN 'bad line' ELSE '0 0.5 0.5 0.25 0.' || (1 + ann_idx % 9) END AS text FROM annotations"""

_SEG = """SELECT CAST(p_partkey AS BIGINT) AS line_id, CASE p_partkey % 6 WHEN 0 THEN '1 0.15 0.25 0.65 0.35 0.45 0.85' WHEN 1 THEN '1 0.15 0.25 0.65 0.35'
 WHEN 2 THEN '1 0.15 0.25 0.65 0.35 0.45 0.85 0.55' WHEN 3 THEN '1 0.15 0.25 nan 0.35 0.45 0.85' WHEN 4 THEN '1 0.15 0.25 1.75 0.35 0.45 0.85' ELSE '2 0 0 1 0 1 1 0 1' END AS line FROM part"""

_IMAGES = "SELECT split, stem FROM label_files WHERE has_image"
_LABEL_TEXTS = "SELECT split, stem, text FROM label_files WHERE has_label"

#: Segmentation files of three lines each, some empty, and base images beside some of them, in up to three formats.
_SEG_FILES = """SELECT 'f' || f AS stem, CASE WHEN f % 7 = 0 THEN '' ELSE a || chr(10) || CASE WHEN f % 5 = 0 THEN b ELSE a END || chr(10) || a END AS text
FROM (SELECT line_id AS f, '3 0.05 0.1 0.95 0.2 0.5 0.' || (1 + line_id % 9) AS a, line AS b FROM seg_lines) q"""
_BASES = """SELECT 'im/f' || line_id || '.png' AS path FROM seg_lines WHERE line_id % 3 = 0
UNION ALL SELECT 'im/f' || line_id || '.jpeg' AS path FROM seg_lines WHERE line_id % 4 = 0
UNION ALL SELECT 'im/f' || line_id || '.jpg' AS path FROM seg_lines WHERE line_id % 6 = 0"""

#: What slides of a build may have come to.
_RESULTS = """SELECT 's' || slide_id AS slide_stem, CASE WHEN slide_id % 9 = 4 THEN 'failed' WHEN slide_id % 9 = 5 THEN 'skipped' ELSE 'ok' END AS status,
 CASE WHEN slide_id % 9 = 5 THEN 'empty_annotations' ELSE '' END AS skip_reason, width % 700 AS raw_pos, width % 650 AS raw_neg, width % 3000 AS written_train, height % 900 AS written_val,
 width % 50 AS failed_neg, height % 40 AS neg_reject_duplicate, width % 1300 AS neg_reject_annotation, CASE WHEN slide_id % 4 <> 0 THEN height % 70 END AS neg_reject_low_tissue, width % 50 AS neg_reject_try_limit FROM slides"""

_PIXELS = """SELECT CAST(floor(p_partkey / 64) AS BIGINT) AS tile_id, CAST(p_partkey AS BIGINT) AS px, CAST((p_partkey * 37) % 256 AS INT) AS r,
 CAST((p_partkey * 91 + p_partkey % 5) % 256 AS INT) AS g, CAST((p_partkey * 53 + 7) % 256 AS INT) AS b FROM part"""

_NEEDS = {"slides": ("supplier",), "annotations": ("lineitem", "supplier"), "geojson_docs": ("lineitem", "supplier"), "files": ("orders",), "label_files": ("lineitem", "supplier"), "seg_lines": ("part",), "pixels": ("part",), "image_files": ("lineitem", "supplier"), "label_texts": ("lineitem", "supplier"), "seg_files": ("part",), "base_images": ("part",), "slide_results": ("supplier",)}


def ctes(name: str, dialect: str) -> list[tuple[str, str]]:
    """The view and what it is made of, in order."""
    docs = f"""SELECT slide_id, '{{"type":"FeatureCollection","features":[' || {_JOINED[dialect]} || ']}}' AS doc FROM features GROUP BY slide_id
UNION ALL SELECT slide_id, CASE WHEN slide_id % 40 = 19 THEN 'not json' ELSE '{{"features":[]}}' END AS doc FROM slides WHERE slide_id % 20 = 19"""
    base = [("slides", _SLIDES), ("annotations", _ANNOTATIONS)]
    return {
        "slides": base[:1],
        "annotations": base,
        "geojson_docs": [*base, ("features", _FEATURES), ("geojson_docs", docs)],
        "files": [("ks", "SELECT DISTINCT CAST(o_orderkey AS BIGINT) AS k FROM orders"), ("files", _FILES)],
        "label_files": [*base, ("label_files", _LABELS)],
        "image_files": [*base, ("label_files", _LABELS), ("image_files", _IMAGES)],
        "label_texts": [*base, ("label_files", _LABELS), ("label_texts", _LABEL_TEXTS)],
        "seg_lines": [("seg_lines", _SEG)],
        "seg_files": [("seg_lines", _SEG), ("seg_files", _SEG_FILES)],
        "base_images": [("seg_lines", _SEG), ("base_images", _BASES)],
        "slide_results": [*base[:1], ("slide_results", _RESULTS)],
        "pixels": [("pixels", _PIXELS)],
    }[name]


def duckdb_with(*names: str) -> str:
    """A WITH clause for DuckDB that defines the views."""
    seen: dict[str, str] = {}
    for n in names:
        seen |= dict(ctes(n, "duckdb"))
    return "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in seen.items())


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived views."""
    tables = [(t, f"SELECT * FROM parquet.`{sf_dir}/{t}.parquet`") for t in _NEEDS[name]]
    head = ",\n".join(f"{k} AS ({v})" for k, v in [*tables, *ctes(name, "spark")])
    return spark.sql(f"WITH {head}\nSELECT * FROM {name}")
