"""GeoJSON documents: outer rings, valid annotations, validation and counts. Native, by way of VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|BOOLEAN|DECIMAL.*)$"
_RINGS = "array<array<variant>>"
#: GeoJSON geometry types, fixed by the format.
GEOMETRIES = ("Point", "MultiPoint", "LineString", "MultiLineString", "Polygon", "MultiPolygon", "GeometryCollection")


def features(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """One row a feature, with its position; documents that don't parse or have none give no rows."""
    parsed = docs.withColumn("v", F.try_parse_json(doc))
    listed = F.try_variant_get("v", "$.features", "array<variant>")
    return parsed.select(*[c for c in docs.columns if c != doc], F.posexplode(listed).alias("feature_pos", "feature"))


def rings(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """One row an outer ring. Polygons have one, multipolygons one a part; null rings don't count as raw ones."""
    f = features(docs, doc)
    kind = F.try_variant_get("feature", "$.geometry.type", "string")
    one = F.array(F.try_variant_get("feature", "$.geometry.coordinates[0]", "array<variant>"))
    many = F.transform(F.try_variant_get("feature", "$.geometry.coordinates", "array<variant>"), lambda p: F.try_variant_get(p, "$[0]", "array<variant>"))
    outer = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many)
    f = f.withColumn("rs", F.filter(outer.cast(_RINGS), lambda r: r.isNotNull()))
    keep = [c for c in f.columns if c not in ("feature", "rs")]
    out = f.select(*keep, "feature", F.size("rs").alias("raw"), F.posexplode("rs").alias("ring_pos", "ring"))
    number = lambda p, i: F.coalesce(F.schema_of_variant(F.try_variant_get(p, f"$[{i}]", "variant")).rlike(_NUMBER), F.lit(False))
    shaped = (F.size("ring") >= 3) & F.forall("ring", lambda p: number(p, 0) & number(p, 1))
    at = lambda i: F.transform("ring", lambda p: F.try_variant_get(p, f"$[{i}]", "double"))
    out = out.withColumn("ok", shaped)
    for c, i, pick in (("x1", 0, F.array_min), ("y1", 1, F.array_min), ("x2", 0, F.array_max), ("y2", 1, F.array_max)):
        out = out.withColumn(c, F.when(F.col("ok"), pick(at(i))))
    return out.withColumn("valid", F.col("ok") & F.coalesce((F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1")), F.lit(False)))


def _truthy(v: Column) -> Column:
    """A JSON value as text where it counts as true, else null; booleans as True and False."""
    kind, text = F.schema_of_variant(v), F.try_variant_get(v, "$", "string")
    zero = kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$") & (F.try_variant_get(v, "$", "double") == 0)
    return F.when(v.isNull() | (kind == "VOID") | zero | (text == "") | ((kind == "BOOLEAN") & (text == "false")), None).when(kind == "BOOLEAN", F.lit("True")).otherwise(text)


def annotations(docs: DataFrame, key: str = "slide_id", doc: str = "doc") -> DataFrame:
    """Valid rings in document order: ann_idx, feature_id and box."""
    order = Window.partitionBy(key).orderBy("feature_pos", "ring_pos")
    r = rings(docs, doc).withColumn("n", F.sum(F.col("valid").cast("bigint")).over(order) - F.col("valid").cast("bigint"))
    at = lambda path: F.try_variant_get("feature", path, "variant")
    second = F.when(F.schema_of_variant(at("$.properties.id")) == "VOID", F.lit("None")).otherwise(F.coalesce(F.when(F.schema_of_variant(at("$.properties.id")) == "BOOLEAN", F.initcap(F.try_variant_get("feature", "$.properties.id", "string"))), F.try_variant_get("feature", "$.properties.id", "string")))
    name = F.coalesce(_truthy(at("$.id")), second, F.concat(F.lit("ann_"), F.col("n").cast("string")))
    full = F.concat(name, F.when(F.col("raw") > 1, F.concat(F.lit("_"), (F.col("ring_pos") + 1).cast("string"))).otherwise(F.lit("")))
    return r.where("valid").select(key, F.col("n").alias("ann_idx"), full.alias("feature_id"), "x1", "y1", "x2", "y2")


def validate(docs: DataFrame, key: str = "slide_id", doc: str = "doc") -> DataFrame:
    """One row a document: valid annotations, skipped rings (a feature without rings is one), and whether it fails to parse."""
    flat = rings(docs, doc).groupBy(key).agg(F.count_if("valid").alias("ok"), F.count_if(~F.col("valid")).alias("bad"), F.count_distinct("feature_pos").alias("ringed"))
    parsed = F.try_parse_json(doc)
    top = docs.select(key, parsed.isNull().alias("parse_error"), F.coalesce(F.size(F.try_variant_get(parsed, "$.features", "array<variant>")), F.lit(0)).cast("bigint").alias("nf"))
    out = top.join(flat, key, "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return out.select(key, zero("ok").alias("annotation_count"), (zero("bad") + F.greatest(F.col("nf"), F.lit(0)) - zero("ringed")).alias("skipped_features"), "parse_error")


def count_objects(docs: DataFrame, key: str = "slide_id", doc: str = "doc") -> DataFrame:
    """One row a document: how many GeoJSON objects it holds, and whether it parses."""
    v = F.try_parse_json(doc)
    kind, listed = F.try_variant_get("v", "$.type", "string"), F.try_variant_get("v", "$.features", "array<variant>")
    n = F.coalesce(F.when(listed.isNotNull(), F.size(listed)), F.lit(0))
    count = F.when(F.col("v").isNull(), 0).when(kind == "FeatureCollection", n).when(kind == "Feature", 1).when(kind.isin(*GEOMETRIES), 1).when(kind.isNull(), n).otherwise(0)
    return docs.withColumn("v", v).select(key, count.cast("bigint").alias("count"), F.col("v").isNotNull().alias("ok"))


def count_totals(counts: DataFrame) -> DataFrame:
    """One row: objects of all files that parse, and how many do and don't."""
    ok = F.col("ok")
    return counts.agg(F.coalesce(F.sum(F.when(ok, F.col("count"))), F.lit(0)).cast("bigint").alias("total"), F.count_if(ok).alias("parsed"), F.count_if(~ok).alias("failed"))


def sorted_counts(counts: DataFrame, mode: str = "path", key: str = "path") -> DataFrame:
    """By path, by count from the highest (equal ones by path), or as they come."""
    if mode == "path":
        return counts.orderBy(key)
    if mode == "count":
        return counts.orderBy(F.desc("count"), key)
    return counts
