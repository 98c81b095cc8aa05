"""Queries over repeated passages: suffix-array dedup (1), substring dedup (5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilewright.llm import debruijn, suffix_dedup
from tilewright.llm.common import table


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without the bytes that 200-byte repeats cover."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.digests(suffix_dedup.with_spans(docs))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without words that 50-word windows of documents with smaller ids cover."""
    return debruijn.digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op1_suffix_array_dedup": op1_suffix_array_dedup, "op5_substring_dedup": op5_substring_dedup}

#: Covered units [lo, hi) of each row r from the starts p of windows that repeat (``again``), and the units between them.
_SPANS = """
flagged AS (SELECT r, p, CASE WHEN p <= LAG(p) OVER (PARTITION BY r ORDER BY p) + {window} THEN 0 ELSE 1 END AS fresh FROM again),
runs AS (SELECT r, p, SUM(fresh) OVER (PARTITION BY r ORDER BY p) AS run FROM flagged),
spans AS (SELECT r, MIN(p) AS lo, MAX(p) + {window} AS hi FROM runs GROUP BY r, run),
gaps AS (SELECT r, lo, hi, COALESCE(LAG(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS since FROM spans)"""

#: All windows of all rows, each by a digest of what it holds.
ORACLE_SQL = {
    "op1_suffix_array_dedup": f"""
WITH d AS (SELECT doc_id, encode(COALESCE(text, '')) AS raw, row_number() OVER () AS r FROM documents),
starts AS (SELECT r, raw, unnest(range(0, octet_length(raw) - 199)) AS p FROM d),
named AS (SELECT r, p, md5_number(raw[p + 1 : p + 200]) AS w FROM starts),
again AS (SELECT r, p FROM named WHERE w IN (SELECT w FROM named GROUP BY w HAVING COUNT(*) > 1)),{_SPANS.format(window=200)},
cut AS (SELECT r, SUM(hi - lo) AS gone, COUNT(*) AS n, MAX(hi) AS last, string_agg(CASE WHEN lo > since THEN hex(raw[since + 1 : lo]) ELSE '' END, '' ORDER BY lo) AS kept FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(octet_length(raw) AS BIGINT) AS n_bytes, CAST(COALESCE(gone, 0) AS BIGINT) AS n_removed, CAST(COALESCE(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(COALESCE(kept, '') || CASE WHEN COALESCE(last, 0) < octet_length(raw) THEN hex(raw[COALESCE(last, 0) + 1 : octet_length(raw)]) ELSE '' END)) AS kept_sha256
FROM d LEFT JOIN cut USING (r)""",
    "op5_substring_dedup": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words, row_number() OVER () AS r FROM documents),
starts AS (SELECT r, doc_id, words, unnest(range(0, len(words) - 49)) AS p FROM d),
named AS (SELECT r, doc_id, p, md5_number(array_to_string(words[p + 1 : p + 50], ' ')) AS w FROM starts),
again AS (SELECT r, p FROM named JOIN (SELECT w, MIN(doc_id) AS least FROM named GROUP BY w) AS f USING (w) WHERE least < doc_id),{_SPANS.format(window=50)},
cut AS (SELECT r, SUM(hi - lo) AS gone, MAX(hi) AS last, flatten(list(words[since + 1 : lo] ORDER BY lo)) AS kept FROM gaps JOIN d USING (r) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(COALESCE(gone, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_concat(COALESCE(kept, CAST([] AS VARCHAR[])), words[COALESCE(last, 0) + 1 : len(words)]), ' ')) AS kept_sha256
FROM d LEFT JOIN cut USING (r)""",
}
