"""Query over near-duplicate texts: DartMinHash (3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import dartminhash
from tilewright.llm.common import table


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document, by the class's smallest id, and whether it stays."""
    found = dartminhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


QUERIES = {"op3_minhash_near_dedup": op3_minhash_near_dedup}

#: Distinct texts t, their sets s of five-word shingles (a shorter text: one of all its words), links of a similarity of 0.8 or more
#: (9 common >= 4 (n + n)), and what links reach.
ORACLE_SQL = {
    "op3_minhash_near_dedup": r"""
WITH RECURSIVE t AS (SELECT text, id, row_number() OVER (ORDER BY id NULLS FIRST) AS k FROM (
  SELECT COALESCE(text, '') AS text, CASE WHEN COUNT(*) = COUNT(doc_id) THEN MIN(doc_id) END AS id FROM documents GROUP BY 1)),
w AS (SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM t),
s AS (SELECT DISTINCT k, md5_number(array_to_string(words[p : p + 4], ' ')) AS h FROM (SELECT k, words, unnest(range(1, greatest(len(words) - 3, 2))) AS p FROM w WHERE len(words) > 0)),
n AS (SELECT k, COUNT(*) AS n FROM s GROUP BY k),
links AS (SELECT a.k AS a, b.k AS b FROM s AS a JOIN s AS b ON a.h = b.h AND a.k < b.k JOIN n AS x ON x.k = a.k JOIN n AS y ON y.k = b.k
  GROUP BY a.k, b.k, x.n, y.n HAVING 9 * COUNT(*) >= 4 * (x.n + y.n)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT k, k AS c FROM t UNION SELECT reach.k, sides.b FROM reach JOIN sides ON reach.c = sides.a),
top AS (SELECT k, MIN(c) AS c FROM reach GROUP BY k)
SELECT d.doc_id, f.id AS class_id, d.doc_id IS NOT DISTINCT FROM f.id AS kept
FROM documents AS d JOIN t ON t.text = COALESCE(d.text, '') JOIN top ON top.k = t.k JOIN t AS f ON f.k = top.c"""
}
