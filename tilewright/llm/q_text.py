"""Queries over statistics of texts: quality classifier (6), quality rules (9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import decision_list, rule_ensemble
from tilewright.llm.common import remainder, table


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by the rule ensemble, learnt from rows with a remainder other than 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = rule_ensemble.learn(docs, table(spark, sf_dir, "labels"), learn_if=remainder(F.col("tw_id")) != 0)
    scored = rule_ensemble.score(docs, model)
    return scored.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), F.col("tw_score").alias("score")).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the learned decision list's verdict on every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = decision_list.learn(docs, table(spark, sf_dir, "labels"))
    q = decision_list.judge(docs, rules)
    return q.select("doc_id", *[F.col(f"tw_q.{n}").alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")])


QUERIES = {"op6_quality_classifier": op6_quality_classifier, "op9_quality_rules": op9_quality_rules}
ORACLE_SQL: dict[str, str] = {}
