"""Query over texts as language: LM scoring (7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import maxent
from tilewright.llm.common import remainder, table


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's log10 probability, by the model and by the base."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return maxent.score(docs, remainder(F.col("doc_id")) == 1)


QUERIES = {"op7_lm_scoring": op7_lm_scoring}
