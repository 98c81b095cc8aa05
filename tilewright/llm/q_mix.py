"""Query over domains of texts: mixing to target weights (8)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import soft_mixing
from tilewright.llm.common import stored, table


def op8_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's domain posteriors, its rate, and how often it is taken."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = soft_mixing.learn(docs, table(spark, sf_dir, "labels"))
    seen = stored(docs.select("doc_id", soft_mixing.statistics(F.col("text"), model).alias("tw_mix")), "statistics")
    out = soft_mixing.rated(seen, model, ready=True)
    return out.select("doc_id", "tw_mix.n_tokens", *[F.col(f"tw_mix.p_{d}").alias(f"p_{d}") for d in soft_mixing.DOMAINS], "tw_mix.rate", soft_mixing.copies(F.col("tw_mix.rate"), F.col("doc_id")).alias("copies"))


QUERIES = {"op8_soft_mixing": op8_soft_mixing}
