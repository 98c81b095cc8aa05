"""From raw documents to tokens: the stages of the corpus pipeline, in order.

Each stage works on all that its predecessor kept, and its decisions take effect. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import dartminhash, decision_list, q_bpe, soft_mixing, suffix_dedup
from tilewright.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the base rules or the learned list reject go."""
    return decision_list.keep(docs, decision_list.learn(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: one document of each class of near duplicates stays, that of the smallest id."""
    return dartminhash.keep_first(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: bytes that 200-byte repeats cover are cut from the texts; n_chars follows."""
    out = suffix_dedup.cleaned(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def target_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: poor and toxic texts are thinned towards their targets; clean ones stay, once each."""
    return soft_mixing.mixed(docs, soft_mixing.learn(docs, table(spark, sf_dir, "labels")), headroom=1.1, max_rate=1.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: what is left, encoded, and decoded again."""
    return q_bpe.tokenized(docs.select("doc_id", "text"))


STAGES = [("quality_rules", quality_rules), ("minhash_near_dedup", near_dedup), ("suffix_array_dedup", passage_dedup), ("soft_mixing", target_mix), ("bpe_encoding", tokens)]

#: SQL can't express the learned and iterative stages; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
