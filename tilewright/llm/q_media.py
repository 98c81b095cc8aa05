"""Query over texts as media: baseline JPEG columns (4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tilewright.llm import media
from tilewright.llm.common import table


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as a JPEG image, read back, and the image's features.

    The key carries the text's size along, so no join is needed.
    """
    docs = table(spark, sf_dir, "documents").select(F.struct("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")).alias("k"), "text")
    seen = media.describe(media.store_texts(docs, "k"), "k")
    return seen.select(
        "k.doc_id",
        "k.n_bytes",
        F.col("samples_bytes").alias("payload_bytes"),
        F.col("samples_sha256").alias("payload_sha256"),
        "tail_crc32",
        "media_bytes",
        "media_sha256",
        F.concat_ws("", F.col("width").cast("string"), F.lit("x"), F.col("height").cast("string"), F.lit(":"), "thumb_hash").alias("feature"),
    )


QUERIES = {"op4_media_columns": op4_media_columns}
