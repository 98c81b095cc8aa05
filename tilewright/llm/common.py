"""Shared pieces: the shared folder, reading tables, labelled samples."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows and bytes of an Arrow batch, at most: texts may be long, and a batch stands in memory whole.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's bounds of Arrow batches to those of BATCH. A smaller bound stays."""
    for name, most in BATCH.items():
        said = spark.conf.get(name, None)
        if not (said and said.isdigit() and 0 < int(said) <= most):
            spark.conf.set(name, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df lacks: the given one, with as many underscores behind it as that takes."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.

    A session on one machine that names none gets a folder in its warehouse; on a cluster that is an error.
    """
    said = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not said:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        said = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return said.rstrip("/")


def stored(df: DataFrame, label: str = "t") -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it again: a cut in the lineage that survives lost executors."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes tables of stored() that no later step reads."""
    for df in tables:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(conf).delete(path, True)


def remainder(doc_id: Column, of: int = 5) -> Column:
    """crc32 of the id as text, modulo a number: the split into learning and held-out rows."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % of


def labelled(docs: DataFrame, labels: DataFrame, target: str, most: int, learn: Column | None = None) -> DataFrame:
    """At most ``most`` documents (id, text, y) with a label: those of the smallest hashes of their ids.

    The sample is bounded, so its ids may be broadcast. Ids labelled more than once take
    their smallest label; rows with a null id or label don't count.
    """
    ids = labels.select(F.col("doc_id").alias("tw_id"), F.col(target).cast("int").alias("y")).where(F.col("tw_id").isNotNull() & F.col("y").isNotNull())
    if learn is not None:
        ids = ids.where(learn)
    ids = ids.groupBy("tw_id").agg(F.min("y").alias("y"))
    ids = ids.orderBy(F.xxhash64("tw_id"), "tw_id").limit(most)
    d = docs.select(F.col("doc_id").alias("tw_id"), F.col("text"))
    return d.join(F.broadcast(ids), "tw_id")
