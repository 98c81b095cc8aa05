"""Query over texts as tokens: BPE encoding and decoding (2)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tilewright.llm import bpe
from tilewright.llm.common import table

#: Where the public vocabularies are described; a parameter of everything here.
VOCABULARY = "byte_bpe_50k.json"


def vocabulary_text(name: str = VOCABULARY) -> str:
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def _digests(b: pa.RecordBatch) -> pa.RecordBatch:
    """Of rows (doc_id, ids, text): doc_id, n_tokens and the digests of ids and text."""
    sha = lambda raw: hashlib.sha256(raw).hexdigest()
    ids = b.column(1)
    off, raw = np.asarray(ids.offsets).tolist(), np.asarray(ids.values).astype("<u4").tobytes()
    ends = list(zip(off, off[1:], strict=False))
    return pa.RecordBatch.from_arrays(
        [
            b.column(0),
            pa.array([y - x for x, y in ends], pa.int64()),
            pa.array([sha(raw[4 * x : 4 * y]) for x, y in ends], pa.string()),
            pa.array([sha(t.encode()) for t in b.column(2).to_pylist()], pa.string()),
        ],
        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def tokenized(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """Every text encoded and decoded again: the digests of both, made where the ids are."""
    spoken = vocabulary_text(name)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return bpe.applied(docs, spoken, bpe.lexicon(docs, spoken), _digests, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op2_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    return tokenized(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op2_bpe_encoding": op2_bpe_encoding}
