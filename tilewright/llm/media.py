"""Media columns: texts stored as baseline JPEG images, and features of stored images.

The work is done in Arrow batches, in chunks of about 2 MB, so memory is bounded by the
largest single text. Nothing is shuffled.

Defined cases: a null text is empty; an empty payload is padded like any other; a stored
form that can't be read (null, damaged, not baseline) gets null features and a reason in
``error``; repeated rows get equal values; other columns aren't carried along.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import jpeg
from tilewright.llm.arrays import slices, text_bytes

PAD = 192


def padded(raw: bytes) -> bytes:
    n = max(1, -(-len(raw) // PAD)) * PAD
    return raw + b" " * (n - len(raw))


def store_texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, media): each text's UTF-8 bytes, padded with spaces to a multiple of 192, as an image."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(1))
            raw = data.tobytes()
            for i, j in slices(np.diff(off)):
                media = jpeg.write([padded(raw[off[k] : off[k + 1]]) for k in range(i, j)])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(media, pa.binary())], ["key", "media"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"key {kind}, media binary").withColumnRenamed("key", key)


def describe(df: DataFrame, key: str = "doc_id", media: str = "media") -> DataFrame:
    """Rows (key, width, height, images, thumb_hash, samples_bytes, samples_sha256, tail_crc32, media_bytes, media_sha256, error).

    Samples are those of the DC thumbnail; of images that store_texts made, the payload.
    """
    names = ("key", "width", "height", "images", "thumb_hash", "samples_bytes", "samples_sha256", "tail_crc32", "media_bytes", "media_sha256", "error")

    def rows(stored: list[bytes | None]) -> list[tuple]:
        try:
            read = jpeg.read([m for m in stored if m is not None]) if all(m is not None for m in stored) else None
        except (ValueError, IndexError):
            read = None
        out = []
        for k, m in enumerate(stored):
            if m is None:
                out.append((None,) * 9 + ("no image",))
                continue
            own = (len(m), hashlib.sha256(m).hexdigest())
            try:
                images = read[k] if read is not None else jpeg.read([m])[0]
                payload = b"".join(_samples(i) for i in images)
                top = images[0]
                out.append((top.width, sum(i.height for i in images), len(images), jpeg.thumb_hash(top.thumb), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), *own, None))
            except (ValueError, IndexError) as e:
                out.append((None,) * 7 + (*own, str(e)))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stored = b.column(1).to_pylist()
            for i, j in slices(np.array([len(m or b"") for m in stored])):
                cols = list(zip(*rows(stored[i:j]), strict=True))
                kinds = (pa.int64(),) * 3 + (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]], list(names))

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, width bigint, height bigint, images bigint, thumb_hash string, samples_bytes bigint, samples_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, error string"
    return df.select(key, media).mapInArrow(run, schema).withColumnRenamed("key", key)


def _samples(image: jpeg.Image) -> bytes:
    raw = image.thumb.tobytes()
    said = image.comment.split(b"payload=")
    return raw[: int(said[1])] if len(said) == 2 and said[1].isdigit() else raw


def text_sizes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return df.select(key, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
