"""Suffix-array dedup: bytes covered by a 200-byte string that also starts elsewhere.

Texts are cut into segments of windows with a common anchor (segments.py). Segments whose
anchor stands once, and once in them, can't repeat and drop out, after a shuffle of hashes alone. Equal
segments are collapsed to one string with a weight; strings are then dealt to blocks by
their anchors, and in each block interval expansion on the Burrows-Wheeler transform
(bwt.py) decides, exactly, which windows repeat. A string of weight 2 or more that is the
only one of its anchor repeats whole, and the expansion, which could add nothing, isn't
asked. Where more than ``hot`` different strings share an anchor (a common line within
different surroundings), the different strings, once each, are cut anew by longer runs, up
to whole windows, so that no block is hot. What repeats in the pieces goes back to their
strings, and from the strings, by one join at the end, to the segments' places.

Every step is linear in the input or in what repeats; blocks are of bounded size.

Defined cases: null and empty texts, and texts shorter than the window, lose nothing;
rows with equal id and text are places of their own, so they lose everything that the
window covers; bytes cut from the middle of a character may leave parts of it, which
``cleaned`` drops from the text; other columns pass through, whatever their names. Texts
are handled whole: one of n bytes takes some 60 n bytes of a worker's memory while it is cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm import bwt, segments
from tilewright.llm.arrays import CHUNK, slices, spread, text_bytes
from tilewright.llm.common import discard, fresh, stored
from tilewright.llm.wordhash import byte_runs, hash_spans

WINDOW = 200
#: Lengths of the runs that anchors are made of, in parts of the window: each next one where the last left too many strings together.
LADDER = (0.36, 0.6, 0.85, 1.0)
#: Different strings that may share an anchor in a block, and bytes of a block.
HOT, BLOCK = 4096, 1 << 20

_SEGMENT = "anchor bigint, shash bigint, at int, n int, w int"


def row_key(key: str, text: str) -> Column:
    """What tells a row: its id and a hash of its text, as ids may be repeated."""
    return F.struct(F.col(f"`{key}`").cast("long").alias("id"), F.hash(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("h"))


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, text) of every row; a null text is empty."""
    return docs.select(row_key(key, text).alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def _cut(data: np.ndarray, off: np.ndarray, window: int, run: int) -> tuple[np.ndarray, ...]:
    """Segments of texts in bytes: text, place in it, windows, anchor, the hash of the whole string, and 2 where it may repeat in itself, else 1."""
    text, at, n, anchor, double = segments.cut(byte_runs(data, run), off[:-1], np.diff(off), window, run)
    whole = hash_spans(data, at, at + n + window - 1, seed=2) if len(at) else np.zeros(0, np.uint64)
    return text, at - off[text] if len(at) else at, n, (anchor + np.uint64(run)).view(np.int64), whole.view(np.int64), 1 + double.astype(np.int32)


def _segments(texts: DataFrame, window: int, run: int) -> DataFrame:
    kind = texts.schema["k"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(1))
            for i, j in slices(np.diff(off)):
                part = off[i : j + 1]
                text, at, n, anchor, whole, w = _cut(data[part[0] : part[-1]], part - part[0], window, run)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(text + i)), pa.array(anchor), pa.array(whole), pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(w)], ["k", "anchor", "shash", "at", "n", "w"])

    return texts.select("k", "text").mapInArrow(rows, f"k {kind}, {_SEGMENT}")


def _fetched(texts: DataFrame, first: DataFrame, window: int) -> DataFrame:
    """(anchor, shash, m, copies, s): the strings at places (k, at, n) of rows first."""
    wanted = first.groupBy("k").agg(F.collect_list(F.struct("at", "n", "anchor", "shash", "m", "copies")).alias("w"))
    both = texts.join(wanted, "k").select("text", "w")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(0))
            w = b.column(1)
            place, n, anchor, shash, m, copies = (np.asarray(x) for x in w.flatten().flatten())
            start = np.repeat(off[:-1], np.diff(np.asarray(w.offsets))) + place
            ends = start + n + (window - 1)
            for i, j in slices(n + window):
                s = _pieces(data, start[i:j], ends[i:j])
                yield pa.RecordBatch.from_arrays([pa.array(anchor[i:j]), pa.array(shash[i:j]), pa.array(m[i:j]), pa.array(copies[i:j]), s], ["anchor", "shash", "m", "copies", "s"])

    return both.mapInArrow(rows, "anchor bigint, shash bigint, m bigint, copies bigint, s binary")


def _pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """data[start[i]:end[i]] as binary values."""
    off = np.append(0, np.cumsum(end - start)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data[spread(start, end - start)]))])


def _recut(strings: DataFrame, window: int, run: int) -> DataFrame:
    """Strings cut by longer runs: (anchor, shash, copies) of the string, and (anchor2, shash2, off, n, w, s) of each piece."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(3))
            for i, j in slices(np.diff(off), CHUNK // 4):
                part, of = data[off[i] : off[j]], off[i : j + 1] - off[i]
                text, at, n, anchor, whole, w = _cut(part, of, window, run)
                start, back = of[text] + at, pa.array(text + i)
                yield pa.RecordBatch.from_arrays([*[b.column(c).take(back) for c in range(3)], pa.array(anchor), pa.array(whole), pa.array(at, pa.int32()), pa.array(n, pa.int32()), pa.array(w), _pieces(part, start, start + n + (window - 1))], ["anchor", "shash", "copies", "anchor2", "shash2", "off", "n", "w", "s"])

    return strings.select("anchor", "shash", "copies", "s").mapInArrow(rows, "anchor bigint, shash bigint, copies bigint, anchor2 bigint, shash2 bigint, off int, n int, w int, s binary")


def _repeats(strings: DataFrame, total: int, window: int) -> DataFrame:
    """(anchor, shash, spans): stretches of repeated windows of each string, by the expansion, in blocks of ``total`` bytes."""
    blocks = max(1, -(-total // BLOCK))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("anchor")
        s, copies = group.column("s").combine_chunks(), np.asarray(group.column("copies").combine_chunks())
        # strings of one anchor stay together; a block that chance has made large is worked off in parts
        anchor = np.asarray(group.column("anchor").combine_chunks())
        head = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))
        size = np.add.reduceat(np.asarray(pc.binary_length(s)).astype(np.int64), head)
        head = np.append(head, len(anchor))
        counts, lo, hi = [0], [], []
        for i, j in slices(size, BLOCK):
            a, b = int(head[i]), int(head[j])
            for f in bwt.repeated(s.slice(a, b - a).to_pylist(), copies[a:b], window):
                gap = np.flatnonzero(np.diff(f) != 1)
                lo.append(f[np.append(0, gap + 1)] if len(f) else f)
                hi.append(f[np.append(gap, len(f) - 1)] + 1 if len(f) else f)
                counts.append(counts[-1] + len(lo[-1]))
        flat = [pa.array(np.concatenate(x), pa.int32()) for x in (lo, hi)]
        spans = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), pa.StructArray.from_arrays(flat, ["lo", "hi"]))
        return pa.table({"anchor": group.column("anchor"), "shash": group.column("shash"), "spans": spans})

    dealt = strings.select("anchor", "shash", "copies", "s", F.pmod(F.xxhash64("anchor", F.lit(3)), F.lit(blocks)).alias("block"))
    return dealt.groupBy("block").applyInArrow(run, _HIT).where(F.size("spans") > 0)


_HIT = "anchor bigint, shash bigint, spans array<struct<lo:int,hi:int>>"


def _whole(own: DataFrame) -> DataFrame:
    """Hits of strings (anchor, shash, n) all of whose windows repeat."""
    return own.select("anchor", "shash", F.array(F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi"))).alias("spans"))


def _moved(start: str, more: int = 0) -> Column:
    return F.transform("spans", lambda s: F.struct((F.col(start) + s["lo"]).alias("lo"), (F.col(start) + s["hi"] + more).alias("hi")))


def _sizes(strings: DataFrame, size: Column, runs: list[int], hot: int) -> tuple[int, bool]:
    """Bytes of the strings that go to blocks as they are, with separators, and whether others must be cut anew before."""
    crowded = F.col("m") > hot if runs else F.lit(False)
    total, some = strings.agg(F.sum(F.when(~crowded, size + 1)), F.max(crowded)).first()
    return total or 0, bool(some)


def _hits(strings: DataFrame, total: int, crowded: bool, runs: list[int], window: int, hot: int) -> DataFrame:
    """(anchor, shash, spans) of strings (anchor, shash, m, copies, s), m of which share an anchor, and of their ``_sizes``."""
    ready = stored(_repeats(strings.where(F.col("m") <= hot) if crowded else strings, total, window), "hits")
    if not crowded:
        return ready
    pieces = stored(_recut(strings.where(F.col("m") > hot), window, runs[0]), "pieces")
    own = pieces.groupBy("anchor2", "shash2").agg(F.sum("copies").alias("copies"), F.max("w").alias("w"), F.max("n").alias("n"))
    per = own.groupBy("anchor2").agg(F.count("*").alias("m"), F.sum(F.col("copies") * F.col("w")).alias("c")).where(F.col("c") > 1)
    own = stored(own.join(per, "anchor2").select(F.col("anchor2").alias("anchor"), F.col("shash2").alias("shash"), "m", "copies", "n"), "strings")
    sure = (F.col("m") == 1) & (F.col("copies") > 1)
    body = pieces.select(F.col("anchor2").alias("anchor"), F.col("shash2").alias("shash"), "s").join(own.where(~sure), ["anchor", "shash"])
    finer = stored(body.dropDuplicates(["anchor", "shash"]).select("anchor", "shash", "m", "copies", "s"), "strings")
    found = _hits(finer, *_sizes(finer, F.octet_length("s"), runs[1:], hot), runs[1:], window, hot).unionByName(_whole(own.where(sure)))
    back = pieces.select("anchor", "shash", "anchor2", "shash2", "off").join(found.select(F.col("anchor").alias("anchor2"), F.col("shash").alias("shash2"), "spans"), ["anchor2", "shash2"])
    back = back.select("anchor", "shash", _moved("off").alias("spans")).groupBy("anchor", "shash").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    out = stored(ready.unionByName(back), "hits")
    discard(pieces, own, finer, ready)
    return out


def repeated_spans(texts: DataFrame, *, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """(k, spans): for each row of ``keyed`` that has any, the byte ranges [lo, hi) that repeated windows cover; ranges may overlap."""
    runs = sorted({max(1, min(window, round(window * x))) for x in LADDER})
    found = stored(_segments(texts, window, runs[0]), "segments")
    twice = found.groupBy("anchor").agg(F.sum("w").alias("c")).where(F.col("c") > 1).select("anchor")
    places = stored(found.join(twice, "anchor").select("k", "anchor", "shash", "at", "n"), "places")
    discard(found)
    # stored before it is joined, so that an anchor of many strings can be split among tasks
    own = stored(places.groupBy("anchor", "shash").agg(F.count("*").alias("copies"), F.min(F.struct("k", "at", "n")).alias("f")), "own")
    per = own.groupBy("anchor").agg(F.count("*").alias("m"))
    first = stored(own.join(per, "anchor").select("anchor", "shash", "m", "copies", "f.k", "f.at", "f.n"), "first")
    discard(own)
    sure = (F.col("m") == 1) & (F.col("copies") > 1)
    asked = first.where(~sure)
    total, crowded = _sizes(asked, F.col("n") + (window - 1), runs[1:], hot)
    strings = _fetched(texts, asked, window)
    if crowded:  # read twice: those for the blocks, and those to cut anew
        strings = stored(strings, "strings")
    hits = _hits(strings, total, crowded, runs[1:], window, hot)
    if crowded:
        discard(strings)
    back = places.join(hits.unionByName(_whole(first.where(sure))), ["anchor", "shash"])
    out = stored(back.select("k", _moved("at", window - 1).alias("spans")).groupBy("k").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")
    discard(places, first, hits)
    return out


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted ranges that neither overlap nor touch, of rows (lo, hi)."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    head = np.append(True, spans[1:, 0] > reach[:-1])
    return np.stack([spans[head, 0], reach[np.append(np.flatnonzero(head)[1:] - 1, len(spans) - 1)]], 1)


def kept_bytes(raw: bytes, spans: np.ndarray) -> bytes:
    edges = [0, *spans.ravel().tolist(), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def with_spans(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, hot: int = HOT, into: str = "tw_spans") -> DataFrame:
    """docs with an array of byte ranges, null where nothing repeats."""
    mine, theirs = fresh(docs, "tw_own"), fresh(docs, "tw_k")
    found = repeated_spans(keyed(docs, key, text), window=window, hot=hot).select(F.col("k").alias(theirs), F.col("spans").alias(into))
    return docs.withColumn(mine, row_key(key, text)).join(found, F.col(mine) == F.col(theirs), "left").drop(mine, theirs)


def digests(spanned: DataFrame, *, key: str = "doc_id", text: str = "text", spans: str = "tw_spans") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of rows of with_spans.

    The rows are small beside their texts, so they are gathered: else a file is written for each few texts.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t, cuts in _rows(b, 1, 2):
                kept = kept_bytes(t, cuts)
                out.append((len(t), len(t) - len(kept), len(cuts), hashlib.sha256(kept).hexdigest()))
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in cols[:3]], pa.array(cols[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = spanned.schema[key].dataType.simpleString()
    return spanned.select(F.col(key).alias("doc_id"), text, spans).mapInArrow(rows, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string").hint("rebalance")


def _rows(b: pa.RecordBatch, text: int, spans: int) -> Iterator[tuple[bytes, np.ndarray]]:
    data, off = text_bytes(b.column(text))
    lists = b.column(spans)
    lists = lists.fill_null([]) if lists.null_count else lists
    ends = np.asarray(lists.offsets)
    lo, hi = (np.asarray(x).astype(np.int64) for x in lists.values.flatten())
    both = np.stack([lo, hi], 1)
    for i in range(len(b)):
        yield data[off[i] : off[i + 1]].tobytes(), merged(both[ends[i] : ends[i + 1]])


def cleaned(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """docs with the repeated bytes cut from the text; parts of cut characters go too. Null texts stay null."""
    spans = fresh(docs, "tw_spans")
    spanned = with_spans(docs, key=key, text=text, window=window, hot=hot, into=spans)

    @F.pandas_udf("string")
    def cut(texts, spans):  # noqa: ANN001, ANN202
        import pandas as pd

        out = []
        for t, s in zip(texts, spans, strict=True):
            ranges = None if t is None else merged(np.array([[x["lo"], x["hi"]] for x in s], np.int64).reshape(-1, 2))
            out.append(None if t is None else kept_bytes(t.encode(), ranges).decode("utf-8", "ignore"))
        return pd.Series(out, dtype=object)

    # only the texts that lose something go to Python
    hit = F.col(spans).isNotNull()
    body = F.col(f"`{text}`")
    return spanned.withColumn(text, F.when(hit, cut(F.when(hit, body), F.col(spans))).otherwise(body)).select(*[F.col(f"`{n}`") for n in docs.columns])
