"""Substring dedup: words of 50-word windows that also start in a document of a smaller id.

A window of 50 words is an edge of a de Bruijn graph, from its first 49 words to its last
49. Paths are compacted where they don't branch, before edges are ever made one by one:
a text is cut into stretches of edges with a common anchor (segments.py), and stretches
of equal words are one path with a source, the first place of the smallest id that holds
it. A stretch is named by two hashes that are made of different hashes of its words, so
what a path's source holds at its coordinates is told from anything else by 128 bits
besides the anchor's. Anchors that stand in one document only drop out after a shuffle of hashes. Where
all stretches of an anchor are equal, the path doesn't branch and its source decides for
all its edges. Where they differ, the path branches; its different stretches (once each,
not once a copy) are split into edges, named by 128 bits, and joined with the least source
of each edge. Edges of a stretch whose sources lie side by side in one document are
compacted again; the source's coordinates so verify that the whole span stands there.

Defined cases: null and empty texts have no words; rows of equal id don't remove from each
other; a null id removes nothing and loses nothing; repeats within one
document stay; other columns aren't carried along. A text is handled whole: one of n bytes
takes some 60 n bytes of a worker's memory while it is cut.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm import segments
from tilewright.llm.arrays import slices, spread, text_bytes
from tilewright.llm.common import discard, stored
from tilewright.llm.suffix_dedup import keyed, merged
from tilewright.llm.wordhash import hash_stretches, hash_words, runs

WINDOW = 50
#: Words of the runs that anchors are made of, as a part of the window.
RUN = 0.16
#: What names a stretch.
NAME = ["anchor", "shash", "check"]


def _stretches(texts: DataFrame, window: int) -> DataFrame:
    """(k, anchor, shash, check, at, n): stretches of n edges from word ``at`` on."""
    kind, run = texts.schema["k"].dataType.simpleString(), max(1, round(window * RUN))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(1))
            for i, j in slices(np.diff(off)):
                part = off[i : j + 1]
                h, size = hash_words(data[part[0] : part[-1]], part - part[0])[:2]
                first = np.cumsum(size) - size
                text, at, n, anchor, _ = segments.cut(runs(h, run), first, size, window, run)
                whole = hash_stretches(h, at, at + n + window - 1)
                check = hash_stretches(hash_words(data[part[0] : part[-1]], part - part[0], seed=5)[0], at, at + n + window - 1)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(text + i)), pa.array(anchor.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(check.view(np.int64)), pa.array(at - first[text], pa.int32()), pa.array(n, pa.int32())], ["k", *NAME, "at", "n"])

    return texts.select("k", "text").mapInArrow(rows, f"k {kind}, anchor bigint, shash bigint, check bigint, at int, n int")


def _edges(texts: DataFrame, first: DataFrame, window: int) -> DataFrame:
    """(anchor, shash, check, off, e1, e2, id, pos): each edge of the stretches at places (k, at, n)."""
    wanted = first.groupBy("k").agg(F.collect_list(F.struct("at", "n", *NAME)).alias("w"))
    both = texts.join(wanted, "k").select(F.col("k.id").alias("id"), "text", "w")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(1))
            ends = np.asarray(b.column(2).offsets).astype(np.int64)
            ends = ends - ends[0]
            place, n, anchor, shash, check = (np.asarray(x) for x in b.column(2).flatten().flatten())
            for i, j in slices(np.diff(off), 1 << 20):
                part = off[i : j + 1]
                raw = data[part[0] : part[-1]]
                h, size = hash_words(raw, part - part[0])[:2]
                g = hash_words(raw, part - part[0], seed=5)[0]
                e1, e2 = runs(h, window), runs(g, window)
                w = slice(ends[i], ends[j])
                owner = np.repeat(np.arange(j - i), np.diff(ends[i : j + 1]))
                start = (np.cumsum(size) - size)[owner] + place[w]
                m = n[w].astype(np.int64)
                at, back = spread(start, m), np.repeat(np.arange(len(m)), m)
                off_ = spread(np.zeros(len(m), np.int64), m)
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x[w][back]) for x in (anchor, shash, check)], pa.array(off_, pa.int32()), pa.array(e1[at].view(np.int64)), pa.array(e2[at].view(np.int64)), b.column(0).take(pa.array(owner[back] + i)), pa.array(place[w][back] + off_, pa.int32())],
                    [*NAME, "off", "e1", "e2", "id", "pos"],
                )

    return both.mapInArrow(rows, "anchor bigint, shash bigint, check bigint, off int, e1 bigint, e2 bigint, id bigint, pos int")


def repeated_spans(texts: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """(k, spans): for rows of ``keyed`` that have any, the ranges [lo, hi) of words to remove; ranges may overlap."""
    found = _stretches(texts, window)
    shared = found.groupBy("anchor").agg(F.min("k.id").alias("a"), F.max("k.id").alias("b")).where(F.col("a") < F.col("b")).select("anchor")
    # a null id sorts first, but is no source: its rows would stand in the place of real ones
    places = stored(found.where(F.col("k.id").isNotNull()).join(shared, "anchor"), "places")
    # stored before it is joined, so that an anchor of many paths can be split among tasks
    own = stored(places.groupBy(*NAME).agg(F.min(F.struct("k", "at", "n")).alias("f")), "own")
    per = own.groupBy("anchor").agg(F.count("*").alias("m"))
    paths = stored(own.join(per, "anchor").select(*NAME, "m", "f.k", "f.at", "f.n"), "paths")
    discard(own)
    # copies of a path: the source has it whole
    source = paths.select(*NAME, F.col("k.id").alias("sid"))
    copies = places.join(source, NAME).where(F.col("k.id") > F.col("sid")).select("k", F.col("at").alias("lo"), (F.col("at") + F.col("n") + (window - 1)).alias("hi"))
    # branching paths, edge by edge
    edges = stored(_edges(texts, paths.where(F.col("m") > 1), window), "edges")
    least = edges.groupBy("e1", "e2").agg(F.min(F.struct("id", "pos")).alias("s"), F.max("id").alias("top")).where(F.col("s.id") < F.col("top"))
    sourced = edges.join(least, ["e1", "e2"]).where(F.col("s.id") < F.col("id")).select(*NAME, "id", "off", F.col("s.id").alias("sid"), (F.col("s.pos") - F.col("off")).alias("diagonal"))
    order = Window.partitionBy(*NAME, "sid", "diagonal").orderBy("off")
    islands = sourced.withColumn("island", F.col("off") - F.row_number().over(order)).groupBy(*NAME, "id", "sid", "diagonal", "island").agg(F.min("off").alias("a"), (F.max("off") + 1).alias("b"))
    spans = stored(islands.select(*NAME, "id", "a", "b"), "islands")
    discard(edges)
    partly = places.join(spans, NAME).where(F.col("k.id") == F.col("id")).select("k", (F.col("at") + F.col("a")).alias("lo"), (F.col("at") + F.col("b") + (window - 1)).alias("hi"))
    out = stored(copies.unionByName(partly).groupBy("k").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "spans")
    discard(places, paths, spans)
    return out


def digests(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): what is left of each document's words, joined by one space."""
    texts = keyed(docs, key, text)
    spanned = texts.join(repeated_spans(texts, window=window), "k", "left").select(F.col("k.id").alias("doc_id"), "text", "spans")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(1))
            lists = b.column(2)
            lists = lists.fill_null([]) if lists.null_count else lists
            ends = np.asarray(lists.offsets)
            both = np.stack([np.asarray(x).astype(np.int64) for x in lists.values.flatten()], 1)
            out = []
            for i in range(len(b)):
                words = data[off[i] : off[i + 1]].tobytes().split()
                edges = [0, *merged(both[ends[i] : ends[i + 1]]).ravel().tolist(), len(words)]
                kept = [w for x, y in zip(edges[::2], edges[1::2], strict=True) for w in words[x:y]]
                out.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            n, gone, sha = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return spanned.mapInArrow(rows, "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string")
