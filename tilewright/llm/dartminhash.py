"""MinHash near-duplicates with DartMinHash signatures.

Each element of a weighted set owns the region [0, weight) x [0, infinity) of a plane of
darts, thrown by the element's hash alone, one a unit of area. Of a set with total weight
w, the darts at heights up to t/w are looked at, about t of them whatever the set's size;
each dart belongs to one of k coordinates, and a coordinate keeps its lowest dart. Two
sets agree at a coordinate with the probability of their weighted Jaccard similarity.
Where a coordinate got no dart, the height is doubled for that set.

Documents with equal texts are one class from the start (a class is named by its
smallest id). Of the distinct texts, bands of the signature are joined natively; of
buckets that hold the same texts one is enough. Rows of a bucket are compared with one
pivot of the bucket, not with each other, and the exact similarity of their sets of
64-bit shingle hashes decides. Where a bucket then holds several classes, its rows
outside the largest class are compared with all rows of other classes, block by block,
and only links leave a block; so no link between different texts of a bucket is lost and
no group is expanded to pairs. Classes are connected components.

Only texts that share a bucket are looked at again. A bitmap of their hashes (of a fixed
size at most, so it may be broadcast) keeps most others out of the shuffle, and an exact
join the rest; where the bitmap is too small for the corpus it lets more through, and the
join alone decides. A set of shingles is made where its text is and sent once to each
block that needs it.

Defined cases: null and empty texts are equal texts, and similar to no others; a text of
fewer words than a shingle is one shingle of all its words; ties and repeated rows (equal
id and text) are equal texts; other columns pass through, whatever their names. A null id
is an id of its own that sorts first. A text is handled whole: its set takes 8 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.arrays import slices, spread, text_bytes
from tilewright.llm.common import discard, fresh, stored
from tilewright.llm.wordhash import hash_words, mix, runs

SHINGLE, SIMILARITY = 5, 0.8
#: 24 bands of 4: at a similarity of 0.8 a pair meets in no band with a probability of 3e-6.
BANDS, ROWS = 24, 4
#: Rows of a block, and shingles looked at together, where classes of a bucket are compared; rows that are compared with a pivot in one go.
BLOCK, COLUMNS, MEMBERS = 500, 4096, 256
#: Bits of the bitmap of needed texts, at most (16 MB).
BITS = 1 << 27


def shingles(data: np.ndarray, off: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, one text after the other, and how many each has."""
    h, n = hash_words(data, off)[:2]
    rolled = runs(h, width)
    first = np.cumsum(n) - n
    full = n >= width
    count = np.where(full, n - width + 1, 0)
    values = rolled[spread(first[full], count[full])] if full.any() else np.zeros(0, np.uint64)
    owner = np.repeat(np.flatnonzero(full), count[full])
    short = np.flatnonzero((n > 0) & ~full)
    if len(short):  # all words, folded one after the other
        fold = np.full(len(short), 0x51ED270B, np.uint64)
        for k in range(width - 1):
            more = n[short] > k
            fold[more] = mix(fold[more] ^ h[first[short[more]] + k])
        values, owner = np.concatenate([values, fold]), np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.append(True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])) if len(values) else np.zeros(0, bool)
    values, owner = values[new], owner[new]
    return values, np.bincount(owner, minlength=len(n)).astype(np.int64)


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def signatures(elements: np.ndarray, counts: np.ndarray, k: int, weights: np.ndarray | None = None) -> np.ndarray:
    """k coordinates (64-bit names of darts) for each set; sets are laid one after the other. Sets without weight get zeros."""
    sets = len(counts)
    owner = np.repeat(np.arange(sets), counts)
    w = np.ones(len(elements)) if weights is None else np.asarray(weights, float)
    total = np.bincount(owner, w, sets)
    out = np.zeros((sets, k), np.uint64)
    reach = np.zeros(sets)
    live = total > 0
    reach[live] = (k * np.log(k) + 2 * k) / total[live]
    todo = np.flatnonzero(live)
    while len(todo):
        pick = np.zeros(sets, bool)
        pick[todo] = True
        mine = pick[owner] & (w > 0)
        e, o, wt = elements[mine], owner[mine], w[mine]
        # weight regions [0,1), [1,2), [2,4), ...: a process of darts in each, as dense as it is wide
        top = np.maximum(np.ceil(np.log2(np.maximum(wt, 1e-300))), 0).astype(np.int64)
        darts_set, darts_rank, darts_id = [], [], []
        for v in range(int(top.max(initial=0)) + 1):
            has = top >= v
            low, wide = (0.0, 1.0) if v == 0 else (2.0 ** (v - 1), 2.0 ** (v - 1))
            state = mix(e[has] ^ np.uint64((0x9E3779B97F4A7C15 * (v + 1)) & (2**64 - 1)))
            so, sw, height = o[has], wt[has], np.zeros(int(has.sum()))
            while len(state):
                state = mix(state + np.uint64(0xD1B54A32D192ED03))
                height = height - np.log(_uniform(state)) / wide
                ok = height <= reach[so]
                state, so, sw, height = state[ok], so[ok], sw[ok], height[ok]
                name = mix(state ^ np.uint64(0xA0761D6478BD642F))
                inside = low + wide * _uniform(mix(name ^ np.uint64(0xE7037ED1A0B428DB))) < sw
                darts_set.append(so[inside])
                darts_rank.append(height[inside])
                darts_id.append(name[inside])
        ds, dr, di = (np.concatenate(x) for x in (darts_set, darts_rank, darts_id))
        slot = ds * k + (di % np.uint64(k)).astype(np.int64)
        order = np.argsort(-dr, kind="stable")  # the lowest is written last
        won = np.zeros(sets * k, np.uint64)
        won[slot[order]] = di[order]
        won = won.reshape(sets, k)[todo]
        whole = (won != 0).all(1)
        out[todo[whole]] = won[whole]
        todo = todo[~whole]
        reach[todo] *= 2
    return out


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit name for each band of each signature."""
    out = np.zeros((sig.shape[0], sig.shape[1] // rows), np.uint64)
    for b in range(out.shape[1]):
        h = np.full(len(sig), b + 1, np.uint64)
        for r in range(rows):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) ^ sig[:, b * rows + r])
        out[:, b] = h
    return out


def _banded(texts: DataFrame, n_bands: int, rows: int, width: int) -> DataFrame:
    """(k, text) -> (k, bands array); no bands where a text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(1))
            for i, j in slices(np.diff(off)):
                part = off[i : j + 1]
                values, n = shingles(data[part[0] : part[-1]], part - part[0], width)
                named = bands(signatures(values, n, n_bands * rows), rows).view(np.int64)
                at = np.append(0, np.cumsum(np.where(n > 0, n_bands, 0)))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(named[n > 0].ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), lists], ["k", "bands"])

    return texts.select("k", "text").mapInArrow(run, f"k {texts.schema['k'].dataType.simpleString()}, bands array<bigint>")


def needed_texts(texts: DataFrame, needed: DataFrame) -> DataFrame:
    """Rows (k, text) of texts, once each, whose k is in needed (rows k, distinct, stored)."""
    size = BITS
    while size > 1 << 15 and size > 32 * needed.count():
        size >>= 1
    place = F.pmod(F.xxhash64("k", F.lit(5)), F.lit(size)) + 1
    bits = needed.groupBy(F.bitmap_bucket_number(place).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    likely = texts.select("k", "text", F.bitmap_bucket_number(place).alias("page"), F.bitmap_bit_position(place).cast("int").alias("at")).join(F.broadcast(bits), "page")
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    likely = likely.where(F.pmod(F.floor(byte / F.pow(F.lit(2), F.col("at") % 8)), F.lit(2)) == 1)
    # an inner join, as the optimizer would put a semi-join before the bitmap
    return likely.select("k", "text").join(needed, "k").dropDuplicates(["k"])


def _sent(held: DataFrame, asked: DataFrame, width: int) -> DataFrame:
    """(k, to, s) for each row (k, to) of asked: s is the sorted 64-bit shingle hashes of k's text, as bytes."""
    wanted = asked.groupBy("k").agg(F.collect_list("to").alias("to"))
    both = held.join(wanted, "k").select("k", "to", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(2))
            many = np.asarray(pc.list_value_length(b.column(1))).astype(np.int64)
            for i, j in slices(np.diff(off) * (1 + many)):
                part = off[i : j + 1]
                values, n = shingles(data[part[0] : part[-1]], part - part[0], width)
                ends = np.cumsum(n) * 8
                times = many[i:j]
                sizes, starts = np.repeat(n * 8, times), np.repeat(ends - n * 8, times)
                raw = values.astype("<u8").view(np.uint8)[spread(starts, sizes)] if len(values) else np.zeros(0, np.uint8)
                s = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.repeat(np.arange(i, j), times))), b.column(1).slice(i, j - i).flatten(), s], ["k", "to", "s"])

    kind = lambda c: both.schema[c].dataType
    return both.mapInArrow(run, f"k {kind('k').simpleString()}, to {kind('to').elementType.simpleString()}, s binary")


def _alike(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Whether two sets of sorted values are similar enough."""
    if not len(x) or not len(y) or min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    at = np.searchsorted(x, y)
    at[at == len(x)] = 0
    common = int((x[at] == y).sum())
    return common >= least * (len(x) + len(y) - common)


def _compared(pairs: DataFrame, held: DataFrame, least: float, width: int) -> DataFrame:
    """Pairs (a, b) of a pivot and a member whose exact similarity is at least ``least``.

    A pivot's members are dealt out by hash, and the pivot is sent to each part; there it
    comes first, so a task holds one pivot and a batch of members.
    """
    # stored before it is joined, so that a pivot of many members can be split among tasks
    parts = stored(pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(MEMBERS)).cast("int").alias("parts")), "parts")
    dealt = pairs.join(parts, "a").select("a", F.col("b").alias("k"), F.pmod(F.xxhash64("b", F.lit(7)), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"))
    pivots = parts.select("a", F.col("a").alias("k"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"))
    asked = dealt.unionByName(pivots).select("k", F.struct("a", "part", "role").alias("to"))
    sets = _sent(held, asked, width).select("to.a", "to.part", "to.role", "k", "s").repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.zeros(0, np.uint64)
        for b in batches:
            role, good = b.column(2).to_pylist(), []
            for r, s in zip(role, b.column(4), strict=True):
                y = np.frombuffer(s.as_buffer() or b"", "<u8")
                if r == 0:
                    x = y.copy()
                good.append(r == 1 and _alike(x, y, least))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(3).filter(keep)], ["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    out = stored(sets.mapInArrow(run, f"a {kind}, b {kind}"), "edges")
    discard(parts)
    return out


def _across(members: DataFrame, label: DataFrame, held: DataFrame, least: float, width: int) -> DataFrame:
    """Links (a, b) between different classes of a bucket.

    Of each bucket with several classes, rows outside its largest class are compared with
    all rows of other classes: blocks of rows against blocks of rows, by products of 0/1
    matrices of shared shingles. Only links leave a block, and no task holds more than
    one block of either side. Rows of the largest class are linked already.
    """
    at = members.select("bucket", "k").join(label, "k", "left").select("bucket", "k", F.coalesce("c", "k").alias("c"))
    kind = members.schema["k"].dataType.simpleString()
    sizes = at.groupBy("bucket", "c").agg(F.count("*").alias("n"))
    # a bucket of two rows has been compared whole
    several = sizes.groupBy("bucket").agg(F.max_by("c", F.struct("n", "c")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("most")).where((F.col("n") > F.col("most")) & (F.col("n") > 2))
    several = several.select("bucket", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("right"), F.ceil((F.col("n") - F.col("most")) / BLOCK).cast("int").alias("left"))
    rows = stored(at.join(several, "bucket"), "open")
    place = lambda n: F.pmod(F.xxhash64("k", F.lit(7)), F.col(n)).cast("int")
    asks = rows.where(F.col("c") != F.col("main")).select("bucket", "k", "c", place("left").alias("i"), F.explode(F.sequence(F.lit(0), F.col("right") - 1)).alias("j"), F.lit(True).alias("asks"))
    told = rows.select("bucket", "k", "c", F.explode(F.sequence(F.lit(0), F.col("left") - 1)).alias("i"), place("right").alias("j"), F.lit(False).alias("asks"))
    both = _sent(held, asks.unionByName(told).select("k", F.struct("bucket", "i", "j", "c", "asks").alias("to")), width).select("to.bucket", "to.i", "to.j", "k", "to.c", "to.asks", "s")

    def run(group: pa.Table) -> pa.Table:
        asks = np.asarray(group.column("asks").combine_chunks())
        names, c = group.column("k").combine_chunks(), group.column("c").combine_chunks()
        cls = np.unique(np.stack([np.asarray(pc.struct_field(c, f)) for f in ("h1", "h2")], 1), axis=0, return_inverse=True)[1].ravel()
        raw, off = text_bytes(group.column("s"))
        values, n = np.frombuffer(raw.tobytes(), "<u8"), np.diff(off) // 8
        term, count = np.unique(values, return_inverse=True, return_counts=True)[1:]
        col = np.where(count > 1, np.cumsum(count > 1) - 1, -1)[term]
        row = np.repeat(np.arange(len(n)), n)
        row, col = row[col >= 0], col[col >= 0]
        order = np.argsort(col, kind="stable")
        row, col = row[order], col[order]
        left, right = np.flatnonzero(asks), np.flatnonzero(~asks)
        common = np.zeros((len(left), len(right)), np.float32)
        for lo in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMNS):
            x, y = np.searchsorted(col, (lo, lo + COLUMNS))
            m = np.zeros((len(n), min(COLUMNS, int(col[-1]) + 1 - lo)), np.float32)
            m[row[x:y], col[x:y] - lo] = 1
            common += m[left] @ m[right].T
        ok = common >= least * (n[left][:, None] + n[right][None, :] - common)
        ok &= (cls[left][:, None] != cls[right][None, :]) & (n[left] > 0)[:, None]
        i, j = np.nonzero(ok)
        return pa.table({"a": names.take(pa.array(left[i])), "b": names.take(pa.array(right[j]))})

    out = stored(both.groupBy("bucket", "i", "j").applyInArrow(run, f"a {kind}, b {kind}").distinct(), "edges")
    discard(rows)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (k, c): for each end of an edge the least of its component, by neighbours' minima and pointer jumps."""
    both = stored(edges.select(F.col("a").alias("k"), F.col("b").alias("n")).unionByName(edges.select(F.col("b").alias("k"), F.col("a").alias("n"))).distinct(), "links")
    label = stored(both.groupBy("k").agg(F.least(F.col("k"), F.min("n")).alias("c")), "labels")
    while True:
        near = both.join(label.select(F.col("k").alias("n"), F.col("c").alias("cn")), "n").groupBy("k").agg(F.min("cn").alias("cn"))
        step = label.join(near, "k", "left").select("k", F.col("c").alias("was"), F.least("c", F.coalesce("cn", "c")).alias("c"))
        jump = label.select(F.col("k").alias("c"), F.col("c").alias("cc"))
        new = stored(step.join(jump, "c", "left").select("k", "was", F.least(F.col("c"), F.coalesce(F.col("cc"), F.col("c"))).alias("c")), "labels")
        moved = new.where(F.col("c") != F.col("was")).limit(1).count()
        discard(label)
        label = new.select("k", "c")
        if not moved:
            discard(both)
            return label


def _named(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(k, text): a text is known by its smallest id and by two hashes of it; ids come first, so minima are of ids."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.struct(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(body).alias("h1"), F.xxhash64(F.lit(1), body).alias("h2")).alias("k"), body.alias("text"))


def classes(docs: DataFrame, *, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY, n_bands: int = BANDS, rows: int = ROWS, width: int = SHINGLE) -> DataFrame:
    """(doc_id, h1, h2, class_id): h1 and h2 are hashes of the text, class_id the smallest id of the class."""
    named = _named(docs, key, text)
    seen = stored(_banded(named, n_bands, rows, width), "bands")
    own = stored(seen.groupBy(F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2")).agg(F.min("k").alias("k"), F.first("bands").alias("bands")), "own")
    # one hash is enough to find candidates: two texts that share it would be compared, no more
    spots = own.select("h1", F.explode("bands").alias("bucket"))
    shared = spots.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("bucket")
    found = stored(spots.join(shared, "bucket").distinct().join(own.select("h1", "k"), "h1").select("bucket", "k"), "buckets")
    # buckets of the same rows (bands that all agree): one of each
    same = found.groupBy("bucket").agg(F.count("*").alias("n"), F.min("k").alias("pivot"), *[F.bit_xor(F.xxhash64("k", F.lit(i))).alias(f"x{i}") for i in (1, 2)]).where(F.col("n") > 1)
    once = same.groupBy("n", "x1", "x2").agg(F.min(F.struct("bucket", "pivot")).alias("b")).select("b.bucket", "b.pivot")
    members = stored(found.join(once, "bucket"), "members")
    pairs = stored(members.where(F.col("k") != F.col("pivot")).select(F.col("pivot").alias("a"), F.col("k").alias("b")).distinct(), "pairs")
    needed = stored(pairs.select(F.col("a").alias("k")).unionByName(pairs.select(F.col("b").alias("k"))).distinct(), "needed")
    held = stored(needed_texts(named, needed), "held")
    edges = _compared(pairs, held, similarity, width)
    label = components(edges)
    more = _across(members, label, held, similarity, width)
    if more.limit(1).count():
        discard(label)
        label = components(edges.unionByName(more))
    name = own.select("h1", "h2", F.col("k").alias("own")).join(label.select(F.col("k").alias("own"), "c"), "own", "left").select("h1", "h2", F.coalesce("c", "own")["id"].alias("class_id"))
    out = stored(seen.select(F.col("k.id").alias("doc_id"), F.col("k.h1").alias("h1"), F.col("k.h2").alias("h2")).join(name, ["h1", "h2"]).select("doc_id", "h1", "h2", "class_id"), "classes")
    discard(seen, own, found, members, pairs, needed, held, edges, more, label)
    return out


def keep_first(docs: DataFrame, **options) -> DataFrame:
    """One row of each class: that of the smallest id. Columns stay as they are."""
    key, text = (options.get(n, d) for n, d in (("key", "doc_id"), ("text", "text")))
    stays = classes(docs, **options).where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    # of rows with the smallest id (an id may be repeated), those with the least text hashes
    stays = stays.groupBy("class_id").agg(F.min(F.struct("h1", "h2")).alias("h"))
    names = [fresh(docs, f"tw_{i}") for i in range(5)]
    row = lambda i, h1, h2: [c.alias(n) for c, n in zip((i.isNull(), F.coalesce(i, F.lit(0).cast("long")), h1, h2), names, strict=False)]
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marked = docs.select("*", *row(F.col(f"`{key}`").cast("long"), F.xxhash64(body), F.xxhash64(F.lit(1), body)))
    joined = marked.join(stays.select(*row(F.col("class_id"), F.col("h.h1"), F.col("h.h2"))), names[:4])
    once = joined.withColumn(names[4], F.row_number().over(Window.partitionBy(*names[:4]).orderBy(F.lit(1))))
    return once.where(F.col(names[4]) == 1).select(*[F.col(f"`{n}`") for n in docs.columns])
