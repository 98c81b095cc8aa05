"""LM scoring: a hashed maximum-entropy model with class-factored softmax.

p(word | history) = p(c1 | h) * p(c2 | c1, h) * p(c3 | c1, c2, h) * p(word | c1 c2 c3). A word's
three classes are digits of its leaf: each frequent word has a leaf of its own, so all of
its probability depends on the history; the others share leaves by their first letters,
and a leaf's words have the smoothed shares of their counts. Each of the three factors is
a softmax over hashed features of the history, together with the classes chosen so far:
the last word, the last two, and two skips. Rare words stand in features by their first letters.
With no weights the model is the unigram model, as the classes' own shares are its bias.

Weights are trained by distributed updates over all training tokens: tasks add up, for each
bucket and class, how often the class came and how often the model expected it, in whole
numbers (so sums are the same however the tokens are dealt out); a bucket's weights move by
the logarithm of the one over the other, its gradient in the scale of the weights. Buckets
grow with the square root of the training tokens, classes with the sixth root of the words
(and the words that have a leaf of their own with the square root): at 10^13 tokens and
10^9 words, weights take 1.6 GB. They are what is broadcast; their size is known beforehand.

Texts are tokenized once into blocks of about 16 MB: token numbers, and the block's distinct
words, by 64-bit hashes, with their counts. Counts are summed over all blocks, and each block gets the counts
of those of its words back that other blocks have too; no table of all words is ever
gathered. A block's words stand once in it, so even the most frequent word is a row a block.

Defined cases: a null or empty text is one end token; repeated rows are scored alike and
counted each; with nothing to learn from, all counts are 0 and the classes even. A text is
handled whole: one of n bytes takes some 40 n bytes of a worker's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.arrays import slices, text_bytes
from tilewright.llm.common import discard, stored
from tilewright.llm.wordhash import hash_spans, hash_words, mix

LEVELS, FEATURES = 3, 4
BLOCK = 16 << 20
#: Tokens of a block that are opened at once, those whose softmax is computed at once, and what a whole is in the sums of expectations.
SLICE, BATCH, WHOLE = 1 << 19, 16384, 1 << 16
#: How far a bucket's weights move towards what was seen, and how many tokens of the model's own expectation are added to both.
RATE, DAMP = 0.6, 4.0
#: Ranges of buckets that sums are added up in.
RANGES = 64
#: What stands for the end token among hashes of words.
_END = np.uint64(0)


def blocks(docs: DataFrame, held: Column, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a block: ids and sizes of its documents, its tokens as numbers of its words, and its words."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size, made = 0, TaskContext.get().partitionId() << 32
        for b in batches:
            off = text_bytes(b.column(2))[1]
            for i, j in slices(np.diff(off), BLOCK):
                n = int(off[j] - off[i])
                if waiting and size + n > BLOCK:
                    yield _block(pa.Table.from_batches(waiting), made)
                    waiting, size, made = [], 0, made + 1
                waiting.append(b.slice(i, j - i))
                size += n
        if waiting:
            yield _block(pa.Table.from_batches(waiting), made)

    schema = "bid bigint, ids array<bigint>, held array<boolean>, sizes array<int>, tokens binary, words array<bigint>, tf array<int>, shape array<int>"
    return docs.select(F.col(f"`{key}`").cast("long").alias("id"), held.alias("held"), F.col(f"`{text}`").alias("text")).mapInArrow(rows, schema)


def _one(values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _block(t: pa.Table, bid: int) -> pa.RecordBatch:
    held = np.asarray(t.column(1).combine_chunks().fill_null(False))
    data, off = text_bytes(t.column(2))
    # distinct words slice by slice and then of all slices, so no array of 64-bit hashes of all words is sorted
    distinct, codes, counts, letters, base = [], [], [], [], 0
    for i, j in slices(np.diff(off)):
        part = data[off[i] : off[j]]
        part = np.where((part >= 65) & (part <= 90), part + 32, part).astype(np.uint8)
        h, n, starts, ends = hash_words(part, off[i : j + 1] - off[i])
        u, at, code = np.unique(np.maximum(h, 1), return_index=True, return_inverse=True)
        distinct.append(u)
        codes.append((code + base).astype(np.int32))
        counts.append(n)
        letters.append((hash_spans(part, starts[at], np.minimum(ends[at], starts[at] + 3), seed=9) >> np.uint64(34)).astype(np.int32))
        base += len(u)
    u, codes, n, letters = (np.concatenate(x) if x else np.zeros(0, k) for x, k in ((distinct, np.uint64), (codes, np.int32), (counts, np.int64), (letters, np.int32)))
    unique, first, back = np.unique(u, return_index=True, return_inverse=True)
    code = back.astype(np.int32)[codes]
    often = np.bincount(code, minlength=len(unique))
    # words are numbered by how often the block has them, which packs well; the end token comes before all
    order = np.argsort(-often, kind="stable")
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order), dtype=np.int32)
    sizes = n + 1
    at = np.cumsum(sizes)
    tokens = np.zeros(int(at[-1]) if len(at) else 0, np.int32)
    inside = np.ones(len(tokens), bool)
    inside[at - 1] = False
    tokens[inside] = number[code] + 1
    learn = np.repeat(~held, sizes)
    tf = np.bincount(tokens[learn], minlength=len(unique) + 1)
    words, shape = np.append(_END, unique[order]).view(np.int64), np.append(np.int32(0), letters[first[order]])
    return pa.RecordBatch.from_arrays(
        [pa.array([bid], pa.int64()), _one(t.column(0).combine_chunks(), pa.int64()), _one(held, pa.bool_()), _one(sizes, pa.int32()), pa.array([_packed(tokens)], pa.binary()), _one(words, pa.int64()), _one(tf, pa.int32()), _one(shape, pa.int32())],
        ["bid", "ids", "held", "sizes", "tokens", "words", "tf", "shape"],
    )


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, their bytes plane by plane, compressed."""
    planes = [np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes() for x in arrays]
    return pa.compress(b"".join(planes), "zstd", asbytes=True)


def _unpacked(raw: bytes, n: int, *kinds: str) -> list[np.ndarray]:
    """The arrays of n numbers each that ``_packed`` took."""
    sizes = [n * np.dtype(k).itemsize for k in kinds]
    data = pa.decompress(raw, decompressed_size=sum(sizes), codec="zstd", asbytes=True)
    at = np.cumsum([0, *sizes])
    return [np.ascontiguousarray(np.frombuffer(data, np.uint8, size, start).reshape(-1, n).T).view(k).ravel() for k, size, start in zip(kinds, sizes, at.tolist(), strict=False)]


class Model:
    """What all tasks share: the sizes, the leaves' counts, and the weights."""

    def __init__(self, tokens: int, types: int) -> None:
        self.tokens, self.types = tokens, types
        self.branch = 16
        while self.branch**6 < types:
            self.branch *= 2
        self.bits = 10
        while 1 << 2 * self.bits < tokens:
            self.bits += 1
        self.leaves = self.branch**LEVELS
        self.own = self.leaves // 4  # leaves of a single word
        self.total, self.distinct = np.zeros(self.leaves), np.zeros(self.leaves)
        self.weights: np.ndarray | None = None  # level, bucket, class

    def leaf_of(self, rank: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leaf of each word, and what it stands as in features. rank: among the frequent words, the end token's is 0; below 0 for others."""
        first = mix(shape.astype(np.uint64))
        leaf = np.where(rank >= 0, rank, self.own + (first % np.uint64(self.leaves - self.own)).astype(np.int64))
        symbol = np.where(rank >= 0, mix(rank.astype(np.uint64) + np.uint64(1 << 41)), mix(shape.astype(np.uint64) + np.uint64(1 << 40)))
        return leaf.astype(np.int32), (symbol >> np.uint64(33)).astype(np.int32)

    def bias(self) -> list[np.ndarray]:
        """For each level and the classes before it, the logarithms of the classes' shares of the training tokens."""
        out = []
        for level in range(LEVELS):
            n = self.total.reshape(self.branch**level, self.branch, -1).sum(2) + 0.5
            out.append(np.log(n / n.sum(1, keepdims=True)).astype(np.float32))
        return out

    def inside(self, count: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        """log10 share of a word in its leaf."""
        return np.log10((count + 0.5) / (self.total[leaf] + 0.5 * (self.distinct[leaf] + 1)))

    def classes(self, leaf: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The classes before a level as one number, and the class at it."""
        upto = leaf // self.branch ** (LEVELS - 1 - level)
        return upto // self.branch, upto % self.branch

    def buckets(self, feature: np.ndarray, kind: int, prefix: np.ndarray, level: int) -> np.ndarray:
        seed = np.uint64((0xD6E8FEB86659FD93 * (1 + kind + FEATURES * level)) & (2**64 - 1))
        h = (feature ^ (prefix.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + seed)) * np.uint64(0x9E3779B97F4A7C15)
        return (h >> np.uint64(64 - self.bits)).astype(np.uint16 if self.bits <= 16 else np.int64)


def features(symbol: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Of each token: the last word, the last two, the one before the last, and the one before that, as hashes."""
    start = np.cumsum(sizes) - sizes

    def before(k: int) -> np.ndarray:
        out = np.zeros(len(symbol), np.uint64)
        out[k:] = symbol[:-k] if len(symbol) > k else 0
        for d in range(k):
            out[start[sizes > d] + d] = 0
        return out

    one, two = before(1), before(2)
    return [mix(one + np.uint64(11)), mix(mix(one + np.uint64(23)) + two), mix(two + np.uint64(37 << 32)), mix(before(3) + np.uint64(53 << 32))]


def _logits(m: Model, bias: list[np.ndarray], level: int, prefix: np.ndarray, at: list[np.ndarray]) -> np.ndarray:
    z = bias[level].take(prefix, axis=0)
    if m.weights is not None:
        for rows in at:
            z += m.weights[level].take(rows, axis=0)
    z -= z.max(1, keepdims=True)
    return z


def log_scores(m: Model, leaf: np.ndarray, feats: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each token's leaf."""
    bias, out = m.bias(), np.zeros(len(leaf))
    for a in range(0, len(leaf), BATCH):
        y, fs = leaf[a : a + BATCH], [f[a : a + BATCH] for f in feats]
        for level in range(LEVELS):
            prefix, c = m.classes(y, level)
            z = _logits(m, bias, level, prefix, [m.buckets(f, k, prefix, level) for k, f in enumerate(fs)])
            out[a : a + BATCH] += z[np.arange(len(y)), c] - np.log(np.exp(z).sum(1))
    return out / np.log(10)


class Sums:
    """How often each class came, and how often it was expected, by level and bucket; expectations in parts of WHOLE."""

    def __init__(self, m: Model) -> None:
        self.model, self.bias = m, m.bias()
        self.seen, self.due = (np.zeros((LEVELS, 1 << m.bits, m.branch), np.int64) for _ in range(2))

    def add(self, leaf: np.ndarray, feats: list[np.ndarray]) -> None:
        m = self.model
        for level in range(LEVELS):
            prefix, c = m.classes(leaf, level)
            for k, f in enumerate(feats):
                at = m.buckets(f, k, prefix, level).astype(np.int64)
                self.seen[level] += np.bincount(at * m.branch + c, minlength=m.branch << m.bits).reshape(-1, m.branch)
                if m.weights is None:
                    self._by_prefix(level, at, prefix)
        if m.weights is not None:
            self._by_token(leaf, feats)

    def _by_prefix(self, level: int, at: np.ndarray, prefix: np.ndarray) -> None:
        """Without weights, what is expected of a token depends on the classes before it alone, so they are counted."""
        share = np.exp(self.bias[level].astype(float))
        share *= WHOLE / share.sum(1, keepdims=True)
        step, rows = max(1, (1 << 20) // len(share)), len(self.due[level])
        for lo in range(0, rows, step):
            some = slice(None) if step >= rows else (at >= lo) & (at < lo + step)
            n = min(step, rows - lo)
            joint = np.bincount((at[some] - lo) * len(share) + prefix[some], minlength=n * len(share)).reshape(n, len(share))
            self.due[level, lo : lo + n] += np.rint(joint @ share).astype(np.int64)

    def _by_token(self, leaf: np.ndarray, feats: list[np.ndarray]) -> None:
        m = self.model
        for a in range(0, len(leaf), BATCH):
            y, fs = leaf[a : a + BATCH], [f[a : a + BATCH] for f in feats]
            for level in range(LEVELS):
                prefix, _ = m.classes(y, level)
                at = [m.buckets(f, k, prefix, level) for k, f in enumerate(fs)]
                p = np.exp(_logits(m, self.bias, level, prefix, at))
                p *= WHOLE / p.sum(1, keepdims=True)
                p = np.rint(p).astype(np.int64)
                for rows in at:
                    order = np.argsort(rows, kind="stable")
                    ranked = rows[order]
                    head = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
                    self.due[level, ranked[head]] += np.add.reduceat(p.take(order, axis=0), head, axis=0)


def moved(seen: np.ndarray, due: np.ndarray, rate: float = RATE, damp: float = DAMP) -> np.ndarray:
    """By how much weights move: towards what was seen, the less the fewer tokens a bucket has."""
    due = due / WHOLE
    share = due / np.maximum(due.sum(-1, keepdims=True), 1e-9)
    return (rate * np.log((seen + damp * share + 1e-9) / (due + damp * share + 1e-9))).astype(np.float32)


class Block:
    """A row of ``counted_blocks``."""

    def __init__(self, b: pa.RecordBatch, i: int) -> None:
        get = lambda name: b.column(b.schema.get_field_index(name))[i]
        self.ids = get("ids").values
        self.held = np.asarray(get("held").values.fill_null(False))
        self.sizes = get("sizes").values.to_numpy().astype(np.int64)
        self.tokens = _unpacked(get("tokens").as_py(), int(self.sizes.sum()), "<i4")[0]
        self.count, self.leaf, self.symbol = _unpacked(get("lexicon").as_py(), get("types").as_py(), "<i8", "<i4", "<i4")

    def slices(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray, list[np.ndarray]]]:
        """Runs of documents: which they are, their tokens, the tokens' leaves and features."""
        ends = np.append(0, np.cumsum(self.sizes))
        for i, j in slices(self.sizes, SLICE):
            t = self.tokens[ends[i] : ends[j]]
            yield slice(i, j), t, self.leaf[t], features(self.symbol.astype(np.uint64)[t], self.sizes[i:j])


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for b in batches:
        for i in range(len(b)):
            yield Block(b, i)


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bid, n, hc): places, counts and ranks of a block's words, from rows sorted by block."""

    def row(bid: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts)
        packed = _packed(*(np.ascontiguousarray(t.column(k).to_numpy(), kind) for k, kind in ((1, "<i4"), (2, "<i8"), (3, "<i4"))))
        return pa.RecordBatch.from_arrays([pa.array([bid], pa.int64()), pa.array([len(t)], pa.int32()), pa.array([packed], pa.binary())], ["bid", "n", "hc"])

    last, parts = 0, []
    for b in batches:
        bid = np.asarray(b.column(0))
        edges = np.flatnonzero(np.append(True, bid[1:] != bid[:-1])).tolist()
        for i, j in zip(edges, [*edges[1:], len(bid)], strict=True):
            if parts and bid[i] != last:
                yield row(last, parts)
                parts = []
            last = int(bid[i])
            parts.append(b.slice(i, j - i))
    if parts:
        yield row(last, parts)


def counted_blocks(made: DataFrame) -> tuple[DataFrame, Model]:
    """Blocks with the training counts, leaves and symbols of their words, and the model without weights. made must be stored."""
    pairs = made.select("bid", F.posexplode(F.arrays_zip("words", "tf", "shape")).alias("pos", "z"))
    total = stored(pairs.groupBy("z.words").agg(F.sum("z.tf").alias("c"), F.first("z.shape").alias("shape"), F.count("*").alias("blocks")), "counts")
    whole = total.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    model = Model(int(whole["n"]), int(whole["v"]))
    top = total.where((F.col("words") != int(_END)) & (F.col("c") > 0)).orderBy(F.col("c").desc(), "words").limit(model.own - 1).select("words")
    # at most model.own rows
    ranked = made.sparkSession.createDataFrame([(int(_END), 0), *((r["words"], i) for i, r in enumerate(top.collect(), 1))], "words bigint, rank int")
    total_ranked = total.join(F.broadcast(ranked), "words", "left").withColumn("rank", F.coalesce("rank", F.lit(-1)))
    shared = made.sparkSession.sparkContext.broadcast(model)

    def by_leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        n, v = np.zeros(m.leaves, np.int64), np.zeros(m.leaves, np.int64)
        for b in batches:
            leaf, _ = m.leaf_of(np.asarray(b.column(0)), np.asarray(b.column(2)))
            n += np.bincount(leaf, np.asarray(b.column(1)), m.leaves).astype(np.int64)
            v += np.bincount(leaf, np.asarray(b.column(1)) > 0, m.leaves).astype(np.int64)
        some = np.flatnonzero(v)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some]), pa.array(v[some])], ["leaf", "n", "v"])

    per = total_ranked.select("rank", "c", "shape").mapInArrow(by_leaf, "leaf int, n bigint, v bigint").groupBy("leaf").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    for r in per.collect():
        model.total[r["leaf"]], model.distinct[r["leaf"]] = r["n"], r["v"]
    # words of one block alone have its own counts already
    wide = total_ranked.where((F.col("c") > 0) & (F.col("blocks") > 1) | (F.col("rank") >= 0)).select("words", "c", "rank")
    # sorted by block and packed row by row: a list of so many structs would be a large object of the JVM
    back = pairs.select("bid", "pos", "z.words").join(wide, "words").select("bid", "pos", "c", "rank").repartition("bid").sortWithinPartitions("bid").mapInArrow(_gathered, "bid bigint, n int, hc binary")

    def ready(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for i in range(len(b)):
                tf, shape = (b.column(k)[i].values.to_numpy() for k in (4, 5))
                count, ranks, n = tf.astype(np.int64), np.full(len(tf), -1, np.int64), b.column(6)[i].as_py()
                if n:
                    pos, c, rank = _unpacked(b.column(7)[i].as_py(), n, "<i4", "<i8", "<i4")
                    count[pos], ranks[pos] = c, rank
                leaf, symbol = m.leaf_of(ranks, shape)
                yield pa.RecordBatch.from_arrays([*[b.column(k).slice(i, 1) for k in range(4)], pa.array([len(tf)], pa.int32()), pa.array([_packed(count, leaf, symbol)], pa.binary())], ["ids", "held", "sizes", "tokens", "types", "lexicon"])

    both = made.join(back, "bid", "left").select("ids", "held", "sizes", "tokens", "tf", "shape", "n", "hc")
    kept = stored(both.mapInArrow(ready, "ids array<bigint>, held array<boolean>, sizes array<int>, tokens binary, types int, lexicon binary"), "blocks")
    discard(total)
    return kept, model


def train(counted: DataFrame, model: Model, *, epochs: int = 1, rate: float = RATE, damp: float = DAMP) -> Model:
    """The model with weights, from as many updates."""
    sc = counted.sparkSession.sparkContext
    per = -(-(1 << model.bits) // RANGES)
    for _ in range(epochs):
        shared = sc.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = Sums(shared.value)  # noqa: B023
            for block in _walked(batches):
                for docs, _, leaf, feats in block.slices():
                    learn = np.repeat(~block.held[docs], block.sizes[docs])
                    sums.add(leaf[learn], [f[learn] for f in feats])
            for r in range(RANGES):
                raw = [np.ascontiguousarray(x[:, r * per : (r + 1) * per]).tobytes() for x in (sums.seen, sums.due)]  # noqa: B023
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), *[pa.array([pa.compress(x, "zstd", asbytes=True)], pa.binary()) for x in raw]], ["part", "seen", "due"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m, sums = shared.value, {}  # noqa: B023
            for b in batches:
                for i in range(len(b)):
                    r = b.column(0)[i].as_py()
                    n = max(0, min(per, (1 << m.bits) - r * per))  # noqa: B023
                    both = sums.setdefault(r, np.zeros((2, LEVELS, n, m.branch), np.int64))
                    for k in (0, 1):
                        both[k] += np.frombuffer(pa.decompress(b.column(1 + k)[i].as_py(), decompressed_size=both[k].nbytes, codec="zstd", asbytes=True), np.int64).reshape(both[k].shape)
            for r, (seen, due) in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([moved(seen, due, rate, damp).tobytes()], pa.binary())], ["part", "move"])

        # as few tasks as keep all cores busy: what each has added up is as large as the model
        told = counted.coalesce(max(1, 2 * sc.defaultParallelism)).mapInArrow(run, "part int, seen binary, due binary")
        new = np.zeros((LEVELS, 1 << model.bits, model.branch), np.float32) if model.weights is None else model.weights.copy()
        for r in told.repartition("part").mapInArrow(add, "part int, move binary").collect():
            part = new[:, r["part"] * per : (r["part"] + 1) * per]
            part += np.frombuffer(r["move"], np.float32).reshape(part.shape)
        model.weights = new
    return model


def scored(counted: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)."""
    shared = counted.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for block in _walked(batches):
            known, base = block.count > 0, np.log10((block.count + 0.5) / (m.tokens + 0.5 * (m.types + 1)))
            inside = m.inside(block.count, block.leaf)
            for docs, t, leaf, feats in block.slices():
                sizes = block.sizes[docs]
                owner = np.repeat(np.arange(len(sizes)), sizes)
                add = lambda x: np.bincount(owner, x, len(sizes))  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [block.ids[docs], pa.array(block.held[docs]), pa.array(sizes), pa.array(add(known[t]).astype(np.int64)), pa.array(np.full(len(sizes), m.tokens, np.int64)), pa.array(add(base[t])), pa.array(add(log_scores(m, leaf, feats) + inside[t]))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return counted.mapInArrow(run, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def score(docs: DataFrame, held: Column, *, key: str = "doc_id", text: str = "text", epochs: int = 1) -> DataFrame:
    """All documents, scored by a model of those that aren't held out."""
    made = stored(blocks(docs, held, key=key, text=text), "tokens")
    counted, model = counted_blocks(made)
    discard(made)
    return scored(counted, train(counted, model, epochs=epochs))
