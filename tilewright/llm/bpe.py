"""BPE encoding and decoding with a lexicon automaton and exact merges.

Words that are frequent in the corpus are encoded once, on the driver, and compiled into a
minimal acyclic transducer with id outputs, which executors map from a file. A batch's
texts are split by the tokenizer's pattern; words that a worker hasn't met are looked up
together, those the lexicon lacks are merged exactly (vectorized over all of them; very
long ones by a heap), and ids are gathered per text. A worker remembers a bounded number
of words over its batches. Decoding gathers the ids' bytes. Special tokens
are recognised in texts as the tokenizers library does by default, leftmost first.

Counting words takes one pass and one shuffle of words pre-aggregated by task; which words
count as frequent is read from a histogram of counts, so that at most ``max_words`` (the
bound of what is broadcast) are gathered. A lexicon only saves work: ids are the same with
any, or none.

Defined cases: a null text is empty and has no tokens; repeated rows encode alike; other
columns aren't carried along; a text is handled whole, so one of n bytes takes some 20 n
bytes of a worker's memory.
"""

from __future__ import annotations

import heapq
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm import transducer
from tilewright.llm.arrays import slices, spread
from tilewright.llm.common import discard, small_batches, stored

#: Words in the lexicon, at most.
MAX_WORDS = 1 << 16
#: Fixed by the format of byte-level vocabularies: how text is split before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same for texts of ASCII alone, for which the plain engine is faster.
ASCII_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"""
_LONG = 400
#: Rank of a pair that isn't merged.
_NONE = 1 << 40
#: Words that a worker remembers, at most (and those of a batch more).
REMEMBERED = 1 << 18


def _byte_chars() -> dict[str, int]:
    """Fixed by the format: the printable characters that stand for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, n = {chr(b): b for b in plain}, 256
    for b in range(256):
        if b not in plain:
            out[chr(n)] = b
            n += 1
    return out


class Vocabulary:
    """A byte-level BPE vocabulary, from the text of its tokenizer.json."""

    def __init__(self, text: str) -> None:
        j = json.loads(text)
        model, chars = j["model"], _byte_chars()
        if model["type"] != "BPE" or (j["pre_tokenizer"] or {}).get("type") != "ByteLevel" or j["normalizer"] or model.get("ignore_merges"):
            raise ValueError("only plain byte-level BPE vocabularies")
        if j["pre_tokenizer"].get("add_prefix_space") or not j["pre_tokenizer"].get("use_regex", True):
            raise ValueError("only vocabularies that split by the pattern, without a prefix space")
        self.special = {t["content"]: t["id"] for t in j["added_tokens"]}
        ids = model["vocab"]
        self.size = 1 + max([*ids.values(), *self.special.values()])
        self.bytes_of = [b""] * self.size
        for token, i in ids.items():
            self.bytes_of[i] = bytes(chars[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.byte_id = np.zeros(256, np.int64)
        for c, b in chars.items():
            self.byte_id[b] = ids[c]
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        key = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        # pairs in a hash table, a quarter full at most, with linear probing; the last slot of all is for pairs that aren't there
        self.bits = max(4, (4 * len(key)).bit_length())
        self.pair, self.rank, self.made = np.full((1 << self.bits) + 1, -1, np.int64), np.full((1 << self.bits) + 1, _NONE, np.int64), np.zeros((1 << self.bits) + 1, np.int64)
        for i, at in enumerate(self._slot(key).tolist()):
            while self.pair[at] >= 0:
                at = (at + 1) & ((1 << self.bits) - 1)
            self.pair[at], self.rank[at], self.made[at] = key[i], i, made[i]
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.wide, self.plain = regex.compile(PATTERN).findall, re.compile(ASCII_PATTERN).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair (_NONE where it isn't merged), and its slot."""
        key = left << 32 | right
        at = self._slot(key)
        found = self.pair[at]
        other = np.flatnonzero(found != key)
        while len(other):
            gone = found[other] < 0
            at[other[gone]] = 1 << self.bits
            other = other[~gone]
            at[other] = (at[other] + 1) & ((1 << self.bits) - 1)
            found[other] = self.pair[at[other]]
            other = other[found[other] != key[other]]
        return self.rank[at], at

    def merge_one(self, word: bytes) -> list[int]:
        """A heap of pairs by rank and place, for words so long that rounds over them are slow."""
        sym = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        nxt, prv = [*range(1, len(sym)), -1], [-1, *range(len(sym) - 1)]
        first, where = self._ranks(np.array(sym[:-1], np.int64), np.array(sym[1:], np.int64))
        heap = [(int(r), i, sym[i], sym[i + 1], int(self.made[j])) for i, (r, j) in enumerate(zip(first, where, strict=True)) if r < _NONE]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            k = nxt[i]
            if sym[i] != a or k < 0 or sym[k] != b:
                continue
            sym[i], sym[k], nxt[i] = new, -1, nxt[k]
            if nxt[k] >= 0:
                prv[nxt[k]] = i
            for x in (prv[i], i):
                if x >= 0 and nxt[x] >= 0:
                    r, j = self._ranks(np.array([sym[x]], np.int64), np.array([sym[nxt[x]]], np.int64))
                    if r[0] < _NONE:
                        heapq.heappush(heap, (int(r[0]), x, sym[x], sym[nxt[x]], int(self.made[j[0]])))
        return [s for s in sym if s >= 0]

    def merge(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word data[off[i]:off[i+1]], one after the other, and how many each has."""
        size = np.diff(off)
        done: dict[int, list[int]] = {int(i): self.merge_one(data[off[i] : off[i + 1]].tobytes()) for i in np.flatnonzero(size > _LONG)}
        short = np.flatnonzero((size <= _LONG) & (size > 0))
        sym = self.byte_id[data[spread(off[short], size[short])]]
        word = np.repeat(short, size[short])
        kept_sym, kept_word = [], []
        while len(sym):
            same = word[1:] == word[:-1]
            r, j = self._ranks(sym[:-1], sym[1:])
            r[~same] = _NONE
            r = np.append(r, _NONE)
            head = np.flatnonzero(np.append(True, ~same))
            best = np.minimum.reduceat(r, head)
            count = np.diff(np.append(head, len(sym)))
            fixed = np.repeat(best == _NONE, count)
            if fixed.any():
                kept_sym.append(sym[fixed])
                kept_word.append(word[fixed])
            hit = (r == np.repeat(best, count)) & ~fixed
            at = np.flatnonzero(hit)
            if len(at):  # of places side by side, every other one, from the left
                run = np.append(True, np.diff(at) != 1)
                since = np.arange(len(at)) - np.flatnonzero(run)[np.cumsum(run) - 1]
                at = at[since % 2 == 0]
            sym[at] = self.made[j[at]]
            stay = ~fixed
            stay[at + 1] = False
            sym, word = sym[stay], word[stay]
        words = np.concatenate([*kept_word, *(np.full(len(v), k) for k, v in done.items()), np.zeros(0, np.int64)]).astype(np.int64)
        syms = np.concatenate([*kept_sym, *(np.array(v, np.int64) for v in done.values()), np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(words, kind="stable")
        return syms[order], np.bincount(words, minlength=len(size))

    def split(self, text: str) -> list[str]:
        return self.plain(text) if text.isascii() else self.wide(text)

    def pieces(self, text: str) -> list[str]:
        if self.specials is None or not any(s in text for s in self.special):
            return self.split(text)
        out: list[str] = []
        for k, part in enumerate(self.specials.split(text)):
            # a special token is told from equal words by a mark, which no word begins with
            out += [_MARK + part] if k % 2 else self.split(part)
        return out


#: Stands before special tokens among a text's pieces. A lone surrogate is in no text.
_MARK = "\udcff"


@lru_cache(maxsize=4)
def vocabulary(text: str) -> Vocabulary:
    return Vocabulary(text)


class _Codes(dict):
    """Numbers words in the order of their first use; new ones are listed until ``new`` is emptied."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Encoder:
    """Encodes batches; lexicon: compiled transducer or None."""

    def __init__(self, vocab: Vocabulary, lexicon: bytes | None = None) -> None:
        self.vocab = vocab
        self.lexicon = transducer.Transducer.mapped(lexicon) if lexicon else None
        self._forget()

    def _forget(self) -> None:
        self.codes, self.ids, self.size = _Codes(), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and each text's number of ids."""
        if len(self.codes) > REMEMBERED:
            self._forget()
        of, counts, code = self.codes.__getitem__, np.zeros(len(texts), np.int64), []
        for i, t in enumerate(texts):
            words = self.vocab.pieces(t)
            counts[i] = len(words)
            code.append(np.fromiter(map(of, words), np.int32, len(words)))
        if self.codes.new:
            ids, size = self.words(self.codes.new)
            self.ids, self.size = np.concatenate([self.ids, ids.astype(np.int32)]), np.concatenate([self.size, size])
            self.codes.new = []
        code = np.concatenate(code) if code else np.zeros(0, np.int32)
        per_word = self.size[code]
        flat = self.ids[spread((np.cumsum(self.size) - self.size)[code], per_word)]
        ends = np.cumsum(np.append(0, per_word))
        return flat, np.diff(ends[np.cumsum(np.append(0, counts))])

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        special = {i: self.vocab.special[w[1:]] for i, w in enumerate(words) if w[:1] == _MARK}
        raw = [b"" if i in special else w.encode() for i, w in enumerate(words)]
        off = np.cumsum([0, *map(len, raw)], dtype=np.int64)
        data = np.frombuffer(b"".join(raw) or b"\0", np.uint8)
        rank = self.lexicon.ranks(data, off) if self.lexicon else np.full(len(raw), -1, np.int64)
        size, new = np.zeros(len(raw), np.int64), np.flatnonzero(rank < 0)
        lens = np.diff(off)
        merged, n = self.vocab.merge(data[spread(off[new], lens[new])], np.cumsum(np.append(0, lens[new])))
        size[new] = n
        known = np.flatnonzero(rank >= 0)
        if len(known):
            size[known] = self.lexicon.starts[rank[known] + 1].astype(np.int64) - self.lexicon.starts[rank[known]]
        for i in special:
            size[i] = 1
        start = np.cumsum(size) - size
        out = np.zeros(int(size.sum()), np.int64)
        out[spread(start[new], n)] = merged
        if len(known):
            out[spread(start[known], size[known])] = self.lexicon.ids[spread(self.lexicon.starts[rank[known]].astype(np.int64), size[known])]
        for i, t in special.items():
            out[start[i]] = t
        return out, size


def decode(vocab: Vocabulary, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """Texts of ids laid one text after the other; bytes that are no UTF-8 become U+FFFD."""
    ids = np.asarray(ids, np.int64)
    size = vocab.length[ids]
    raw = vocab.flat[spread(vocab.start[ids], size)].tobytes()
    ends = np.cumsum(np.append(0, size))[np.cumsum(np.append(0, counts))].tolist()
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:], strict=False)]


def word_counts(docs: DataFrame, vocab_text: str, text: str = "text") -> DataFrame:
    """Rows (word, n) over all texts; tasks add up what they have seen before anything is shuffled."""

    def told(seen: Counter) -> pa.RecordBatch:
        words = [w for w in seen if w[0] != _MARK]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([seen[w] for w in words], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, seen = vocabulary(vocab_text), Counter()
        for b in batches:
            for t in b.column(0):
                if (t := t.as_py()) is not None:
                    seen.update(vocab.pieces(t))
            if len(seen) > 200_000:
                yield told(seen)
                seen = Counter()
        yield told(seen)

    return docs.select(text).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(docs: DataFrame, vocab_text: str, *, text: str = "text", max_words: int = MAX_WORDS) -> bytes:
    """The compiled transducer of the corpus's frequent words: all words of a count that at most max_words reach."""
    counts = stored(word_counts(docs, vocab_text, text).where((F.col("n") > 1) & (F.octet_length("word") <= _LONG)), "words")
    # powers of 2^(1/4) are fine enough; a step of the histogram can't hold more rows than a long counts
    step = F.floor(F.log2(F.col("n").cast("double")) * 4).cast("int")
    histogram = sorted(((r["s"], r["c"]) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("c")).collect()), reverse=True)
    least, total = None, 0
    for s, c in histogram:
        total += c
        if total > max_words:
            break
        least = s
    frequent = [r["word"] for r in counts.where(step >= least).select("word").collect()] if least is not None else []
    discard(counts)
    frequent.sort()
    vocab = vocabulary(vocab_text)
    ids, size = Encoder(vocab).words(frequent)
    ends = np.cumsum(np.append(0, size)).tolist()
    flat = ids.tolist()
    return transducer.build([(w.encode(), tuple(flat[ends[i] : ends[i + 1]])) for i, w in enumerate(frequent)])


def encode(docs: DataFrame, vocab_text: str, compiled: bytes | None, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, ids array<int>)."""

    def ids_of(b: pa.RecordBatch) -> pa.RecordBatch:
        return b.select([0, 1])

    kind = docs.schema[key].dataType.simpleString()
    return applied(docs, vocab_text, compiled, ids_of, f"key {kind}, ids array<int>", key=key, text=text, back=False).withColumnRenamed("key", key)


def applied(docs: DataFrame, vocab_text: str, compiled: bytes | None, then: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, *, key: str = "doc_id", text: str = "text", back: bool = True) -> DataFrame:
    """What ``then`` makes of batches (key, ids array<int>, text): texts encoded and, if ``back``, decoded again, in one pass."""
    sent, spoken = docs.sparkSession.sparkContext.broadcast(compiled), docs.sparkSession.sparkContext.broadcast(vocab_text)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(spoken.value)
        enc = Encoder(vocab, sent.value)
        for b in batches:
            sizes = pc.fill_null(pc.binary_length(b.column(1)), 0)
            for i, j in slices(np.asarray(sizes).astype(np.int64)):
                ids, n = enc.encode([t or "" for t in b.column(1).slice(i, j - i).to_pylist()])
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(np.append(0, n)), pa.int32()), pa.array(ids, pa.int32()))
                cols = [b.column(0).slice(i, j - i), lists]
                if back:
                    cols.append(pa.array(decode(vocab, ids, n), pa.string()))
                yield then(pa.RecordBatch.from_arrays(cols, ["key", "ids", "text"][: len(cols)]))

    return docs.select(key, text).mapInArrow(run, schema)


def decoded(encoded: DataFrame, vocab_text: str, *, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Rows (key, ids, text): texts of encoded rows."""
    kind = encoded.schema[key].dataType.simpleString()
    spoken = encoded.sparkSession.sparkContext.broadcast(vocab_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(spoken.value)
        for b in batches:
            lists = b.column(1)
            lists = lists.fill_null([]) if lists.null_count else lists
            for i, j in slices(np.asarray(pc.list_value_length(lists)) * 4):
                part = lists.slice(i, j - i)
                n = np.asarray(pc.list_value_length(part)).astype(np.int64)
                texts = decode(vocab, np.asarray(part.flatten()), n)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), part, pa.array(texts, pa.string())], ["key", "ids", "text"])

    return encoded.select(key, ids).mapInArrow(run, f"key {kind}, ids array<int>, text string").withColumnRenamed("key", key)
