"""Each operator on odd rows and on no rows, held against plain Python."""

import hashlib
import json
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tilewright.llm import bpe, bwt, chat, dartminhash, debruijn, decision_list, jpeg, maxent, media, q_bpe, q_chat, q_near, rule_ensemble, soft_mixing, suffix_dedup, textstats, transducer, wordhash
from tilewright.llm.common import remainder

SMALL = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.collect()]


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


# 1


def repeats(rows, w):
    c = Counter(t.encode()[i : i + w] for _, t in rows for i in range(len(t.encode()) - w + 1))
    for i, t in rows:
        b = t.encode()
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - w + 1):
            if c[b[p : p + w]] > 1:
                gone[p] += 1
                gone[p + w] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        yield i, len(b), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), hashlib.sha256(kept).hexdigest()


def test_suffix_dedup_odd_rows(odd, none):
    same(suffix_dedup.digests(suffix_dedup.with_spans(odd, into="tw_mine"), spans="tw_mine").collect(), list(repeats(texts(odd), 200)))
    assert suffix_dedup.digests(suffix_dedup.with_spans(none, into="tw_mine"), spans="tw_mine").count() == 0


def test_suffix_dedup_crowded_anchors(spark):
    rng = random.Random(2)
    mid = "abcdefghijklmnopqrstuvwxyz0123456789"
    pad = lambda: "".join(rng.choice("ab") for _ in range(rng.randint(0, 30)))
    df = spark.createDataFrame([(i, pad() + mid + pad()) for i in range(40)], "doc_id long, text string")
    same(suffix_dedup.digests(suffix_dedup.with_spans(df, window=24, hot=4)).collect(), list(repeats(texts(df), 24)))


def test_suffix_dedup_many_near_copies(spark):
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 999)}" for _ in range(60)]
    rows = [(i, " ".join(rng.choice(base) if rng.random() < 0.03 else w for w in base)) for i in range(600)]
    df = spark.createDataFrame([*rows, *((1000 + i, t) for i, t in rows[:50])], "doc_id long, text string").repartition(4)
    same(suffix_dedup.digests(suffix_dedup.with_spans(df, window=60, hot=16)).collect(), list(repeats(texts(df), 60)))


def test_suffix_dedup_writes_few_files(spark, monkeypatch, tmp_path):
    """Strings go to their blocks without a table of their own, and small result rows to few files."""
    labels, stored = [], suffix_dedup.stored
    monkeypatch.setattr(suffix_dedup, "stored", lambda df, label: labels.append(label) or stored(df, label))
    rng = random.Random(6)
    words = [f"{rng.random():.17f}" for _ in range(1500)]
    rows = [(i, " ".join(rng.choices(words, k=800) + words[:30] + rng.choices(words, k=200))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    held = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        suffix_dedup.digests(suffix_dedup.with_spans(df)).write.parquet(f"{tmp_path}/out")
    finally:
        for k in held:
            spark.conf.unset(k)
    assert "hits" in labels and "strings" not in labels
    assert len(list((tmp_path / "out").glob("part-*"))) == 1
    same(spark.read.parquet(f"{tmp_path}/out").collect(), list(repeats(texts(df), 200)))


def test_cleaned_keeps_columns(odd):
    out = suffix_dedup.cleaned(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert [r.tw_spans for r in out.select("tw_spans").distinct().collect()] == ["mine"]


def test_expansion_equals_counting():
    rng = random.Random(5)
    for _ in range(25):
        d, letters = rng.choice([3, 5, 9]), rng.choice([b"ab", bytes(range(256))])
        s = list({bytes(rng.choice(letters) for _ in range(rng.randint(d, 40))) for _ in range(10)})
        w = np.array([rng.choice([1, 2]) for _ in s])
        c = Counter()
        for x, n in zip(s, w, strict=True):
            for i in range(len(x) - d + 1):
                c[x[i : i + d]] += n
        assert [g.tolist() for g in bwt.repeated(s, w, d)] == [[i for i in range(len(x) - d + 1) if c[x[i : i + d]] > 1] for x in s]


# 2


@pytest.fixture(scope="module")
def vocab():
    return q_bpe.vocabulary_text()


def test_bpe_equals_the_library(odd, none, vocab):
    import public_tokenizers
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path(q_bpe.VOCABULARY))
    want = [(i, len(e), hashlib.sha256(np.array(e, "<u4").tobytes()).hexdigest(), hashlib.sha256(known.decode(e, skip_special_tokens=False).encode()).hexdigest()) for i, t in texts(odd) for e in [known.encode(t, add_special_tokens=False).ids]]
    same(q_bpe.tokenized(odd).collect(), want)
    assert q_bpe.tokenized(none).count() == 0
    rng = random.Random(3)
    odd_texts = ["".join(rng.choice("ab the'll  \n\t\x1c\x85　éß漢🙂½²_-12aaaa") for _ in range(rng.randint(0, 60))) for _ in range(400)] + ["a" * 1000]
    ids, n = bpe.Encoder(bpe.vocabulary(vocab)).encode(odd_texts)
    ends = np.cumsum(np.append(0, n))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == [e.ids for e in known.encode_batch(odd_texts, add_special_tokens=False)]


def test_transducer_shares_suffixes():
    words = [b"tapping", b"topping", b"tap", b"top", b"stop"]
    t = transducer.Transducer.mapped(transducer.build([(w, (i, i + 1)) for i, w in enumerate(words)]))
    asked = [*words, b"to", b"toppings", b""]
    rank = t.ranks(np.frombuffer(b"".join(asked), np.uint8), np.cumsum([0, *map(len, asked)]))
    assert [tuple(t.ids[t.starts[r] : t.starts[r + 1]].tolist()) if r >= 0 else None for r in rank] == [*[(i, i + 1) for i in range(5)], None, None, None]
    assert len(t.final) < len({w[:i] for w in words for i in range(len(w) + 1)})


# 3


def test_dart_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    e, w = rng.integers(0, 2**63, 500, dtype=np.uint64), rng.random(1000) * 5
    s = dartminhash.signatures(np.concatenate([e, e]), np.array([500, 500]), 2048, w)
    assert abs((s[0] == s[1]).mean() - np.minimum(w[:500], w[500:]).sum() / np.maximum(w[:500], w[500:]).sum()) < 0.05


def test_near_duplicates(spark, odd, none):
    got = {(r.doc_id, r.class_id) for r in dartminhash.classes(odd).collect()}
    assert {(2, 1), (1, 1), (5, 5), (3, 3), (8, 8), (None, None)} <= got
    assert dartminhash.classes(none).count() == 0
    kept = dartminhash.keep_first(odd)
    assert kept.columns == odd.columns and Counter(r.doc_id for r in kept.collect())[5] == 1
    rng = random.Random(1)
    base = [f"w{rng.randint(0, 999)}" for _ in range(200)]
    rows = [(0, " ".join(base))]
    for i in range(1, 40):
        w = list(base)
        for _ in range(1 + i % 7):
            w[rng.randrange(200)] = f"v{i}"
        rows.append((i, " ".join(w)))
    sets = [{tuple(t.split()[k : k + 5]) for k in range(196)} for _, t in rows]
    top = list(range(40))
    for a in range(40):
        for b in range(a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) and top[a] != top[b]:
                lo, hi = sorted((top[a], top[b]))
                top = [lo if x == hi else x for x in top]
    same(dartminhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id").collect(), list(enumerate(top)))


def linked(rows, least=0.8, width=5):
    """Class of every row by all pairs: rows joined by links, named by the smallest id."""
    sets = {}
    for i, t in rows:
        w = t.split()
        sets[i] = {tuple(w[a : a + width]) for a in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    top, where = {i: i for i, _ in rows}, {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    texts_of, n = {}, 0
    for i, t in rows:
        texts_of.setdefault(t, []).append(i)
    for same_text in texts_of.values():
        for i in same_text[1:]:
            top[max(root(i), root(same_text[0]))] = min(root(i), root(same_text[0]))
    for i, s in sets.items():
        for j, common in Counter(j for x in s for j in where[x] if j > i).items():
            if common >= least * (len(s) + len(sets[j]) - common):
                n += 1
                top[max(root(i), root(j))] = min(root(i), root(j))
    return {i: root(i) for i in top}, n


def test_all_links_of_the_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want, links = linked(texts(docs))
    got = {r.doc_id: r.class_id for r in q_near.op3_minhash_near_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert links > 90 and got == want


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"w{rng.randint(0, 500)}" for _ in range(120)]
    rows = []
    for i in range(900):
        mine = [rng.choice(base) if rng.random() < 0.012 else w for w in base]
        rows.append((i, " ".join(mine)))
    want, _ = linked(rows)
    got = dartminhash.classes(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "class_id").collect()
    assert dict(map(tuple, got)) == want and 20 < len(set(want.values())) < 800


def test_keep_first_takes_one_row_of_each_class(spark):
    rows = [(3, "a b c d e f", 1), (1, "a b c d e f", 2), (1, "a b c d e f", 3), (None, "x", 4), (7, "x", 5), (8, None, 6), (9, "", 7)]
    got = dartminhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string, tw_0 int")).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "8", "None"] and {r.tw_0 for r in got} <= {2, 3, 4, 6}


# 4


def test_media_round_trip(odd, none):
    stored = media.store_texts(odd.withColumn("doc_id", F.monotonically_increasing_id()))
    got = media.describe(stored).collect()
    assert all(r.error is None for r in got)
    want = [media.padded(t.encode()) for _, t in texts(odd)]
    assert sorted((r.samples_bytes, r.samples_sha256, r.tail_crc32) for r in got) == sorted((len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-16:])) for p in want)
    assert media.describe(media.store_texts(none)).count() == 0


def test_other_readers_see_the_payload(spark, tmp_path):
    payload = bytes(range(256)) * 3
    (tmp_path / "a.jpg").write_bytes(jpeg.write([payload])[0])
    im = spark.read.format("image").load(str(tmp_path)).select("image.*").first()
    a = np.frombuffer(im.data, np.uint8).reshape(im.height, im.width, im.nChannels)[4::8, 4::8, 0]
    assert a.tobytes() == payload


def test_damaged_images_are_errors(spark):
    good = jpeg.write([b"x" * 192])[0]
    df = spark.createDataFrame([(1, good), (2, good[:-40]), (3, b"no"), (4, None), (5, good.replace(b"\xff\xc0", b"\xff\xc2"))], "doc_id long, media binary")
    assert {r.doc_id: r.error is None for r in media.describe(df).collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}


# 5


def shared(rows, w):
    first = {}
    for i, t in rows:
        x = t.encode().split()
        for p in range(len(x) - w + 1):
            if i is not None:
                first[tuple(x[p : p + w])] = min(first.get(tuple(x[p : p + w]), i), i)
    for i, t in rows:
        x = t.encode().split()
        gone = [False] * len(x)
        for p in range(len(x) - w + 1):
            if i is not None and first[tuple(x[p : p + w])] < i:
                gone[p : p + w] = [True] * w
        yield i, len(x), sum(gone), hashlib.sha256(b" ".join(a for a, g in zip(x, gone, strict=True) if not g)).hexdigest()


@pytest.mark.parametrize("w", [6, 50])
def test_substring_dedup(spark, odd, none, w):
    rng = random.Random(2)
    mid = [f"w{i}" for i in range(60)]
    more = [(100 - i, " ".join([rng.choice("ab") for _ in range(rng.randint(0, 9))] + mid[rng.randint(0, 9) :] + [rng.choice("ab") for _ in range(rng.randint(0, 9))])) for i in range(30)]
    df = odd.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    same(debruijn.digests(df, window=w).collect(), list(shared(texts(df), w)))
    assert debruijn.digests(none, window=w).count() == 0


# 6 and 9


def test_statistics(odd):
    import re

    word = re.compile("[^\x20\x09-\x0d]+")
    got = sorted((tuple(r) for r in textstats.with_counts(odd).select("tw_s.n_words", "tw_s.word_chars", "tw_s.n_symbols", "tw_s.n_dup_lines", "tw_s.n_repeat_words").collect()))
    want = []
    for _, t in texts(odd):
        w = word.findall(t)
        c = Counter(zip(w, w[1:], w[2:], strict=False))
        cov = {j for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if word.search(x)]
        want.append((len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), len(lines) - len(set(lines)), len(cov)))
    assert got == sorted(want)


def test_decision_list(odd, none, labels):
    rng = random.Random(0)
    rows = [((rng.random(), rng.random()), None) for _ in range(900)]
    rows = [(v, int(not (v[0] > 0.7 and v[1] <= 0.5))) for v, _ in rows]
    rules = decision_list.learn_rules(rows, ("a", "b"))
    caught = lambda v: any(all(c.holds(v["ab".index(c.feature)]) for c in r) for r in rules)
    assert sum(caught(v) == (y == 0) for v, y in rows) > 0.97 * len(rows)
    assert decision_list.learn_rules([]) == []
    learnt = decision_list.learn(odd, labels)
    out = decision_list.keep(odd, learnt)
    assert out.columns == odd.columns
    assert decision_list.judge(none, decision_list.learn(none, labels)).count() == 0
    assert {r.doc_id for r in decision_list.keep(odd, []).collect()} <= {5, 6}


def test_rule_ensemble_held_out():
    rng = np.random.default_rng(1)
    x = rng.random((3000, 3))
    y = ((x[:, 0] > 0.4) & (x[:, 1] < 0.8)).astype(float)
    m = rule_ensemble.fit(x[:2000], y[:2000], ("a", "b", "c"))
    assert ((m.predict(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.97
    assert 0 < rule_ensemble.fit(np.zeros((0, 3)), np.zeros(0)).predict(np.zeros((1, 3)))[0] < 1


def test_rule_ensemble_odd_rows(odd, none, labels):
    m = rule_ensemble.learn(odd, labels, learn_if=remainder(F.col("tw_id")) != 0)
    got = rule_ensemble.score(odd, m).collect()
    assert len(got) == odd.count() and all(0 <= r.tw_score <= 1 for r in got)
    assert rule_ensemble.score(none, m).count() == 0


def test_compiled_rules_equal_the_model(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    m = rule_ensemble.learn(docs, labels)
    f = textstats.features(F.col("tw_s"))
    got = textstats.with_counts(docs).select(*[f[n].alias(n) for n in m.names], m.column(F.col("tw_s")).alias("p")).collect()
    assert np.allclose([r.p for r in got], m.predict(np.array([tuple(r)[:-1] for r in got], float)))


# 7


def test_lm_scores(odd, none):
    got = maxent.score(odd, remainder(F.col("doc_id")) == 1).collect()
    rows = texts(odd)
    low = lambda t: bytes(b + 32 if 65 <= b <= 90 else b for b in t.encode()).split() + [b""]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, t in rows if not held(i) for w in low(t))
    n, v = sum(c.values()), len(c)
    want = [(i, held(i), len(low(t)), sum(c[w] > 0 for w in low(t)), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in low(t)), 4)) for i, t in rows]
    same([(*tuple(r)[:5], round(r.base_score, 4)) for r in got], want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert maxent.score(none, remainder(F.col("doc_id")) == 1).count() == 0


def test_lm_beats_its_base_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = maxent.score(docs, remainder(F.col("doc_id")) == 1).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def mixed64(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB % 2**64
    return x ^ (x >> 31)


def plain_lm(rows):
    """The model in loops over tokens and dicts. rows: (id, text, held out)."""
    named = {}

    def name(w):
        if w not in named:
            d = np.frombuffer(w, np.uint8)
            h = int(wordhash.hash_words(d, np.array([0, len(w)]))[0][0]) if w else 0
            first = int(wordhash.hash_spans(d, np.array([0]), np.array([min(3, len(w))]), seed=9)[0]) >> 34 if w else 0
            named[w] = (max(h, 1) if w else 0, first)
        return named[w]

    signed = lambda x: x - 2**64 if x >= 2**63 else x
    docs = [(i, [bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in t.encode().split()] + [b""], h) for i, t, h in rows]
    c = Counter(w for _, ws, h in docs if not h for w in ws)
    n, v = sum(c.values()), len(c)
    m = maxent.Model(n, v)
    top = sorted((w for w in c if w), key=lambda w: (-c[w], signed(name(w)[0])))[: m.own - 1]
    rank = {b"": 0} | {w: i + 1 for i, w in enumerate(top)}
    k, own, leaves = m.branch, m.own, m.leaves
    leaf = lambda w: rank[w] if w in rank else own + mixed64(name(w)[1]) % (leaves - own)
    symbol = lambda w: (mixed64(rank[w] + 2**41) if w in rank else mixed64(name(w)[1] + 2**40)) >> 33
    total, kinds = Counter(), Counter()
    for w, x in c.items():
        total[leaf(w)] += x
        kinds[leaf(w)] += 1

    def share(level, prefix, digit):
        width = k ** (2 - level)
        under = lambda d: sum(x for y, x in total.items() if y // width == prefix * k + d) + 0.5
        return under(digit) / sum(under(d) for d in range(k))

    shares = {}

    def shared(level, prefix):
        if (level, prefix) not in shares:
            shares[level, prefix] = [share(level, prefix, d) for d in range(k)]
        return shares[level, prefix]

    def events(ws):
        for i, w in enumerate(ws):
            s = [symbol(ws[i - d]) if i >= d else 0 for d in (1, 2, 3)]
            feats = [mixed64(s[0] + 11), mixed64((mixed64(s[0] + 23) + s[1]) % 2**64), mixed64(s[1] + (37 << 32)), mixed64(s[2] + (53 << 32))]
            for level in range(3):
                upto = leaf(w) // k ** (2 - level)
                at = [(((f ^ ((upto // k) * 0xA0761D6478BD642F + 0xD6E8FEB86659FD93 * (1 + j + 4 * level)) % 2**64) * 0x9E3779B97F4A7C15) % 2**64) >> (64 - m.bits) for j, f in enumerate(feats)]
                yield w, level, upto // k, upto % k, at

    seen, due = Counter(), Counter()
    for _, ws, h in docs:
        if not h:
            for _, level, prefix, y, at in events(ws):
                for b in at:
                    seen[level, b, y] += 1
                    for d in range(k):
                        due[level, b, d] += shared(level, prefix)[d]
    weight = {}
    for level, b, d in due:
        part = due[level, b, d] / sum(due[level, b, e] for e in range(k)) * maxent.DAMP
        weight[level, b, d] = maxent.RATE * math.log((seen[level, b, d] + part) / (due[level, b, d] + part))
    for i, ws, _ in docs:
        out = 0.0
        for w, level, prefix, y, at in events(ws):
            z = [math.log(shared(level, prefix)[d]) + sum(weight.get((level, b, d), 0.0) for b in at) for d in range(k)]
            out += z[y] - math.log(sum(map(math.exp, z)))
        yield i, out / math.log(10) + sum(math.log10((c[w] + 0.5) / (total[leaf(w)] + 0.5 * (kinds[leaf(w)] + 1))) for w in ws)


def test_lm_scores_equal_plain_loops(spark):
    rng = random.Random(8)
    words = [rng.choice(["stone", "Sto", "x", "long" * 30, "é"]) + str(rng.randint(0, 9)) for _ in range(1500)] + ["rare%d" % i for i in range(1200)]
    rows = [(i, " ".join(rng.choice(words) if rng.random() < 0.5 else "the a of".split()[j % 3] for j in range(rng.randint(0, 60))), i % 5 == 1) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, text string, held boolean")
    want = dict(plain_lm(rows))
    for parts in (1, 7):
        got = {r.doc_id: r.score for r in maxent.score(df.repartition(parts, "id"), F.col("held"), key="id").collect()}
        assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 2e-3 * max(1, abs(want[i])) for i in want)


def test_lm_scores_do_not_depend_on_the_partitioning(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    one, two = ({r.doc_id: (r.score, r.base_score, r.n_known) for r in maxent.score(docs.repartition(n, "doc_id"), remainder(F.col("doc_id")) == 1).collect()} for n in (4, 13))
    assert one.keys() == two.keys() and all(np.allclose(one[i], two[i], rtol=1e-4) for i in one)


def test_long_words_that_look_alike_are_told_apart():
    a, b = "a", "b"
    for _ in range(11):
        a, b = a + b, b + a
    assert len(set(wordhash.hash_words(np.frombuffer((a + " " + b).encode(), np.uint8), np.array([0, 2 * len(a) + 1]))[0].tolist())) == 2


# 8


def test_mixing_meets_targets(spark, odd, none, labels):
    docs, given = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    m = soft_mixing.learn(docs, given)
    weights = {"clean": 0.9, "poor": 0.1, "toxic": 0.0}
    r = soft_mixing.rated(docs, m, weights=weights).select("tw_mix.*").toPandas()
    have = {d: (r.n_tokens * r[f"p_{d}"]).sum() for d in soft_mixing.DOMAINS}
    got = {d: (r.n_tokens * r.rate * r[f"p_{d}"]).sum() for d in soft_mixing.DOMAINS}
    assert np.allclose(r[[f"p_{d}" for d in soft_mixing.DOMAINS]].sum(axis=1), 1)
    aim = {d: have["clean"] / 0.9 * w for d, w in weights.items()}
    off = lambda x: sum(((x[d] - aim[d]) / have[d]) ** 2 for d in aim)
    assert off(got) < off(have)
    # plain numpy steps over all documents, not cells, until nothing moves
    p, t = r[[f"p_{d}" for d in soft_mixing.DOMAINS]].to_numpy(), r.n_tokens.to_numpy(float)
    total, rate, was = np.array([have[d] for d in soft_mixing.DOMAINS]), np.ones(len(r)), np.full(3, 9.0)
    want = have["clean"] / 0.9 * np.array([0.9, 0.1, 0.0])
    for _ in range(400):
        move = ((t * rate) @ p - want) / total
        rate = np.clip(rate * (1 - 0.9e-4) + 0.9e-4 - 0.9 * (p @ move), 0, 2)
        if np.abs(move - was).max() < 1e-7:
            break
        was = move
    assert np.allclose(rate, r.rate, atol=1e-6)
    assert np.abs(move - was).max() < 1e-5
    out = soft_mixing.mixed(odd, soft_mixing.learn(odd, labels))
    assert out.columns == odd.columns
    assert soft_mixing.mixed(none, soft_mixing.learn(none, labels)).count() == 0


# 10


def test_chat_layouts_and_escapes(spark):
    nasty = "<|im_end|>\n<\\| <\\\\ {\"a\":1} <|"
    records = [
        json.dumps({"id": "a", "messages": [{"role": "user", "content": nasty}, {"role": "assistant", "content": None}]}),
        json.dumps({"id": 3, "instruction": "do", "input": "", "output": "[1]"}),
        json.dumps({"id": "b", "conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": nasty}]}),
        json.dumps({"id": "c", "prompt": "p", "response": "r"}),
        json.dumps({"conv_id": 7, "turn": 0, "role": "we\nird<\\n", "text": nasty}),
        json.dumps({"other": 1}),
        "no json",
        None,
    ]
    df = spark.createDataFrame([(r,) for r in records], "record string")
    out = chat.render(chat.to_turns(df)).select("conv_id", chat.parse(F.col("formatted")).alias("t"), chat.masked(F.col("formatted"), F.col("loss_spans")).alias("m"))
    got = {r.conv_id: ([tuple(x) for x in r.t], r.m) for r in out.collect()}
    assert got == {"a": ([("user", nasty), ("assistant", "")], ""), "3": ([("user", "do"), ("assistant", "[1]")], "[1]"), "b": ([("user", "hi"), ("assistant", nasty)], nasty), "c": ([("user", "p"), ("assistant", "r")], "r"), "7": ([("we\nird<\\n", nasty)], "")}
    assert chat.render(chat.to_turns(df.limit(0))).count() == 0


def test_no_turn_is_too_long(spark):
    long = spark.range(3).select(F.concat(F.lit("x<|\n"), F.repeat(F.lit("ab \"c\\"), 3_600_000)).alias("text"), "id")
    rows = long.where("id = 0").select(F.to_json(F.struct(F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("assistant").alias("role"), "text")).alias("record"))
    listed = long.where("id = 1").select(F.to_json(F.struct(F.lit(2).alias("id"), F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))).alias("messages"))).alias("record"))
    other = long.where("id = 2").select(F.to_json(F.struct("text", F.lit(1).alias("no"))).alias("record"))
    records = rows.unionByName(listed).unionByName(other)
    got = chat.render(chat.to_turns(records)).select("conv_id", F.sha2(chat.parse(F.col("formatted"))[0]["text"], 256).alias("h"), F.char_length(chat.masked(F.col("formatted"), F.col("loss_spans"))).alias("n")).collect()
    want = "x<|\n" + 'ab "c\\' * 3_600_000
    assert sorted(map(tuple, got)) == [(str(i), hashlib.sha256(want.encode()).hexdigest(), len(want) if i == 1 else 0) for i in (1, 2)]
    assert chat.unknown(records).count() == 1


def test_chat_equals_sql(spark):
    import duckdb

    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SMALL}/conversations.parquet'")
    cols = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    want = c.sql(q_chat.ORACLE_SQL["op10_chat_formatting"]).df()[cols]
    same(q_chat.op10_chat_formatting(spark, SMALL).select(*cols).collect(), [tuple(r) for r in want.itertuples(index=False)])
