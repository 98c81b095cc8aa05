"""The pipeline's stages, each on what its predecessor kept, against plain Python."""

import hashlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import linked, repeats

from tilewright.llm import decision_list, q_bpe, soft_mixing, textstats
from tilewright.llm.common import table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """Frames before and after each stage, by its name."""
    docs, out = table(spark, SMALL, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name))
        stage(spark, docs, SMALL).write.mode("overwrite").parquet(path)
        out[name] = docs, spark.read.parquet(path)
        docs = out[name][1]
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_stages_keep_columns(spark, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            got = out.collect()
            if name != "bpe_encoding":
                assert out.columns == docs.columns, name
            assert len(got) <= docs.count(), name


def test_run(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = corpus_pipeline.run(spark, SMALL)
    assert 0 < out.count() < docs.count() and out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_stages_are_in_order_and_keep_the_columns(spark, steps):
    columns = table(spark, SMALL, "documents").columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "minhash_near_dedup", "suffix_array_dedup", "soft_mixing", "bpe_encoding"]
    assert all(after.columns == columns for _, after in list(steps.values())[:-1])
    assert 0 < steps["bpe_encoding"][1].count() < table(spark, SMALL, "documents").count()


def test_quality_rules_keep_what_no_rule_rejects(spark, steps):
    before, after = steps["quality_rules"]
    rules = decision_list.learn(before, table(spark, SMALL, "labels"))
    f = textstats.features(F.col("tw_s"))
    got = textstats.with_counts(before).select("doc_id", "text", "tw_s.n_words", "tw_s.n_repeat_words", *[f[n].alias(f"f_{n}") for n in decision_list.FEATURES]).collect()
    fine = lambda r: r.n_words >= 50 and 100 * r.n_repeat_words <= 50 * r.n_words and not any(all(c.holds(r[f"f_{c.feature}"]) for c in rule) for rule in rules)
    assert rows(after) == sorted((r.doc_id, r.text) for r in got if fine(r))


def test_one_document_of_each_class_stays(steps):
    before, after = steps["minhash_near_dedup"]
    classes, _ = linked(rows(before))
    assert rows(after) == [(i, t) for i, t in rows(before) if classes[i] == i]


def test_repeated_passages_are_cut(steps):
    before, after = steps["suffix_array_dedup"]
    want = {i: (n - gone, sha) for i, n, gone, _, sha in repeats(rows(before), 200)}
    got = {r.doc_id: r for r in after.collect()}
    assert got.keys() == want.keys()
    for i, (size, sha) in want.items():
        body = got[i].text.encode()
        # parts of cut characters go too, so such a text may be shorter
        assert hashlib.sha256(body).hexdigest() == sha or size - 6 <= len(body) < size
        assert got[i].n_chars == len(got[i].text)


def test_mixing_takes_documents_by_their_rates(spark, steps):
    before, after = steps["soft_mixing"]
    model = soft_mixing.learn(before, table(spark, SMALL, "labels"))
    rated = soft_mixing.rated(before, model, headroom=1.1, max_rate=1.0).select("doc_id", "tw_mix.*").toPandas()
    p, t = rated[[f"p_{d}" for d in soft_mixing.DOMAINS]].to_numpy(), rated.n_tokens.to_numpy(float)
    want, rate = (t @ p)[0] * 1.1 / 0.98 * np.array([0.98, 0.02, 0.0]), np.ones(len(rated))
    have = t @ p
    for _ in range(400):
        # a domain without mass asks for nothing
        rate = np.clip(rate * (1 - 0.9e-4) + 0.9e-4 - 0.9 * (p @ np.where(have > 0, ((t * rate) @ p - want) / np.where(have > 0, have, 1), 0)), 0, 1)
    assert np.allclose(rate, rated.rate, atol=1e-4)
    kept, sure = {r.doc_id for r in after.collect()}, set(rated.doc_id[rate > 0.9999])
    assert sure <= kept and not kept & set(rated.doc_id[rate < 1e-4]) and len(sure) > 50


def test_tokens_are_those_of_the_library(steps):
    import public_tokenizers
    from tokenizers import Tokenizer

    before, after = steps["bpe_encoding"]
    known = Tokenizer.from_file(public_tokenizers.path(q_bpe.VOCABULARY))
    got = sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in after.collect())
    want = []
    for i, text in rows(before):
        ids = known.encode(text, add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    assert got == sorted(want)
