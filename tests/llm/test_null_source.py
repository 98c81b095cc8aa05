"""A row without an id is no source of passages, and hides none."""

from tilewright.llm import debruijn


def test_a_null_copy_hides_no_source(spark):
    words = " ".join(f"w{i}" for i in range(120))
    docs = spark.createDataFrame([(None, words), (3, words), (5, words), (None, "p q " + words), (6, "other start " + words + " other end")], "doc_id long, text string")
    got = sorted(((r.doc_id or 0), r.n_words, r.n_removed) for r in debruijn.digests(docs).collect())
    assert got == [(0, 120, 0), (0, 122, 0), (3, 120, 0), (5, 120, 120), (6, 124, 120)]
