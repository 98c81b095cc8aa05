"""Every registered query over the small tables: its columns, one row a document, and equal values where a library function is the measure."""

import __spark_entry__
import pytest
from pyspark.sql import functions as F

from tilewright.llm import decision_list, q_text, registry, rule_ensemble, textstats
from tilewright.llm.common import remainder, table

SMALL = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op2": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op3": "doc_id class_id kept",
    "op4": "doc_id n_bytes payload_bytes payload_sha256 tail_crc32 media_bytes media_sha256 feature",
    "op5": "doc_id n_words n_removed kept_sha256",
    "op6": "doc_id held_out score predicted",
    "op7": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op8": "doc_id n_tokens p_clean p_poor p_toxic rate copies",
    "op9": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op10": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
}


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_registered_query(spark, name):
    out = registry.QUERIES[name](spark, SMALL)
    key = "conv_id" if name.startswith("op10_") else "doc_id"
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(out.columns)
    whole = table(spark, SMALL, "conversations" if key == "conv_id" else "documents")
    want = sorted(r[0] for r in (whole.select(key).distinct() if key == "conv_id" else whole.select(key)).collect())
    got = sorted(r[0] for r in out.select(key).collect())
    assert got == ([-1, *want] if key == "conv_id" else want)
    assert name in __spark_entry__.queries()


def test_decision_list_column_equals_its_conditions(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    rules = decision_list.learn(docs, labels)
    assert rules
    f = textstats.features(F.col("tw_s"))
    rows = textstats.with_counts(docs).select(decision_list.verdict(rules, F.col("tw_s")).alias("rule"), *[f[n].alias(n) for n in decision_list.FEATURES]).collect()
    for r in rows:
        first = next((i for i, rule in enumerate(rules, 1) if all(c.holds(r[c.feature]) for c in rule)), 0)
        assert r.rule == first
    assert len({r.rule for r in rows}) > 1


def test_classifier_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    known = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    got = [(r.score, r.predicted, known[r.doc_id]) for r in q_text.op6_quality_classifier(spark, sf).where("held_out").collect() if known.get(r.doc_id) is not None]
    good, bad = ([s for s, _, y in got if y == v] for v in (1, 0))
    auc = sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))
    assert len(got) > 50 and auc > 0.97 and sum(p == y for _, p, y in got) > 0.95 * len(got)
    assert all(r.score >= 0 for r in rule_ensemble.score(table(spark, sf, "documents").limit(0), rule_ensemble.learn(table(spark, sf, "documents"), table(spark, sf, "labels"), learn_if=remainder(F.col("tw_id")) != 0)).collect())


def test_names_of_operators_are_left_to_the_user(odd, labels):
    """A column may have any name that an operator would give."""
    kept = decision_list.keep(odd, [])
    assert kept.columns == odd.columns and {r.tw_q for r in kept.collect()} <= {"mine"}
    scored = rule_ensemble.score(odd, rule_ensemble.learn(odd, labels), into="points")
    assert scored.columns == [*odd.columns, "points"] and {r.tw_s for r in scored.collect()} == {"mine"}
