"""Mixing meets its targets, by a lexicon that doesn't hang on the size of the label table."""

import numpy as np
import pytest

from tilewright.llm import soft_mixing


@pytest.fixture(scope="module")
def given(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]


@pytest.mark.parametrize("weights", [{"clean": 0.9, "poor": 0.1, "toxic": 0.0}, {"clean": 0.98, "poor": 0.02, "toxic": 0.0}])
def test_totals_are_those_of_a_plain_solver(given, weights):
    """Within a fiftieth of what any rates up to 2 can reach, and near the targets themselves."""
    r = soft_mixing.rated(given[0], soft_mixing.learn(*given), weights=weights).select("tw_mix.*").toPandas()
    p, t = r[[f"p_{d}" for d in soft_mixing.DOMAINS]].to_numpy(), r.n_tokens.to_numpy(float)
    have = t @ p
    want = have[0] / weights["clean"] * np.array(list(weights.values()))
    far = lambda x: (((t * x) @ p - want) ** 2 / have**2).sum()
    best = np.ones(len(r))
    for _ in range(3000):
        best = np.clip(best - 0.9 * p @ (((t * best) @ p - want) / have), 0, 2)
    got = (t * r.rate.to_numpy()) @ p
    assert far(r.rate.to_numpy()) <= far(best) + 1e-3  # the pull towards 1 costs a little
    assert (np.abs(got - (t * best) @ p) <= 0.02 * have).all()
    # what shares cells with clean texts stays out of reach
    assert (np.abs(got - want) <= np.array([0.02, 0.2, 0.12]) * have).all(), (got, want, have)


def test_toxic_documents_go_and_clean_ones_stay(given):
    docs, labels = given
    kept = {r.doc_id for r in soft_mixing.mixed(docs, soft_mixing.learn(docs, labels), headroom=1.1, max_rate=1.0).collect()}
    known = {r.doc_id: r for r in labels.collect()}
    toxic = [i for i, r in known.items() if r.toxic == 1]
    clean = [i for i, r in known.items() if r.toxic == 0 and r.quality == 1]
    assert sum(i in kept for i in toxic) <= 0.15 * len(toxic)
    assert sum(i in kept for i in clean) == len(clean)


def test_a_small_label_table_has_a_lexicon(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    assert soft_mixing.learn(docs, labels).words
