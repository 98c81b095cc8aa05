"""Quality classifier: a sparse ensemble of rules, scored as a Spark column expression.

Shallow trees are grown by gradient boosting on text statistics of a bounded sample of
labelled rows. Every path from a root to a node below it is a conjunctive rule; lasso
logistic regression (proximal gradient steps) weighs the rules and leaves few of them.
The fitted model is compiled into one Column: no Python runs when documents are scored.

Defined cases: null and empty texts have all counts 0 and get the score of those values;
repeated rows get equal scores; with labels of one class only, the score is that share,
smoothed; other columns pass through unread.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm import textstats
from tilewright.llm.common import fresh, labelled
from tilewright.llm.textstats import FEATURES

#: Rows that the ensemble is fitted on, at most.
MAX_TRAIN = 12_000


@dataclass(frozen=True)
class Rule:
    """All of: feature index, whether the value must be <= the threshold, threshold."""

    tests: tuple[tuple[int, bool, float], ...]

    def on(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for k, below, cut in self.tests:
            out &= (x[:, k] <= cut) if below else (x[:, k] > cut)
        return out


@dataclass
class Model:
    names: tuple[str, ...]
    bias: float
    rules: list[Rule] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for r, w in zip(self.rules, self.weights, strict=True):
            z += w * r.on(x)
        return 1 / (1 + np.exp(-z))

    def column(self, s: Column) -> Column:
        """Probability of class 1 from the struct of textstats.with_counts."""
        f, z = textstats.features(s), F.lit(float(self.bias))
        for r, w in zip(self.rules, self.weights, strict=True):
            test = None
            for k, below, cut in r.tests:
                one = f[self.names[k]] <= F.lit(float(cut)) if below else f[self.names[k]] > F.lit(float(cut))
                test = one if test is None else test & one
            z = z + F.when(test, F.lit(float(w))).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _binned(x: np.ndarray, bins: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Cuts between distinct values near even quantiles, by feature, and each value's bin."""
    cuts, codes = [], np.zeros(x.shape, np.int32)
    for k in range(x.shape[1]):
        v = np.unique(x[:, k])
        at = np.unique(np.searchsorted(v, np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1]), "right"))
        at = at[(at > 0) & (at < len(v))]
        cuts.append((v[at - 1] + v[at]) / 2)
        codes[:, k] = np.searchsorted(cuts[k], x[:, k], "left")
    return cuts, codes


def _tree(codes: np.ndarray, cuts: list[np.ndarray], grad: np.ndarray, hess: np.ndarray, depth: int, least: int, features: np.ndarray) -> tuple[list[tuple], np.ndarray]:
    """Rules of one tree's nodes, and its step for every row."""
    rules, step, todo = [], np.zeros(len(grad)), [(np.arange(len(grad)), ())]
    while todo:
        rows, tests = todo.pop()
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-6, None)
        if len(tests) < depth and len(rows) >= 2 * least:
            for k in features:
                if len(cuts[k]) == 0:
                    continue
                size = len(cuts[k]) + 1
                c = codes[rows, k]
                gl, hl, nl = (np.cumsum(np.bincount(c, w, size))[:-1] for w in (grad[rows], hess[rows], np.ones(len(rows))))
                gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
                gain[(nl < least) | (nl > len(rows) - least)] = -1
                j = int(np.argmax(gain))
                if gain[j] > best[0]:
                    best = (float(gain[j]), (int(k), j))
        if best[1] is None:
            step[rows] = g / (h + 1)
            continue
        k, j = best[1]
        left = codes[rows, k] <= j
        for part, below in ((rows[left], True), (rows[~left], False)):
            path = (*tests, (k, below, float(cuts[k][j])))
            rules.append(path)
            todo.append((part, path))
    return rules, step


def fit(x: np.ndarray, y: np.ndarray, names: tuple[str, ...] = FEATURES, *, trees: int = 24, depth: int = 3, bins: int = 48, rate: float = 0.3, lasso: float = 1e-3, steps: int = 600, seed: int = 7) -> Model:
    order = np.lexsort((*x.T, y)) if len(y) else np.arange(0)
    x, y = np.asarray(x, float)[order], np.asarray(y, float)[order]
    share = (y.sum() + 0.5) / (len(y) + 1)
    if len(y) == 0 or y.min() == y.max():
        return Model(names, float(np.log(share / (1 - share))))
    cuts, codes = _binned(x, bins)
    rng, z, paths = np.random.default_rng(seed), np.full(len(y), np.log(share / (1 - share))), {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-z))
        some = np.sort(rng.choice(x.shape[1], max(2, x.shape[1] * 2 // 3), replace=False))
        new, step = _tree(codes, cuts, y - p, p * (1 - p), depth, max(5, len(y) // 2000), some)
        z += rate * step
        paths |= dict.fromkeys(new)
    rules, seen = [], set()
    for path in paths:
        on = Rule(path).on(x)
        if (key := on.tobytes()) not in seen and 0 < on.sum() < len(y):
            seen.add(key)
            rules.append(Rule(path))
    if not rules:  # no value tells the classes apart
        return Model(names, float(np.log(share / (1 - share))))
    a = np.stack([r.on(x) for r in rules], 1).astype(float)
    mean = a.mean(0)
    sd = np.sqrt(np.maximum(mean * (1 - mean), 1e-4))
    a = (a - mean) / sd
    w, b, v, vb, t = np.zeros(a.shape[1]), float(np.log(share / (1 - share))), np.zeros(a.shape[1]), 0.0, 1.0
    vb = b
    u = np.ones(a.shape[1]) / np.sqrt(a.shape[1])
    for _ in range(12):  # largest singular value, by power steps
        u = a.T @ (a @ u)
        u /= np.linalg.norm(u)
    eta = 4 * len(y) / (1.05 * float(np.linalg.norm(a @ u)) ** 2 + len(y))
    for _ in range(steps):
        r = 1 / (1 + np.exp(-(a @ v + vb))) - y
        w2 = v - eta * (a.T @ r) / len(y)
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - eta * lasso, 0)
        b2, t2 = vb - eta * r.mean(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return Model(names, float(b - (w * mean / sd).sum()), [rules[k] for k in kept], [float(w[k] / sd[k]) for k in kept])


def learn(docs: DataFrame, labels: DataFrame, *, learn_if: Column | None = None, max_train: int = MAX_TRAIN, **options) -> Model:
    """learn_if: a condition on the column tw_id (the document's id) of rows that may be learnt from."""
    sample = textstats.with_counts(labelled(docs, labels, "quality", max_train, learn_if))
    f = textstats.features(F.col("tw_s"))
    got = sample.select("y", *[f[n].alias(n) for n in FEATURES]).collect()
    x = np.array([[float(r[n]) for n in FEATURES] for r in got]).reshape(-1, len(FEATURES))
    return fit(x, np.array([r["y"] for r in got], float), FEATURES, **options)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "tw_score") -> DataFrame:
    """docs with one more column, the score; others stay as they are, whatever their names."""
    counts = fresh(docs, "tw_s")
    return textstats.with_counts(docs, text, counts).withColumn(into, model.column(F.col(counts))).drop(counts)
