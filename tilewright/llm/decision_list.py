"""Quality rules: a learned, ordered list of threshold conjunctions.

Sequential covering in the manner of incremental reduced-error pruning. A rule is grown,
condition by condition, on two thirds of the labelled rows (the condition with the best
FOIL gain next), then pruned on the other third, and kept while it is precise there; what
it covers is removed, and the next rule is grown from the rest. The list is emitted as
one Spark conditional expression over text statistics. Learning gathers one bounded
sample of statistics, by ``collect``; judging documents is native SQL and has no shuffle.

Defined cases: a null or empty text has no words and so fails the base rules; repeated
rows get the same verdict each; without labels of both classes the list is empty and only
the base rules decide; other columns pass through unread.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm import textstats
from tilewright.llm.common import fresh, labelled
from tilewright.llm.textstats import let

#: Statistics that rules may test: rates that don't follow a text's length.
FEATURES = tuple(n for n in textstats.FEATURES if n not in ("n_words", "distinct_rate"))

#: Rows that a rule list is learnt from, at most.
MAX_TRAIN = 8000


@dataclass(frozen=True)
class Condition:
    feature: str
    below: bool  # value <= threshold, else value > threshold
    threshold: float

    def holds(self, value: float) -> bool:
        return value <= self.threshold if self.below else value > self.threshold


def learn_rules(rows: list[tuple[tuple[float, ...], int]], names: tuple[str, ...] = FEATURES, *, bins: int = 32, max_rules: int = 12, max_conditions: int = 4, precision: float = 0.97) -> list[list[Condition]]:
    """Rules for rows of class 0 ("junk"), most useful first. rows: (values, class), in any order."""
    rows = sorted(rows)
    cuts = []
    for k in range(len(names)):
        vs = sorted({v[k] for v, _ in rows})
        ranked = sorted(v[k] for v, _ in rows)
        picks = {ranked[min(len(ranked) - 1, j * len(ranked) // bins)] for j in range(1, bins)} | {ranked[min(len(ranked) - 1, int(len(ranked) * q))] for q in (0.005, 0.01, 0.02, 0.98, 0.99, 0.995)} if ranked else set()
        mids = []
        for v in sorted(picks):
            above = next((x for x in vs[_after(vs, v) :]), None)
            mids.append(v if above is None else (v + above) / 2)
        cuts.append(sorted(set(mids)))
    grow = [r for i, r in enumerate(rows) if i % 3]
    prune = [r for i, r in enumerate(rows) if i % 3 == 0]
    rules: list[list[Condition]] = []
    while len(rules) < max_rules:
        rule = _grow(grow, names, cuts, max_conditions)
        if not rule:
            break
        rule = _prune(rule, prune, names)
        hit, miss = _covered(rule, prune, names)
        if hit + miss == 0 or hit < precision * (hit + miss):
            break
        rules.append(rule)
        left = lambda part: [r for r in part if not _matches(rule, r[0], names)]  # noqa: E731, B023
        grow, prune = left(grow), left(prune)
    return rules


def _after(vs: list[float], v: float) -> int:
    lo, hi = 0, len(vs)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if vs[mid] <= v else (lo, mid)
    return lo


def _matches(rule: list[Condition], values: tuple[float, ...], names: tuple[str, ...]) -> bool:
    return all(c.holds(values[names.index(c.feature)]) for c in rule)


def _covered(rule: list[Condition], rows: list, names: tuple[str, ...]) -> tuple[int, int]:
    hit = [y for v, y in rows if _matches(rule, v, names)]
    return sum(y == 0 for y in hit), sum(y != 0 for y in hit)


def _grow(rows: list, names: tuple[str, ...], cuts: list[list[float]], most: int) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < most:
        p0 = sum(y == 0 for _, y in rows)
        n0 = len(rows) - p0
        if p0 < 3 or n0 == 0:
            break
        was, best = math.log2(p0 / (p0 + n0)), (1e-9, None)
        for k, name in enumerate(names):
            if not cuts[k]:
                continue
            pos, neg = [0] * (len(cuts[k]) + 1), [0] * (len(cuts[k]) + 1)
            for v, y in rows:
                b = _before(cuts[k], v[k])
                if y == 0:
                    pos[b] += 1
                else:
                    neg[b] += 1
            p = n = 0
            for j, cut in enumerate(cuts[k]):
                p, n = p + pos[j], n + neg[j]
                for below, pp, nn in ((True, p, n), (False, p0 - p, n0 - n)):
                    if pp >= 3 and nn < n0:
                        gain = pp * (math.log2(pp / (pp + nn)) - was)
                        if gain > best[0]:
                            best = (gain, Condition(name, below, cut))
        if best[1] is None:
            break
        rule.append(best[1])
        k = names.index(best[1].feature)
        rows = [r for r in rows if best[1].holds(r[0][k])]
    return rule


def _before(cuts: list[float], v: float) -> int:
    """Number of cuts below v: v <= cuts[j] for all j from there."""
    lo, hi = 0, len(cuts)
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (mid + 1, hi) if cuts[mid] < v else (lo, mid)
    return lo


def _prune(rule: list[Condition], rows: list, names: tuple[str, ...]) -> list[Condition]:
    def worth(r: list[Condition]) -> float:
        hit, miss = _covered(r, rows, names)
        return (hit - miss) / (hit + miss) if hit + miss else -1.0

    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def verdict(rules: list[list[Condition]], s: Column) -> Column:
    """The ordered conditional: number of the first rule that matches, from 1; 0 where none does."""
    f = textstats.features(s)
    out = None
    for i, rule in enumerate(rules, 1):
        test = None
        for c in rule:
            one = f[c.feature] <= F.lit(c.threshold) if c.below else f[c.feature] > F.lit(c.threshold)
            test = one if test is None else test & one
        out = F.when(test, F.lit(i)) if out is None else out.when(test, F.lit(i))
    return F.lit(0) if out is None else out.otherwise(F.lit(0))


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def learn(docs: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN, **options) -> list[list[Condition]]:
    sample = textstats.with_counts(labelled(docs, labels, "quality", max_train))
    f = textstats.features(F.col("tw_s"))
    got = sample.select("y", *[f[n].alias(n) for n in FEATURES]).collect()
    return learn_rules([(tuple(float(r[n]) for n in FEATURES), int(r["y"])) for r in got], **options)


def judge(docs: DataFrame, rules: list[list[Condition]], text: str = "text", into: str = "tw_q") -> DataFrame:
    """Adds a struct: the raw counts, base_failed, rule (number of the matching rule or 0) and kept."""
    out = textstats.with_counts(docs, text, into)

    def of(s: Column) -> Column:
        names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
        return F.struct(*[s[n].alias(n) for n in names], base_failed(s).alias("base_failed"), verdict(rules, s).alias("rule"))

    return out.withColumn(into, let(F.col(into), of)).withColumn(into, let(F.col(into), lambda q: q.withField("kept", ~q["base_failed"] & (q["rule"] == 0))))


def keep(docs: DataFrame, rules: list[list[Condition]], text: str = "text") -> DataFrame:
    """The documents that pass, with their own columns only."""
    verdict_name = fresh(docs, "tw_q")
    judged = judge(docs, rules, text, verdict_name)
    return judged.where(F.col(f"{verdict_name}.kept")).select(*[F.col(f"`{n}`") for n in docs.columns])
