"""Mixing by soft membership: document rates whose expected domain totals meet targets. Native SQL throughout.

Domains are what the labelled table tells apart: "clean", "poor" (quality 0) and "toxic".
A naive Bayes classifier over binned statistics predicts each document's domain
posteriors. Where a statistic's bins end is learnt from the labels (by information gain).
Three statistics count words of a lexicon, which is learnt too: words that stand in toxic
texts alone, and beginnings of words that are far more frequent there, chosen by covering
(the next one is that which stands in most toxic texts that have none yet); these count as
such and as a share of the text's words, as long clean texts may have some by chance.
Statistics that tell nothing have one bin, so documents fall
into a bounded number of cells (MAX_CELLS), and a cell's documents have one posterior.
Rates r >= 0 (and at most max_rate) minimise, by projected gradient steps, the squared
relative distance between the expected totals sum(tokens * r * posterior) and the targets,
starting from r = 1. Documents are added up to cells in one distributed aggregation; the
steps then run in one expression over the cells' array, until they move no total any more,
and each document takes the rate of its cell.

Targets are weights; they are scaled so that the first domain's rate is ``headroom``. So
clean documents keep a rate of about 1, and the others are thinned. What the classifier
gives a domain in cells that it shares with others stays out of reach: a target below it
is met as nearly as rates of those cells allow.

Defined cases: null and empty texts have no tokens and a posterior like any text of those
statistics; domains without labelled rows have no mass and their targets are left out;
repeated rows get equal rates; with no labels at all every rate is 1; other columns pass
through, whatever their names; a text is one value of SQL expressions, whatever its length.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import discard, fresh, stored
from tilewright.llm.textstats import count_of, duplicate_lines, let, words

DOMAINS = ("clean", "poor", "toxic")
WEIGHTS = {"clean": 0.98, "poor": 0.02, "toxic": 0.0}
#: Labelled documents the classifier learns from, words and beginnings of its lexicon, and those that are looked at for it, at most.
MAX_TRAIN, LEXICON, CANDIDATES = 12_000, 64, 512
#: A word of the lexicon stands in this share of the toxic texts at least; a beginning is so many times as frequent there.
SHARE, TIMES = 0.05, 8.0
#: Letters of the beginnings that are looked at.
STEMS = (4, 5, 6, 7, 8)
#: Cells that documents fall into, and ends of bins of a statistic, at most.
MAX_CELLS, MAX_CUTS = 4096, 3
STATISTICS = ("sure", "likely", "likely_rate", "symbols", "upper", "bangs", "digits", "distinct", "mean_word", "dup_lines")


@dataclass
class Classifier:
    words: list[str]  # the lexicon
    stems: list[str]
    cuts: dict[str, list[float]]  # statistic -> upper ends of its bins, but for the last; statistics with one bin are left out
    prior: dict[str, float]  # log
    table: dict[str, list[list[float]]]  # statistic -> domain -> log of each bin's share


def terms(text: Column) -> Column:
    """Lower-case stretches of letters."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+")


def _count(text: Column, stems: list[str], end: str) -> Column:
    """How many words of the lower-case text begin with one of the stems (and end there)."""
    return F.regexp_count(text, F.lit(r"(?<!\p{L})(?:" + "|".join(stems) + ")" + end)).cast("double") if stems else F.lit(0.0)


def values(text: Column, words_: list[str], stems: list[str], names: tuple[str, ...] = STATISTICS) -> Column:
    """Struct: n_tokens and the named statistics, as numbers."""
    chars = F.greatest(F.char_length(F.coalesce(text, F.lit(""))), F.lit(1)).cast("double")
    low = F.lower(F.coalesce(text, F.lit("")))

    def of(w: Column, likely: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1)).cast("double")
        every = {
            "sure": lambda: _count(low, words_, r"(?!\p{L})"),
            "likely": lambda: likely,
            "likely_rate": lambda: likely / n,
            "symbols": lambda: count_of(text, "[#*$%&|<>]") / chars,
            "upper": lambda: count_of(text, "[A-Z]") / chars,
            "bangs": lambda: count_of(text, "!") / chars,
            "digits": lambda: count_of(text, "[0-9]") / chars,
            "distinct": lambda: F.size(F.array_distinct(w)) / n,
            "mean_word": lambda: chars / n,
            "dup_lines": lambda: duplicate_lines(text).cast("double"),
        }
        return F.struct(F.size(w).cast("long").alias("n_tokens"), *[every[k]().alias(k) for k in names])

    counted = _count(low, stems, "") if {"likely", "likely_rate"} & {*names} else F.lit(0.0)
    return let(words(text), lambda w: let(counted, lambda x: of(w, x)))


def statistics(text: Column, model: Classifier) -> Column:
    """Struct: n_tokens and the bin of each statistic that has several."""
    names = tuple(model.cuts)

    def of(v: Column) -> Column:
        return F.struct(v["n_tokens"].alias("n_tokens"), *[_binned(v[n], model.cuts[n]).alias(n) for n in names])

    return let(values(text, model.words, model.stems, names), of)


def _binned(value: Column, cuts: list[float]) -> Column:
    out = F.lit(len(cuts))
    for i, c in reversed(list(enumerate(cuts))):
        out = F.when(value <= F.lit(c), F.lit(i)).otherwise(out)
    return out


def _domains(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("x"))
    which = F.when(F.col("x") == 1, "toxic").when(F.col("q") == 0, "poor").when((F.col("q") == 1) | (F.col("x") == 0), "clean")
    ids = known.select("doc_id", which.alias("domain")).where(F.col("domain").isNotNull()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("domain", "text")


def cover(texts: list[frozenset[str]], most: int, least: int) -> list[str]:
    """Terms one after the other, each the one that stands in most texts without an earlier one, in ``least`` at least; of equals the longest."""
    left, out = list(texts), []
    while len(out) < most:
        count: dict[str, int] = {}
        for t in left:
            for w in t:
                count[w] = count.get(w, 0) + 1
        best = min(count, key=lambda w: (-count[w], -len(w), w), default=None)
        if best is None or count[best] < least:
            break
        out.append(best)
        left = [t for t in left if best not in t]
    return out


def learn_cuts(rows: list[tuple[float, str]], most: int = MAX_CUTS) -> tuple[float, list[float]]:
    """Ends of bins of one statistic by information gain, and the gain in bits a row. rows: (value, domain)."""

    def entropy(n: dict[str, int]) -> float:
        total = sum(n.values())
        return -sum(v * math.log2(v / total) for v in n.values() if v)

    def count(part: list[tuple[float, str]]) -> dict[str, int]:
        out = dict.fromkeys(DOMAINS, 0)
        for _, d in part:
            out[d] += 1
        return out

    def best(part: list[tuple[float, str]]) -> tuple[float, int]:
        low, high, found = dict.fromkeys(DOMAINS, 0), count(part), (0.0, 0)
        whole = entropy(high)
        for i in range(1, len(part)):
            d = part[i - 1][1]
            low[d] += 1
            high[d] -= 1
            if part[i][0] > part[i - 1][0]:
                gain = whole - entropy(low) - entropy(high)
                if gain > found[0] + 1e-9:
                    found = (gain, i)
        return found

    whole = sorted(rows)
    parts, cuts, total = [(*best(whole), whole)], [], 0.0
    while len(cuts) < most:
        # a cut must pay for saying where it is
        k = max(range(len(parts)), key=lambda i: parts[i][0])
        if parts[k][0] <= math.log2(max(2, len(rows))) + 8:
            break
        gain, at, part = parts.pop(k)
        cuts.append((part[at - 1][0] + part[at][0]) / 2)
        parts += [(*best(p), p) for p in (part[:at], part[at:])]
        total += gain
    return total / max(1, len(rows)), sorted(cuts)


def learn(docs: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN, lexicon: int = LEXICON) -> Classifier:
    """The classifier of the labelled documents. What is gathered are statistics of at most max_train documents."""
    sample = stored(_domains(docs, labels, max_train), "sample")
    # equal texts count once
    once = sample.groupBy(F.xxhash64("text").alias("h")).agg(F.max("domain").alias("domain"), F.first("text").alias("text"))
    bad = F.col("domain") == "toxic"
    n_toxic = once.where(bad).count()
    least = max(2, math.ceil(SHARE * n_toxic))
    # of each word: toxic texts and all texts that have it, and its places in each
    per = once.select(bad.alias("bad"), "h", F.explode(terms(F.col("text"))).alias("word")).where("word <> ''").groupBy("word", "h").agg(F.first("bad").alias("bad"), F.count("*").alias("n"))
    share = stored(per.groupBy("word").agg(F.count_if("bad").alias("t"), F.count("*").alias("texts"), F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("a"), F.sum("n").alias("n")), "share")
    sure = [r["word"] for r in share.where((F.col("t") >= least) & (F.col("t") == F.col("texts"))).orderBy(F.desc("t"), "word").limit(lexicon).collect()]
    whole = share.agg(F.sum("a").alias("a"), F.sum("n").alias("n")).first()
    inside, outside = float(whole["a"] or 0), float((whole["n"] or 0) - (whole["a"] or 0))
    stem = F.explode(F.array(*[F.when(F.char_length("word") >= k, F.substring("word", 1, k)) for k in STEMS])).alias("stem")
    begun = share.select(stem, "a", "n", "t").where("stem is not null").groupBy("stem").agg(F.sum("a").alias("a"), F.sum("n").alias("n"), F.sum("t").alias("t"))
    often = (F.col("a") >= 5) & (F.col("a") * F.lit(outside) >= F.lit(TIMES * inside) * (F.col("n") - F.col("a") + 3))
    candidates = [r["stem"] for r in begun.where(often).orderBy(F.desc("t"), "stem").limit(CANDIDATES).collect()] if n_toxic else []
    here = F.array_distinct(F.flatten(F.transform(terms(F.col("text")), lambda w: F.array(*[F.substring(w, 1, k) for k in STEMS]))))
    found = once.where(bad).select(F.array_intersect(here, F.array(*[F.lit(w) for w in candidates])).alias("w"), _count(F.lower("text"), sure, r"(?!\p{L})").alias("n")).where("n = 0").collect() if candidates else []
    stems = cover([frozenset(r["w"]) for r in found], lexicon, max(2, math.ceil(n_toxic / 100)))
    discard(share)
    got = sample.select("domain", values(F.col("text"), sure, stems).alias("s")).select("domain", "s.*").collect()
    discard(sample)
    found = {n: learn_cuts([(r[n], r["domain"]) for r in got]) for n in STATISTICS}
    cuts, cells = {}, 1
    for n in sorted(STATISTICS, key=lambda n: (-found[n][0], n)):
        if found[n][1] and cells * (len(found[n][1]) + 1) <= MAX_CELLS:
            cuts[n] = found[n][1]
            cells *= len(cuts[n]) + 1
    count = {d: sum(r["domain"] == d for r in got) for d in DOMAINS}
    table = {}
    for n, ends in cuts.items():
        bins = {d: [0.0] * (len(ends) + 1) for d in DOMAINS}
        for r in got:
            bins[r["domain"]][sum(r[n] > c for c in ends)] += 1
        table[n] = [[math.log((x + 0.05) / (count[d] + 0.05 * len(bins[d]))) for x in bins[d]] for d in DOMAINS]
    return Classifier(sorted(sure), sorted(stems), cuts, {d: math.log(count[d] / len(got)) if count[d] else -math.inf for d in DOMAINS}, table)


def posteriors(model: Classifier, s: Column) -> dict[str, Column]:
    """Posterior of each domain from the struct of statistics; an absent domain's is 0."""
    live = [d for d in DOMAINS if model.prior[d] > -math.inf]
    if not live:
        return {d: F.lit(1.0 if d == DOMAINS[0] else 0.0) for d in DOMAINS}
    logs = {}
    for d in live:
        z = F.lit(model.prior[d])
        for n in model.cuts:
            z = z + F.element_at(F.array(*[F.lit(x) for x in model.table[n][DOMAINS.index(d)]]), s[n] + 1)
        logs[d] = z
    # the sum that each is compared with, shifted by the domain's own logarithm
    return {d: 1 / sum((F.exp(F.least(logs[o] - logs[d], F.lit(500.0))) for o in live if o != d), F.lit(1.0)) if d in live else F.lit(0.0) for d in DOMAINS}


def _fitted(cells: Column, have: Column, want: Column, *, steps: int, step: float, pull: float, top: float, tolerance: float) -> Column:
    """Rates of an array of cells (tokens, p of each domain), after projected gradient steps from 1. have, want: structs of totals.

    A state is the rates and the largest move of a total in the last step; below the
    tolerance nothing is changed any more.
    """

    def relative(r: Column) -> Column:
        zero = F.struct(*[F.lit(0.0).alias(d) for d in DOMAINS])
        got = F.aggregate(F.zip_with(cells, r, lambda c, x: c.withField("r", x)), zero, lambda a, c: F.struct(*[(a[d] + c["tokens"] * c["r"] * c[d]).alias(d) for d in DOMAINS]))
        return F.transform(F.array(got), lambda g: F.struct(*[F.when(have[d] > 0, (g[d] - want[d]) / have[d]).otherwise(F.lit(0.0)).alias(d) for d in DOMAINS]))[0]

    def moved(r: Column, move: Column) -> Column:
        one = lambda c, x: F.least(F.greatest(x * F.lit(1 - step * pull) + F.lit(step * pull) - F.lit(step) * sum((c[d] * move[d] for d in DOMAINS), F.lit(0.0)), F.lit(0.0)), F.lit(top))
        return F.zip_with(cells, r, one)

    def next_state(s: Column, _: Column) -> Column:
        def apply(move: Column) -> Column:
            far = F.greatest(*[F.abs(move[d] - s["was"][d]) for d in DOMAINS])
            return F.struct(moved(s["r"], move).alias("r"), move.alias("was"), (far < tolerance).alias("done"))

        return F.when(s["done"], s).otherwise(let(relative(s["r"]), apply))

    start = F.struct(F.transform(cells, lambda _: F.lit(1.0)).alias("r"), F.struct(*[F.lit(9.0).alias(d) for d in DOMAINS]).alias("was"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, next_state)["r"]


def rated(docs: DataFrame, model: Classifier, *, weights: dict[str, float] | None = None, max_rate: float = 2.0, headroom: float = 1.0, steps: int = 400, pull: float = 1e-4, step: float = 0.9, tolerance: float = 1e-7, text: str = "text", into: str = "tw_mix", ready: bool = False) -> DataFrame:
    """docs with a struct: n_tokens, p_<domain>, rate. ready: docs have the statistics in that column already."""
    weights = weights or WEIGHTS
    bins = list(model.cuts)
    base = docs if ready else docs.withColumn(into, statistics(F.col(f"`{text}`"), model))
    cell = F.concat_ws(",", *[F.col(f"`{into}`.{n}") for n in bins], F.lit("c"))
    held = base.groupBy(cell.alias("cell")).agg(F.first(F.col(f"`{into}`")).alias("s"), F.sum(F.col(f"`{into}`.n_tokens")).cast("double").alias("tokens"))
    p = posteriors(model, F.col("s"))
    mass = stored(held.select("cell", "tokens", *[p[d].alias(d) for d in DOMAINS]).coalesce(1), "cells")
    whole = mass.agg(F.sort_array(F.collect_list(F.struct("cell", "tokens", *DOMAINS))).alias("cells"), F.struct(*[F.sum(F.col("tokens") * F.col(d)).alias(d) for d in DOMAINS]).alias("have"))
    lead = F.col(f"have.{DOMAINS[0]}")
    share = float(weights.get(DOMAINS[0], 0.0))
    size = F.when((lead > 0) & (F.lit(share) > 0), F.lit(headroom) * lead / F.lit(share or 1.0)).otherwise(sum((F.col(f"have.{d}") for d in DOMAINS), F.lit(0.0)))
    whole = whole.select("cells", "have", F.struct(*[(size * F.lit(float(weights.get(d, 0.0)))).alias(d) for d in DOMAINS]).alias("want"))
    rates = _fitted(F.col("cells"), F.col("have"), F.col("want"), steps=steps, step=step, pull=pull, top=max_rate, tolerance=tolerance)
    live = any(v > -math.inf for v in model.prior.values())
    fitted = whole.select(F.explode(F.arrays_zip(F.col("cells"), (rates if live else F.transform("cells", lambda _: F.lit(1.0))).alias("r"))).alias("z"))
    cell_name, rate_name = fresh(docs, "tw_cell"), fresh(docs, "tw_rate")
    # at most MAX_CELLS rows
    table = stored(fitted.select(F.col("z.cells.cell").alias(cell_name), F.struct(*[F.col(f"z.cells.{d}").alias(f"p_{d}") for d in DOMAINS], F.col("z.r").alias("rate")).alias(rate_name)).coalesce(1), "rates")
    discard(mass)
    joined = base.withColumn(cell_name, cell).join(F.broadcast(table), cell_name, "left")
    out = F.struct(F.col(f"`{into}`.n_tokens").alias("n_tokens"), *[F.col(f"{rate_name}.p_{d}").alias(f"p_{d}") for d in DOMAINS], F.col(f"{rate_name}.rate").alias("rate"))
    return joined.withColumn(into, out).drop(cell_name, rate_name)


def copies(rate: Column, key: Column, seed: int = 11) -> Column:
    """A whole number whose expectation over ids is the rate, the same on every run."""
    u = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return F.floor(rate + u).cast("int")


def mixed(docs: DataFrame, model: Classifier, *, key: str = "doc_id", **options) -> DataFrame:
    """docs, thinned or repeated by their rates; columns stay as they are."""
    mix, copy = fresh(docs, "tw_mix"), fresh(docs, "tw_copy")
    out = rated(docs, model, into=mix, **options)
    n = F.array_repeat(F.lit(0), copies(F.col(f"{mix}.rate"), F.col(f"`{key}`")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(n).alias(copy)).drop(copy)
