"""Per-document statistics as native Spark columns.

Everything here is a Column built from SQL functions: no Python runs on the
executors. A null text counts as empty. Words are ``[^\\x20\\x09-\\x0D]+``, which is
what Java's ``\\s`` splits on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Statistics that the learned operators may look at, in a fixed order.
FEATURES = ("n_words", "mean_word", "symbol_rate", "upper_rate", "bang_rate", "digit_rate", "dup_line_rate", "repeat_rate", "distinct_rate", "stop_rate")


def let(value: Column, body) -> Column:
    """``body(value)`` with value computed once per row, whatever the optimizer inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), "")


def count_of(text: Column, klass: str) -> Column:
    """Number of characters of a regex class."""
    return (F.size(F.split(F.coalesce(text, F.lit("")), klass, -1)) - 1).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines that hold a word and equal an earlier line of the text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(r"\S"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def repeat_words(ws: Column, width: int = 3) -> Column:
    """Words inside a window of ``width`` words that the text holds twice or more.

    A text whose windows all differ is done after one pass. Otherwise hashes of windows are
    sorted with their positions, so that equal windows are neighbours, and the covered words
    are counted from the gaps between starts: O(n log n) per document.
    """
    hashes = F.when(F.size(ws) >= width, F.transform(F.sequence(F.lit(0), F.size(ws) - width), lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(width)]))).otherwise(F.array().cast("array<bigint>"))

    def of(h: Column) -> Column:
        def starts(p: Column) -> Column:
            kept = F.filter(p, lambda x, k: (x["h"] == F.get(p, k + 1)["h"]) | (x["h"] == F.get(p, k - 1)["h"]))
            return F.sort_array(F.transform(kept, lambda x: x["i"]))

        def covered(r: Column) -> Column:
            gaps = F.transform(r, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(r, k + 1) - x, F.lit(width))))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)

        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(placed, lambda p: let(starts(p), covered)))

    return let(hashes, of)


def with_counts(df: DataFrame, text: str = "text", into: str = "tw_s") -> DataFrame:
    """Adds one struct column of raw counts; other columns are untouched, whatever their names."""
    t = F.col(f"`{text}`")

    def of(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
            count_of(t, "[#*$%&|<>]").alias("n_symbols"),
            duplicate_lines(t).alias("n_dup_lines"),
            repeat_words(w).alias("n_repeat_words"),
            count_of(t, "[A-Z]").alias("n_upper"),
            count_of(t, "!").alias("n_bang"),
            count_of(t, "[0-9]").alias("n_digits"),
            count_of(t, "\n").alias("n_breaks"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            F.size(F.filter(w, lambda x: F.char_length(x) <= 3)).cast("long").alias("n_short"),
        )

    return df.withColumn(into, let(words(t), of))


def features(s: Column) -> dict[str, Column]:
    """The learned operators' inputs, all finite, from the struct of with_counts."""
    chars, n = F.greatest(s["word_chars"], F.lit(1)).cast("double"), F.greatest(s["n_words"], F.lit(1)).cast("double")
    return {
        "n_words": s["n_words"].cast("double"),
        "mean_word": s["word_chars"] / n,
        "symbol_rate": s["n_symbols"] / chars,
        "upper_rate": s["n_upper"] / chars,
        "bang_rate": s["n_bang"] / chars,
        "digit_rate": s["n_digits"] / chars,
        "dup_line_rate": s["n_dup_lines"] / (s["n_breaks"] + F.lit(1.0)),
        "repeat_rate": s["n_repeat_words"] / n,
        "distinct_rate": s["n_distinct"] / n,
        "stop_rate": s["n_short"] / n,
    }
