"""Parts of paths as Column functions, by the rules of pathlib."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def suffix(path: Column) -> Column:
    """With its dot, as it is written; empty where the name begins with its only dots or ends in a dot."""
    return F.regexp_extract(name(path), r"^\.*[^.].*?(\.[^.]+)$", 1)


def stem(path: Column) -> Column:
    n, s = name(path), suffix(path)
    return F.substring(n, F.lit(1), F.char_length(n) - F.char_length(s))
