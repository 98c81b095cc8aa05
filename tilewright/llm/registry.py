"""Queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tilewright.llm import q_bpe, q_chat, q_lm, q_media, q_mix, q_near, q_repeats, q_text

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**q_lm.QUERIES, **q_mix.QUERIES, **q_repeats.QUERIES, **q_bpe.QUERIES, **q_near.QUERIES, **q_media.QUERIES, **q_text.QUERIES, **q_chat.QUERIES}
ORACLE_SQL: dict[str, str] = {**q_repeats.ORACLE_SQL, **q_near.ORACLE_SQL, **q_chat.ORACLE_SQL}
