"""Registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    chat, collocations, exact_dedup, line_crf, line_dedup, mixing, ngram_join, oracle, periods, quality_rules, repeats,
    secrets, sentencepiece, toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": chat.op1,
    "op2_sentencepiece": sentencepiece.op2,
    "op3_toxicity": toxicity.op3,
    "op4_repeated_passages": repeats.op4,
    "op5_quality_classifier": line_crf.op5,
    "op6_source_mixing": mixing.op6,
    "op7_exact_dedup": exact_dedup.op7,
    "op8_secret_scan": secrets.op8,
    "op9_quality_rules": quality_rules.op9,
    "op10_ngram_jaccard_join": ngram_join.op10,
    "op11_collocations": collocations.op11,
    "op12_periodic_runs": periods.op12,
    "op13_line_dedup": line_dedup.op13,
}

ORACLE: dict[str, str] = {
    "op1_chat_formatting": chat.OP1_SQL,
    "op4_repeated_passages": oracle.OP4,
    "op6_source_mixing": oracle.OP6,
    "op7_exact_dedup": exact_dedup.OP7_SQL,
    "op9_quality_rules": oracle.OP9,
    "op10_ngram_jaccard_join": oracle.OP10,
    "op11_collocations": collocations.OP11_SQL,
    "op13_line_dedup": line_dedup.OP13_SQL,
}
