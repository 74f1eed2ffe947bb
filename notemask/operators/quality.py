"""Checks on label rows, counts, and one row per distinct text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_validation_counts(annotated: DataFrame) -> DataFrame:
    """Notes per label code."""
    return annotated.groupBy("label_code").agg(F.count("*").alias("n_notes"))


def split_equals_counts(annotated: DataFrame) -> DataFrame:
    """Notes with valid labels per outcome of the size check, equal ones first."""
    return (
        annotated.filter("label_code = 1")
        .groupBy(F.col("sizes.split_equals").alias("split_equals"))
        .agg(F.count("*").alias("n_notes"))
        .orderBy(F.desc("split_equals"))
    )


def valid_rows(annotated: DataFrame) -> DataFrame:
    """Notes that passed every guard and check."""
    return annotated.filter("reject_reason is null")


def keep_first_text(labelled: DataFrame, id_cols: list[str]) -> DataFrame:
    """One row per distinct cleaned text: the one with the lowest id.

    Each task first reduces its own rows, so a text that fills a large part of the table reaches
    the shuffle at most once per task.
    """
    rest = [c for c in labelled.columns if c not in id_cols]
    return (
        labelled.groupBy(F.sha2("cleaned", 256).alias("text_key"))
        .agg(F.min(F.struct(*id_cols, *rest)).alias("first"))
        .select("first.*")
        .select(*labelled.columns)
    )
