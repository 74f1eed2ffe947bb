"""A training corpus from raw documents: harmless, distinct, mixed and encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notemask.llm import exact_dedup, mixing, ngram_join, sentencepiece, toxicity
from notemask.llm.common import table, written

#: SQL can't express the classifier, nor the encoding; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def in_small_batches(spark: SparkSession) -> None:
    """Texts go to Python tasks a few hundred and a few megabytes at a time: stages follow each other in one session, and
    the memory that large batches take stays with the executors beside the next stages' work. Rows alone bound nothing
    where very long texts stand side by side."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; it learns from labelled rows of `docs`."""
    in_small_batches(spark)
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar documents."""
    return ngram_join.without_similar(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, the last of each source cut at its budget."""
    mixed = mixing.mixed_documents(docs)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(*(F.col(f"`{c}`") for c in docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row."""
    encoded = sentencepiece.encode_documents(docs, sentencepiece.load(), keep=("doc_id", "lang", "source"))
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
