"""Texts far longer than what a task works on at once, with and without blanks, lines and repeats."""

import re

import pytest
import sentencepiece as library

from notemask.llm import exact_dedup, line_crf, mixing, ngram_join, quality_rules, repeats, secrets, sentencepiece, toxicity

LONG = [(1, "word " * 400_000), (2, "x" * 30_000), (3, "a b c d e\n" * 50_000), (4, " ".join(map(str, range(60_000)))), (5, "\n" * 100_000)]


@pytest.fixture(scope="module")
def long_documents(documents):
    return documents(LONG).cache()


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_words_and_rules(long_documents):
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in LONG}
    assert {i: r.n_words for i, r in by_id(quality_rules.ledger(long_documents)).items()} == words
    assert {i: r["size"] for i, r in by_id(mixing.sized_documents(long_documents)).items()} == words
    assert all(r.spans == "" for r in secrets.secret_spans(long_documents).collect())


def test_classifiers(spark, long_documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 6)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        assert toxicity.toxicity_scores(long_documents, toxicity.fit(long_documents, labels)).count() == 5
        assert line_crf.quality_scores(long_documents, line_crf.fit(long_documents, labels)).count() == 5


def test_duplicates(long_documents):
    assert all(r.kept and r.group_size == 1 for r in exact_dedup.duplicates(long_documents).collect())
    found = by_id(ngram_join.similar_documents(long_documents))
    assert {i: r.n_shingles for i, r in found.items()} == {1: 1, 2: 1, 3: 5, 4: 59_996, 5: 0}
    assert all(r.component_id == i for i, r in found.items())
    spans = by_id(repeats.repeated_spans(long_documents))
    assert {i: r.n_bytes for i, r in spans.items()} == {i: len(t) for i, t in LONG}
    assert all(r.n_removed == 0 for r in spans.values())


def test_encoding(long_documents):
    want = library.SentencePieceProcessor(model_file=sentencepiece.MODEL_PATH)
    found = sentencepiece.encode_documents(long_documents.filter("doc_id <> 1"), sentencepiece.load()).collect()
    for r in found:
        assert list(r.ids) == want.encode(dict(LONG)[r.doc_id])
