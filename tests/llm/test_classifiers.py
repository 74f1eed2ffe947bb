"""Toxicity and quality: held-out accuracy, odd rows, and the methods against brute force."""

import itertools
import zlib

import numpy as np
import pytest

from notemask.llm import line_crf, toxicity
from notemask.llm.queries import QUERIES

BIG = "/root/testdata/sf0.1"


def quality_of(spark, name, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = QUERIES[name](spark, BIG).collect()
    assert len(rows) == spark.read.parquet(f"{BIG}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    score, y = np.array(held).T
    rank = np.argsort(np.argsort(score))
    auc = (rank[y == 1].mean() - (y.sum() - 1) / 2) / (y == 0).sum()
    return rows, auc, ((score >= 0.5) == y).mean()


def test_toxicity_on_held_out_rows(spark):
    rows, auc, accuracy = quality_of(spark, "op3_toxicity", "toxic")
    assert auc > 0.97 and accuracy > 0.97
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_quality_on_held_out_rows(spark):
    rows, auc, accuracy = quality_of(spark, "op5_quality_classifier", "quality")
    assert auc > 0.99 and accuracy > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 1), (6, 0, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("op", [toxicity, line_crf])
def test_odd_rows(odd, labels, op):
    score = op.toxicity_scores if op is toxicity else op.quality_scores
    for known in (labels, labels.limit(0)):
        model = op.fit(odd, known)
        rows = score(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
        by_id = {r.doc_id: r.score for r in rows}
        assert by_id[1] == by_id[2] == by_id[8]
    assert score(odd.limit(0), model).count() == 0


def test_without_toxic_keeps_columns(odd, labels):
    kept = toxicity.without_toxic(odd, toxicity.fit(odd, labels.limit(0)))
    assert kept.schema == odd.schema and kept.count() == odd.count()


def test_pooling_equals_brute_force():
    random = np.random.default_rng(0)
    model = toxicity.train(
        [random.integers(0, toxicity.BUCKETS, (n, toxicity.TABLES)).astype(np.uint16) for n in (3, 1, 8, 2, 5, 4)],
        np.array([0, 1, 0, 1, 0, 1]), ["en", "de", None, "en", "de", "en"],
    )
    docs = [random.integers(0, toxicity.BUCKETS, (n, toxicity.TABLES)).astype(np.uint16) for n in (0, 1, 2, 7, 30)]
    want = []
    for d in docs:
        x = [sum(model.tables[t][w[t]] for t in range(toxicity.TABLES)) for w in d] or [np.zeros(toxicity.DIM)]
        x += [np.zeros(toxicity.DIM)] * 2
        peaks, at = [], 0
        for k in toxicity.WIDTHS:
            z = [
                sum(x[i + o] @ model.conv[:, at + o * toxicity.FILTERS : at + (o + 1) * toxicity.FILTERS] for o in range(k))
                for i in range(len(x) - 2)
            ]
            peaks.append(np.max(z, axis=0))
            at += k * toxicity.FILTERS
        want.append(np.maximum(np.concatenate(peaks) + model.bias, 0) @ model.out + model.out_bias)
    assert np.allclose(model.logits(docs), want, atol=1e-4)


def test_marginals_equal_enumeration():
    random = np.random.default_rng(1)
    lines = np.array([3, 0, 1, 5])
    emission, change = random.normal(size=9), random.normal(size=(2, 2))
    good, pairs = line_crf.forward_backward(emission, change, lines)
    want, want_pairs, at = [], np.zeros((2, 2)), 0
    for n in lines:
        states = list(itertools.product((0, 1), repeat=int(n)))
        weight = [
            np.exp(sum(emission[at + i] * s[i] for i in range(n)) + sum(change[s[i], s[i + 1]] for i in range(n - 1))) for s in states
        ]
        total = sum(weight)
        want += [sum(w for w, s in zip(weight, states, strict=True) if s[i]) / total for i in range(n)]
        for w, s in zip(weight, states, strict=True):
            for i in range(n - 1):
                want_pairs[s[i], s[i + 1]] += w / total
        at += n
    assert np.allclose(good, want) and np.allclose(pairs, want_pairs)


def test_line_features_count():
    texts = [b"Good line.\n\nBAD!! LINE!! HERE!!", b"", b"re re re re re\nre re re re re\n"]
    codes = np.frombuffer(b"".join(texts), np.uint8)
    own, chars, lines = line_crf.line_features(codes, np.cumsum([0, *map(len, texts)]))
    assert lines.tolist() == [2, 0, 2] and chars.tolist() == [11, 19, 15, 15]
    assert own[:, 14].tolist() == [0, 0, 0, 1] and own[2, 12] == pytest.approx(0.8)


def test_thresholds_move_with_the_rows():
    """No rows: 0. A language with few rows is near that of all; with many, where its own labels part."""
    model = toxicity.train([np.zeros((1, toxicity.TABLES), np.uint16)] * 2, np.array([0, 1]), ["de", "en"])

    def thresholds(*rows):
        counts = np.zeros((2, 2 * toxicity.MOST_BINS, 2))
        for lang, logit, label, n in rows:
            counts[lang, int(logit * toxicity.BINS) + toxicity.MOST_BINS, label] += n
        toxicity.calibrate(model, counts)
        return model.thresholds.tolist()

    assert all(abs(t) < 0.2 for t in thresholds())
    both = [(0, -5, 0, 1000), (0, 5, 1, 500)]
    de, en = thresholds(*both)
    assert -5 <= de <= 5 and abs(de - en) < 2
    _, near = thresholds(*both, (1, 1, 0, 2), (1, 9, 1, 1))
    _, far = thresholds(*both, (1, 6, 0, 3000), (1, 9, 1, 2000))
    assert near < 6 and 6 <= far <= 9
