"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of the rows that the word and its beginnings are hashed to, one table for each, so that
inflected forms of a known word are known too. Filters of several widths run over the word sequence and the largest
response of each filter over the whole text feeds a logistic output. Thresholds are calibrated for each language,
which is itself guessed from the words of the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, labelled_sample, release_memory, releasing, sigmoid, table, text_slices, texts

#: Fold of the labelled rows that nothing is learnt from.
MODULUS, FOLD = 5, 0
#: Bounds of the sample that the network is fitted on: rows of each label, and bytes of a text.
PER_CLASS, MAX_BYTES = 3000, 1 << 20
#: One in so many labelled rows is for the thresholds. Bins of a logit of 1 in their histogram and its half width, rows
#: that a language's counts are eased by, and the half width of the one row of each label that all counts are eased by.
CALIBRATED_IN, BINS, MOST_BINS, PRIOR, BASE = 4, 16, 512, 20.0, 4

#: Rows of an embedding table, below 2^16; the one after them is padding.
BUCKETS = (1 << 16) - 1
#: What of a word is hashed: all of it, and so many first letters.
BEGINNINGS = (0, 3, 4, 5, 6)
TABLES = len(BEGINNINGS)
DIM, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
LANG_BUCKETS = 1 << 12
EPOCHS, BATCH, RATE = 10, 64, 0.01
#: Bytes of text that are scored at once in a task.
SLICE = 250_000
#: Words that a task remembers the hashes of.
KNOWN_WORDS = 150_000

_WORDS = re.compile(r"\w+")
_OFFSETS = [(k, o) for k in WIDTHS for o in range(k)]
_PAD = max(WIDTHS) - 1


class Hashes(dict):
    """Table rows of each word as bytes, kept for as long as there are few."""

    def __missing__(self, word: str) -> bytes:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        rows = [xxhash.xxh64_intdigest(word[:n] if n else word, n) % BUCKETS for n in BEGINNINGS]
        value = self[word] = np.array(rows, np.uint16).tobytes()
        return value


def hashed_words(text: str, known: Hashes) -> np.ndarray:
    words = _WORDS.findall(text.lower())
    return np.frombuffer(b"".join(map(known.__getitem__, words)), np.uint16).reshape(-1, TABLES)


@dataclass
class Model:
    tables: np.ndarray  # TABLES, BUCKETS + 1, DIM; the last row is padding
    conv: np.ndarray  # DIM, offsets * FILTERS
    bias: np.ndarray  # widths * FILTERS
    out: np.ndarray  # widths * FILTERS
    out_bias: float
    lang_logs: np.ndarray  # LANG_BUCKETS, languages
    thresholds: np.ndarray  # by language
    constant: float | None = None  # score of everything where there was nothing to learn from

    def embedded(self, rows: np.ndarray) -> np.ndarray:
        return sum(self.tables[t][rows[:, t]] for t in range(TABLES))

    def logits(self, docs: list[np.ndarray]) -> np.ndarray:
        rows, starts, ends = layout(docs)
        return self.pooled(rows, starts, ends)[0] @ self.out + self.out_bias

    def pooled(self, rows, starts, ends):
        """Largest response of each filter in each document, after the rectifier; and the responses."""
        x = self.embedded(rows)
        y = x @ self.conv
        parts, at, n = [], 0, len(y)
        for k in WIDTHS:
            z = y[:, at : at + FILTERS].copy()
            for o in range(1, k):
                z[: n - o] += y[o:, at + o * FILTERS : at + (o + 1) * FILTERS]
            parts.append(z)
            at += k * FILTERS
        z = np.concatenate(parts, axis=1)
        cuts = np.stack([starts, ends], axis=1).ravel()
        peak = np.maximum.reduceat(z, cuts[:-1], axis=0)[::2] + self.bias  # behind the last end lies only padding
        return np.maximum(peak, 0), x, z, peak

    def scores(self, docs: list[np.ndarray]) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(docs), self.constant)
        return sigmoid(self.logits(docs) - self.thresholds[self.languages(docs)])

    def languages(self, docs: list[np.ndarray]) -> np.ndarray:
        """The likeliest language of each document by its words."""
        sums = [self.lang_logs[d[:, 0] % LANG_BUCKETS].sum(axis=0) for d in docs]
        return np.argmax(np.array(sums).reshape(len(docs), -1), axis=1)


def layout(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of all words, documents one behind the other with padding behind each; starts; ends of windows.

    A document without words is one padding row."""
    lengths = np.array([max(1, len(d)) for d in docs])
    starts = np.concatenate([[0], np.cumsum(lengths + _PAD)])[:-1]
    rows = np.full((int((lengths + _PAD).sum()), TABLES), BUCKETS, np.uint16)
    for d, s in zip(docs, starts.tolist(), strict=True):
        rows[s : s + len(d)] = d
    return rows, starts, starts + lengths


class Adam:
    def __init__(self, *shape: int):
        self.m, self.v, self.t = np.zeros(shape), np.zeros(shape), 0

    def step(self, gradient: np.ndarray, rate: float) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient**2
        return rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def train(docs: list[np.ndarray], labels: np.ndarray, langs: list[str | None], seed: int = 7) -> Model:
    """Fits the network; thresholds are 0 (see `fit`). Without rows of both labels the score is the share of label 1,
    and 0 without any row."""
    random = np.random.default_rng(seed)
    n_out = len(WIDTHS) * FILTERS
    model = Model(
        tables=random.normal(0, 0.1, (TABLES, BUCKETS + 1, DIM)).astype(np.float32),
        conv=random.normal(0, 0.3, (DIM, len(_OFFSETS) * FILTERS)).astype(np.float32),
        bias=np.full(n_out, -0.5, np.float32), out=np.full(n_out, 0.1, np.float32) * random.choice([-1, 1], n_out),
        out_bias=0.0, lang_logs=np.zeros((LANG_BUCKETS, 1)), thresholds=np.zeros(1),
    )
    model.tables[:, BUCKETS] = 0
    if len(set(labels.tolist())) < 2:
        model.constant = float(labels.mean()) if len(labels) else 0.0
        return model
    fit_languages(model, docs, langs)
    even = {c: len(docs) / (2 * (labels == c).sum()) for c in (0, 1)}
    opt = {"conv": Adam(*model.conv.shape), "bias": Adam(n_out), "out": Adam(n_out), "out_bias": Adam(1)}
    squares = np.full((TABLES, BUCKETS + 1), 1e-8)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        order = random.permutation(len(docs))
        for at in range(0, len(order), BATCH):
            _learn(model, [docs[i] for i in order[at : at + BATCH]], labels[order[at : at + BATCH]], even, opt, squares, rate)
    return model


def _learn(model: Model, docs, labels, even, opt, squares, rate) -> None:
    rows, starts, ends = layout(docs)
    pooled, x, z, peak = model.pooled(rows, starts, ends)
    error = (sigmoid(pooled @ model.out + model.out_bias) - labels) * np.where(labels == 1, even[1], even[0]) / len(docs)
    back = np.outer(error, model.out) * (peak > 0)
    d_conv = np.zeros_like(model.conv, dtype=np.float64)
    d_rows, d_vectors = [], []
    owner = np.repeat(np.arange(len(docs)), ends - starts + _PAD)
    for f in np.flatnonzero(np.abs(back).sum(axis=0) > 0):
        hits = np.flatnonzero(z[:, f] + model.bias[f] == peak[owner, f])
        hits = hits[hits < ends[owner[hits]]]
        who, first = np.unique(owner[hits], return_index=True)
        where, g = hits[first], back[who, f]
        w = f // FILTERS
        base = sum(WIDTHS[:w]) * FILTERS + f % FILTERS
        for o in range(WIDTHS[w]):
            column = base + o * FILTERS
            d_conv[:, column] += x[where + o].T @ g
            d_rows.append(where + o)
            d_vectors.append(g[:, None] * model.conv[:, column])
    model.out -= opt["out"].step(pooled.T @ error + 1e-4 * model.out, rate).astype(np.float32)
    model.out_bias -= float(opt["out_bias"].step(np.array([error.sum()]), rate)[0])
    model.conv -= opt["conv"].step(d_conv + 1e-5 * model.conv, rate).astype(np.float32)
    model.bias -= opt["bias"].step(back.sum(axis=0), rate).astype(np.float32)
    if d_rows:
        where, vectors = np.concatenate(d_rows), np.concatenate(d_vectors)
        for t in range(TABLES):
            ids, inverse = np.unique(rows[where, t], return_inverse=True)
            total = np.zeros((len(ids), DIM))
            np.add.at(total, inverse, vectors)
            total[ids == BUCKETS] = 0
            squares[t][ids] += (total**2).mean(axis=1)
            model.tables[t][ids] -= (5 * rate * total / np.sqrt(squares[t][ids])[:, None]).astype(np.float32)


def fit_languages(model: Model, docs: list[np.ndarray], langs: list[str | None]) -> None:
    """Word counts by language with add-one smoothing; a text's language is the one its words are likeliest in."""
    names = sorted({x for x in langs if x}) or [""]
    counts = np.ones((LANG_BUCKETS, len(names)))
    for d, name in zip(docs, langs, strict=True):
        if name:
            buckets = np.unique(d[:, 0] % LANG_BUCKETS)
            counts[buckets, names.index(name)] += 1
    model.lang_logs = np.log(counts / counts.sum(axis=0))
    model.thresholds = np.zeros(len(names))


def calibrate(model: Model, counts: np.ndarray) -> None:
    """For each language the threshold with the best F1, from counts of logits (language, bin, label).

    A language's counts are eased toward those of all languages, as if `PRIOR` rows more were spread like these, and
    those toward a threshold of 0, so that thresholds move with the rows however few there are."""
    bins = counts.shape[1]
    middle = (np.arange(bins) - bins // 2 + 0.5) / BINS
    base = np.stack([(middle < 0) & (middle > -BASE), (middle > 0) & (middle < BASE)], 1) / (BASE * BINS)
    overall = counts.sum(axis=0) + base
    for lang in range(len(model.thresholds)):
        eased = counts[lang] + PRIOR * overall / overall.sum()
        used = np.flatnonzero(eased.sum(axis=1))[::-1]
        true, every = np.cumsum(eased[used, 1]), np.cumsum(eased[used].sum(axis=1))
        f1 = 2 * true / (every + eased[:, 1].sum())
        k = int(np.argmax(f1))
        model.thresholds[lang] = (middle[used[k]] + middle[used[min(k + 1, len(used) - 1)]]) / 2


def for_thresholds(doc_id: Column) -> Column:
    """The fold of the labelled rows that thresholds are calibrated on; the network learns from the others."""
    return F.pmod(F.xxhash64(F.lit("thresholds"), doc_id), F.lit(CALIBRATED_IN)) == 0


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The network of a bounded sample of labelled documents (see `labelled_sample`), fitted on the driver, with
    thresholds from all labelled documents of a fold of their own, whose logits the tasks compute and count."""
    sample = labelled_sample(docs, labels.filter(~for_thresholds(F.col("doc_id"))), "toxic", MODULUS, FOLD, PER_CLASS, MAX_BYTES)

    @releasing
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for b in batches:
            words = pa.array([hashed_words(t, known).tobytes() for t in texts(b.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([words, *(b.column(c) for c in ("lang", "label", "key"))], ["words", "lang", "label", "key"])

    keyed = sample.withColumn("key", F.xxhash64("doc_id"))
    rows = keyed.mapInArrow(hashed, "words binary, lang string, label int, key long").toArrow()
    rows = rows.sort_by([("key", "ascending"), ("words", "ascending")])
    words = [np.frombuffer(x, np.uint16).reshape(-1, TABLES) for x in rows.column("words").to_pylist()]
    model = train(words, rows.column("label").to_numpy().astype(np.int64), rows.column("lang").to_pylist())
    del rows, words
    release_memory()  # the driver runs what comes next
    if model.constant is None:
        calibrate(model, logit_counts(model, docs, labels))
    return model


def logit_counts(model: Model, docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Labelled documents of the fold for thresholds by guessed language, bin of their logit, and label.

    Their texts are scored where they are read; only ids, bins and labels are shuffled."""

    @releasing
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for b in batches:
            for i, j, rows in text_slices(b.column("text"), SLICE):
                words = [hashed_words(t, known) for t in rows]
                bins = np.clip(np.floor(model.logits(words) * BINS), -MOST_BINS, MOST_BINS - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), pa.array(bins), pa.array(model.languages(words).astype(np.int32))],
                    ["doc_id", "bin", "guessed"],
                )

    fold = F.col("doc_id").isNotNull() & for_thresholds(F.col("doc_id")) & ~held_out(F.col("doc_id"), MODULUS, FOLD)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.filter(fold).select("doc_id", F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(measured, f"doc_id {kind}, bin int, guessed int")
    known = labels.filter(fold).select(F.col("doc_id").alias("of"), F.col("toxic").cast("int").alias("label"))
    found = scored.join(known.filter(F.col("label").isin(0, 1)).hint("merge"), F.col("doc_id") == F.col("of"))
    counts = np.zeros((len(model.thresholds), 2 * MOST_BINS, 2))
    for lang, bin_, label, n in found.groupBy("guessed", "bin", "label").count().collect():  # languages x bins x 2 at most
        counts[lang, bin_ + MOST_BINS, label] = n
    return counts


def batch_scores(model: Model, column: pa.Array, known: Hashes) -> np.ndarray:
    """Scores of a column of texts, a bounded number of bytes at a time; a long text is never cut."""
    found = [model.scores([hashed_words(t, known) for t in rows]) for _, _, rows in text_slices(column, SLICE)]
    return np.concatenate(found) if found else np.zeros(0)


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row. Null and empty texts get the score of a text without words; repeated rows get
    repeated results; a null doc_id stays null; other columns don't matter."""

    @releasing
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(batch_scores(model, b.column("text"), known), pa.float64())],
                ["doc_id", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, f"doc_id {kind}, score double")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows, with all their columns, whose score is below 0.5."""

    @releasing
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Hashes()
        for b in batches:
            yield b.filter(pa.array(batch_scores(model, b.column("text"), known) < 0.5))

    return docs.mapInArrow(keep, docs.schema)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    scores = toxicity_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scores.select(
        "doc_id", held_out(F.col("doc_id"), MODULUS, FOLD).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
