"""Document quality from lines: a linear-chain conditional random field labels every line good or bad.

Features describe a line and its two neighbours. Marginals of the forward-backward algorithm, weighted by line length,
give the quality of a document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bytes_of, held_out, labelled_sample, releasing, sigmoid, slices, table

#: Fold of the labelled rows that nothing is learnt from.
MODULUS, FOLD = 3, 1
#: Bound of the training sample: rows of each label, and bytes of a text.
PER_CLASS, MAX_BYTES = 3000, 1 << 20
#: Bytes of text whose features are computed at once in a task.
SLICE = 1_000_000

STEPS, RATE, PENALTY = 150, 0.1, 1e-3

#: Byte classes that are counted in each line.
_CLASSES = {
    "symbol": "#*$%&|<>^~@_=+\\/{}[]",
    "shout": "!?",
    "stop": ".,;:",
    "pipe": "|",
    "digit": "0123456789",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "blank": " \t\n\r\x0b\x0c",
}
_FLAGS = {k: np.isin(np.arange(256), np.frombuffer(v.encode(), np.uint8)).astype(np.uint8) for k, v in _CLASSES.items()}
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

N_OWN = 16


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64."""
    base, inverse = int(_BASE), pow(int(_BASE), -1, 1 << 64)
    up, down = np.full(n + 1, base, np.uint64), np.full(n + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def line_features(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line with a word, its length in bytes, and how many such lines each document has.

    `codes` are the bytes of the documents in a row, `at` where each begins, with the end. A line ends at a line feed
    or with its document.
    """
    n_docs = len(at) - 1
    if not len(codes):
        return np.zeros((0, N_OWN), np.float32), np.zeros(0), np.zeros(n_docs, np.int64)
    breaks = np.flatnonzero(codes == 10) + 1
    starts = np.unique(np.concatenate([at[:-1], breaks]))
    starts = starts[starts < len(codes)]
    ends = np.append(starts[1:], len(codes))
    count = {k: np.add.reduceat(f[codes], starts, dtype=np.int64).astype(np.float64) for k, f in _FLAGS.items()}
    size = (ends - starts).astype(np.float64)
    high = np.add.reduceat((codes >= 0xC0).view(np.uint8), starts, dtype=np.int64)  # lead bytes
    trail = np.add.reduceat(((codes & 0xC0) == 0x80).view(np.uint8), starts, dtype=np.int64)
    chars = size - trail
    visible = chars - count["blank"]
    # words, their hashes, and whether a word equals the one or two before it
    blank = _FLAGS["blank"][codes].astype(bool)
    first = ~blank
    opens = np.zeros(len(codes) + 1, bool)
    opens[at] = True
    first[1:] &= blank[:-1] | opens[1:-1]
    word_at = np.flatnonzero(first)
    up, down = _powers(len(codes))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) * (~blank) + (~blank)) * up[: len(codes)])])
    word_end = np.append(word_at[1:], len(codes))
    hashes = (prefix[word_end] - prefix[word_at]) * down[word_at] if len(word_at) else np.zeros(0, np.uint64)
    line_of = np.searchsorted(starts, word_at, "right") - 1
    words = np.bincount(line_of, minlength=len(starts)).astype(np.float64)
    near = np.zeros(len(word_at), bool)
    for lag in (1, 2):
        near[lag:] |= (hashes[lag:] == hashes[:-lag]) & (line_of[lag:] == line_of[:-lag])
    again = np.bincount(line_of, weights=near, minlength=len(starts))
    # words that occur earlier in their line
    mixed = (hashes ^ (line_of.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0xFF51AFD7ED558CCD)
    order = np.argsort(mixed, kind="stable")
    twice = np.zeros(len(mixed), bool)
    twice[order[1:]] = mixed[order[1:]] == mixed[order[:-1]]
    repeated = np.bincount(line_of, weights=twice, minlength=len(starts))
    doc_of = np.searchsorted(at, starts, "right") - 1
    # lines that occur earlier in their document
    line_hash = (prefix[ends] - prefix[starts]) * down[starts]
    key = np.stack([doc_of.astype(np.uint64), line_hash], axis=1)
    order = np.lexsort((key[:, 1], key[:, 0]))
    same = (key[order][1:] == key[order][:-1]).all(axis=1)
    twin = np.zeros(len(starts))
    twin[order[1:][same]] = 1
    per_char, per_word = 1 / np.maximum(visible, 1), 1 / np.maximum(words, 1)
    letters = count["upper"] + count["lower"] + high
    own = np.stack(
        [
            count["symbol"] * per_char, count["shout"] * per_char, count["stop"] * per_char, count["pipe"] * per_word,
            count["digit"] * per_char, count["upper"] / np.maximum(letters, 1), high * per_char, letters * per_char,
            (count["upper"] > 0.7 * letters) * (words > 2), (count["symbol"] > 0.3 * words) * (words > 2),
            visible * per_word / 10, np.log1p(words) / 5, again * per_word, repeated * per_word, twin,
            (again > 0.3 * words) * (words > 3),
        ],
        axis=1,
    ).astype(np.float32)
    keep = words > 0
    return own[keep], chars[keep], np.bincount(doc_of[keep], minlength=n_docs)


def with_neighbours(own: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """A constant and the features of each line, of the line before and of the line behind within the document."""
    n, width = own.shape
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    ends = np.cumsum(lines)
    some = lines > 0
    first[(ends - lines)[some]] = True
    last[ends[some] - 1] = True
    before, behind = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1]
    behind[:-1] = own[1:]
    before[first], behind[last] = 0, 0
    return np.concatenate([np.ones((n, 1), np.float32), own, before, behind], axis=1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of a line's features for the label good
    change: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # of neighbouring labels
    slope: float = 1.0
    shift: float = 0.0
    constant: float | None = None

    def marginals(self, x: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of good for each line, and expected counts of each pair of neighbouring labels."""
        return forward_backward(((x - self.mean) / self.scale) @ self.weights, self.change, lines)

    def raw(self, own: np.ndarray, chars: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Log-odds of each document's length-weighted share of good lines; even odds without lines."""
        good = self.marginals(with_neighbours(own, lines), lines)[0]
        doc = np.repeat(np.arange(len(lines)), lines)
        total = np.bincount(doc, weights=chars, minlength=len(lines))
        share = np.bincount(doc, weights=chars * good, minlength=len(lines)) / np.maximum(total, 1)
        share = np.clip(np.where(total > 0, share, 0.5), 1e-6, 1 - 1e-6)
        return np.log(share) - np.log1p(-share)

    def scores(self, own: np.ndarray, chars: np.ndarray, lines: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(lines), self.constant)
        return sigmoid(self.slope * self.raw(own, chars, lines) + self.shift)


def forward_backward(emission: np.ndarray, change: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All chains at once, a line of each at a time; chains are ordered by length, so that the open ones come first.

    `emission` is the score of good (bad has 0). Probabilities are scaled at each line, so chains can be of any length.
    """
    order = np.argsort(-lines, kind="stable")
    length = lines[order]
    begin = (np.cumsum(lines) - lines)[order]
    steps = int(length[0]) if len(length) else 0
    open_at = np.searchsorted(-length, -np.arange(steps), "left")  # chains longer than t
    t_matrix = np.exp(change - change.max())
    alpha = np.zeros((len(emission), 2))
    top = np.maximum(emission, 0)
    e = np.stack([np.exp(-top), np.exp(emission - top)], axis=1)
    for t in range(steps):
        i = begin[: open_at[t]] + t
        a = e[i] * (alpha[i - 1] @ t_matrix) if t else e[i]
        alpha[i] = a / a.sum(axis=1, keepdims=True)
    good = np.zeros(len(emission))
    pairs = np.zeros((2, 2))
    beta = np.ones((len(length), 2))
    for t in range(steps - 1, -1, -1):
        n = open_at[t]
        i = begin[:n] + t
        m = alpha[i] * beta[:n]
        m /= m.sum(axis=1, keepdims=True)
        good[i] = m[:, 1]
        if t:
            ahead = e[i] * beta[:n]
            joint = alpha[i - 1][:, :, None] * t_matrix * ahead[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            b = ahead @ t_matrix.T
            beta[:n] = b / b.sum(axis=1, keepdims=True)
    return good, pairs


def train(own: np.ndarray, chars: np.ndarray, lines: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> Model:
    """Every line of a training document has its document's label; gradient ascent on the chain's log-likelihood.

    Lines count by the share of their document, so that long documents don't rule. Without rows of both labels the
    score is the share of label 1, and 0.5 without any row."""
    x = with_neighbours(own, lines)
    model = Model(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]))
    if len(set(labels.tolist())) < 2 or not len(x):
        model.constant = float(labels.mean()) if len(labels) else 0.5
        return model
    model.mean[1:], model.scale[1:] = x[:, 1:].mean(axis=0), x[:, 1:].std(axis=0) + 1e-3
    z = (x - model.mean) / model.scale
    doc = np.repeat(np.arange(len(lines)), lines)
    gold = labels[doc].astype(np.float64)
    share = {c: 1 / max(1, (gold == c).sum()) for c in (0, 1)}
    line_weight = np.where(gold == 1, share[1], share[0]) / 2
    inner = np.maximum(lines - 1, 0)
    gold_pairs = np.diag([inner[labels == 0].sum(), inner[labels == 1].sum()]).astype(np.float64)
    m_w, v_w, m_c, v_c = np.zeros(z.shape[1]), np.zeros(z.shape[1]), np.zeros((2, 2)), np.zeros((2, 2))
    for step in range(1, STEPS + 1):
        good, pairs = forward_backward(z @ model.weights, model.change, lines)
        g_w = z.T @ ((gold - good) * line_weight) - PENALTY * model.weights
        g_c = (gold_pairs - pairs) / max(1, inner.sum()) - 0.05 * model.change
        for m, v, g, p in ((m_w, v_w, g_w, model.weights), (m_c, v_c, g_c, model.change)):
            m += 0.1 * (g - m)
            v += 0.001 * (g**2 - v)
            p += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    calibrate(model, model.raw(own, chars, lines), labels, weights)
    return model


def calibrate(model: Model, raw: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
    """Logistic calibration of the documents' log-odds, labels at their true shares; Newton steps with a weak prior."""
    r = raw / 4
    design = np.stack([r, np.ones_like(r)], axis=1)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(design @ theta)
        gradient = design.T @ (weights * (labels - p)) - 1e-2 * theta
        hessian = (design * (weights * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        theta += np.clip(np.linalg.solve(hessian, gradient), -2, 2)
    model.slope, model.shift = float(theta[0] / 4), float(theta[1])


def _features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    codes, at = bytes_of(column)
    for a, b in slices(np.diff(at), SLICE):
        yield a, b, *line_features(codes[at[a] : at[b]], at[a : b + 1] - at[a])


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of a bounded sample of labelled documents (see `labelled_sample`), fitted on the driver."""
    sample = labelled_sample(docs, labels, "quality", MODULUS, FOLD, PER_CLASS, MAX_BYTES)

    @releasing
    def lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["own", "chars", "lines", "label", "weight", "key"]
        for batch in batches:
            own, chars, lines = [], [], []
            for _, _, o, c, n in _features(batch.column("text")):
                cuts = np.cumsum(n)[:-1]
                own += [x.tobytes() for x in np.split(o, cuts)]
                chars += [x.tobytes() for x in np.split(c.astype(np.float64), cuts)]
                lines += n.tolist()
            arrays = [pa.array(own, pa.binary()), pa.array(chars, pa.binary()), pa.array(lines, pa.int64())]
            yield pa.RecordBatch.from_arrays([*arrays, *(batch.column(c) for c in names[3:])], names)

    keyed = sample.withColumn("key", F.xxhash64("doc_id")).select("text", "label", "weight", "key")
    rows = keyed.mapInArrow(lines_of, "own binary, chars binary, lines long, label int, weight double, key long").toArrow()
    rows = rows.sort_by([("key", "ascending"), ("own", "ascending")])
    return train(
        np.frombuffer(b"".join(rows.column("own").to_pylist()), np.float32).reshape(-1, N_OWN),
        np.frombuffer(b"".join(rows.column("chars").to_pylist()), np.float64),
        rows.column("lines").to_numpy(), rows.column("label").to_numpy().astype(np.int64), rows.column("weight").to_numpy(),
    )


def quality_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and good_chars (characters on lines likelier good than bad) of every row.

    Null, empty and blank texts have no lines: even odds before calibration. Repeated rows get repeated results; a
    null doc_id stays null; other columns don't matter."""

    @releasing
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, good = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for a, b, own, chars, lines in _features(batch.column("text")):
                scores[a:b] = model.scores(own, chars, lines)
                if model.constant is None:
                    likely = model.marginals(with_neighbours(own, lines), lines)[0] >= 0.5
                    doc = np.repeat(np.arange(b - a), lines)
                    good[a:b] = np.bincount(doc, weights=chars * likely, minlength=b - a).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array(good)], ["doc_id", "score", "good_chars"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, f"doc_id {kind}, score double, good_chars long")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score and verdict of every document."""
    docs = table(spark, sf_dir, "documents")
    scores = quality_scores(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scores.select(
        "doc_id", held_out(F.col("doc_id"), MODULUS, FOLD).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "good_chars",
    )
