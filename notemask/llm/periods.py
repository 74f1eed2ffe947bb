"""Periodic runs of words, by string synchronising sets.

A run is a maximal stretch of words with smallest period q that is at least twice as long as q. A task lays the words
of many documents in a row, as numbers, with a number of its own between two documents.

* Periods below `SMALL` come from comparing the row with itself, shifted. They also are the highly periodic regions.
* For t = 4, 8, 16, ... a synchronising set holds the positions whose window of t words, or the window t words later,
  has the least hash among the windows that begin in between. Windows inside a region of period t/3 or less don't count.
  Whether a position belongs to the set depends on the 2t words from it alone, so a run of period q in [3t, 6t) holds
  two positions q apart with equal contexts of 2t words. Equal contexts lie more than t/3 apart; so each position has a
  bounded number of partners at a distance in that range, and every such distance is proposed as a period.
* A run whose period is itself highly periodic may hold no such position. Then it lies across the place where two regions
  of one small period p meet, and its period is the distance of two equal places in them, plus a multiple of p.

Proposals are checked and extended by comparing words, so hashes only choose what to look at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, releasing, slices, table

#: Periods below this come from shifted comparison; 3 times the first scale.
SMALL, FIRST_SCALE = 12, 4
#: A run has at least this many words.
LEAST = 12
#: Bytes of text whose words a task lays in a row.
SLICE = 1 << 20

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scattered 64-bit values, one for each value."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _doubled(h: np.ndarray, t: int) -> np.ndarray:
    """Hashes of windows of 2t words from those of t words."""
    return _mixed(h[:-t] * np.uint64(3) + (h[t:] ^ (h[t:] >> np.uint64(31))))


def _stretches(places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each stretch of consecutive numbers in an ascending list."""
    cut = np.flatnonzero(np.diff(places) > 1)
    first = places[np.concatenate([[0], cut + 1])]
    return first, places[np.concatenate([cut, [len(places) - 1]])]


def _shifted(w: np.ndarray) -> list[np.ndarray]:
    """Stretches of period below SMALL at least twice as long, as rows of start, end, period."""
    found = []
    for q in range(1, min(SMALL, len(w))):
        places = np.flatnonzero(w[:-q] == w[q:])
        if len(places):
            first, last = _stretches(places)
            long = last - first + 1 >= q
            first, end = first[long], last[long] + 1 + q
            found.append(np.stack([first, end, np.full(len(first), q, np.int64)], 1))
    return found


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning of two rows of equal length."""
    at, step = 0, 64
    while at < len(a):
        differs = a[at : at + step] != b[at : at + step]
        k = int(differs.argmax())
        if differs[k]:
            return at + k
        at, step = at + step, min(step * 2, 1 << 16)
    return len(a)


def _extended(w: np.ndarray, i: int, q: int) -> tuple[int, int]:
    """Start and end of the longest stretch of period q around the words i and i + q."""
    right = _agreeing(w[i : len(w) - q], w[i + q :])
    left = _agreeing(w[:i][::-1], w[q : i + q][::-1])
    return i - left, i + right + q


def _least_of_window(h: np.ndarray, t: int) -> np.ndarray:
    """For each place, the least of the t + 1 values from it."""
    least, width = h, 1
    while width < t:
        least, width = np.minimum(least[:-width], least[width:]), width * 2
    return np.minimum(least[: len(h) - t], h[t:])


def synchronising(h: np.ndarray, t: int, regions: np.ndarray) -> np.ndarray:
    """Positions of the set at scale t, from hashes of windows of t words and the runs known so far."""
    n = len(h)
    inside = regions[(regions[:, 2] * 3 <= t) & (regions[:, 1] - regions[:, 0] >= t) & (regions[:, 1] - t < n)]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, inside[:, 0], 1)
    np.add.at(change, inside[:, 1] - t + 1, -1)
    h = np.where(np.cumsum(change[:-1]) > 0, _NONE, h)
    least = _least_of_window(h, t)
    return np.flatnonzero((least != _NONE) & ((h[: n - t] == least) | (h[t:] == least)))


def _by_context(h: np.ndarray, h2: np.ndarray, t: int, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places i and periods q in [3t, 6t) such that i and i + q are in the set, with equal contexts of 2t words."""
    places = synchronising(h, t, regions)
    places = places[places < len(h2)]
    contexts = h2[places]
    order = np.argsort(contexts, kind="stable")
    places, contexts = places[order], contexts[order]
    firsts, periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    k = 1
    while k < len(places):
        apart = places[k:] - places[:-k]
        near = (contexts[k:] == contexts[:-k]) & (apart < 6 * t)
        if not near.any():
            break
        chosen = np.flatnonzero(near & (apart >= 3 * t))
        firsts.append(places[chosen])
        periods.append(apart[chosen])
        k += 1
    i, q = np.concatenate(firsts), np.concatenate(periods)
    return _long_enough(h, i, q, t)


def _long_enough(h: np.ndarray, i: np.ndarray, q: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaves out proposals whose stretch ends too early for two periods, by windows of t words on both sides."""
    windows = np.full(len(i), 2, np.int64)
    for side, steps in ((1, range(2, 7)), (-1, range(1, 6))):
        alive = np.ones(len(i), bool)
        for k in steps:
            a = i + side * k * t
            alive &= (a >= 0) & (a + q < len(h))
            at = np.flatnonzero(alive)
            alive[at] = h[a[at]] == h[a[at] + q[at]]
            windows += alive
    far = (windows + 2) * t > q
    return i[far], q[far]


def _across(w: np.ndarray, t: int, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proposals of periods in [3t, 6t) where two regions of one period of t/3 or less meet."""
    long = regions[(regions[:, 2] >= 2) & (regions[:, 2] * 3 <= t) & (regions[:, 1] - regions[:, 0] >= 3 * t)]
    long = long[np.lexsort((long[:, 0], long[:, 2]))]
    firsts, periods = [], []
    for (s1, e1, p), (s2, e2, p2) in zip(long[:-1].tolist(), long[1:].tolist(), strict=True):
        if p != p2 or not e1 - p < s2 <= e1:
            continue
        last, root = w[e1 - 2 * p + 1 : e1].tobytes(), w[s2 : s2 + p].tobytes()
        at = last.find(root)
        while at >= 0 and at % w.itemsize:
            at = last.find(root, at + 1)
        if at < 0:
            continue
        offset = (s2 - (e1 - 2 * p + 1 + at // w.itemsize)) % p
        q = np.arange(3 * t + (offset - 3 * t) % p, 6 * t, p)
        first = np.maximum(s1, s2 - q)
        fits = first <= np.minimum(e1 - q, e2 - 2 * q)
        firsts.append(first[fits])
        periods.append(q[fits])
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(firsts or empty), np.concatenate(periods or empty)


def _smallest(found: np.ndarray) -> np.ndarray:
    """One row for each stretch, with its smallest period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    return found[np.concatenate([[True], (np.diff(found[:, :2], axis=0) != 0).any(1)])] if len(found) else found


def runs_of(w: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Runs in a row of documents as rows of start, end, period. `lengths` are those of the documents, longest
    first; each document is followed by a number that occurs nowhere else."""
    regions = _smallest(np.concatenate([np.zeros((0, 3), np.int64), *_shifted(w)]))
    h, t = _mixed(w.astype(np.uint64)), 1
    while t < FIRST_SCALE:
        h, t = _doubled(h, t), t * 2
    while True:
        documents = int((lengths >= 6 * t).sum())  # a run of period 3t has 6t words
        if not documents:
            break
        n = int(lengths[:documents].sum()) + documents
        w, h = w[:n], h[: n - t + 1]
        h2 = _doubled(h, t)
        pairs = (_by_context(h, h2, t, regions), _across(w, t, regions))
        i, q = (np.concatenate(x) for x in zip(*pairs, strict=True))
        found, before = [], (0, 0, 0)
        order = np.lexsort((i, q))
        for a, period in zip(i[order].tolist(), q[order].tolist(), strict=True):
            if period == before[2] and a + period < before[1]:
                continue  # within the stretch before
            before = (*_extended(w, a, period), period)
            if before[1] - before[0] >= 2 * period:
                found.append(before)
        if found:
            regions = _smallest(np.concatenate([regions, np.array(found, np.int64)]))
        h, t = h2, t * 2
    return regions[regions[:, 1] - regions[:, 0] >= np.maximum(LEAST, 2 * regions[:, 2])]


def _row(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words of all documents, each followed by one of its own; and the documents' lengths."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    lengths = np.array([len(words) for words in documents], np.int64)
    w = np.empty(int(lengths.sum()) + len(documents), np.int64)
    at = 0
    for i, words in enumerate(documents):
        w[at : at + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
        w[at + len(words)] = -1 - i
        at += len(words) + 1
    return w, lengths


def _repeats_only(runs: np.ndarray, n: int) -> np.ndarray:
    """Words that a run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


@releasing
def _periodic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, SLICE):
            part = batch.slice(a, b - a)
            data = part.column("text").cast(pa.binary()).to_pylist()
            words = [(x or b"").split() for x in data]  # bytes split at exactly the six blanks
            order = sorted(range(len(words)), key=lambda i: -len(words[i]))
            w, lengths = _row([words[i] for i in order])
            runs = runs_of(w, lengths)
            begins = np.concatenate([[0], np.cumsum(lengths + 1)])
            bounds = np.searchsorted(runs[:, 0], begins)
            n_runs, starts, spans, periods, kept = np.zeros(len(words), np.int64), [], [], [], []
            places = np.empty(len(words), np.int64)
            places[order] = np.arange(len(words))
            for i, k in enumerate(places.tolist()):
                own = runs[bounds[k] : bounds[k + 1]] - [begins[k], begins[k], 0]
                own = own[np.lexsort((own[:, 2], own[:, 0]))]
                n_runs[i] = len(own)
                if len(own):
                    gone = _repeats_only(own, len(words[i])).tolist()
                    kept.append(b" ".join([x for x, g in zip(words[i], gone, strict=True) if not g]))
                    starts.append(own[:, 0])
                    spans.append(own[:, 1] - own[:, 0])
                    periods.append(own[:, 2])
                else:
                    kept.append(b" ".join(words[i]))
            values = pa.StructArray.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (starts, spans, periods)],
                ["start", "length", "period"],
            )
            offsets = pa.array(np.concatenate([[0], np.cumsum(n_runs)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array([len(x) for x in words], pa.int64()),
                    pa.ListArray.from_arrays(offsets, values).cast(_RUNS),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, runs (array of start, length, period by start, then period), collapsed.

    Words are runs of anything but the six ASCII blanks, numbered from 0. A run is a stretch of at least 12 words with
    smallest period q, at least 2q long, that no neighbouring word extends. `collapsed` is the text without the words
    that some run contains after its first q, the others joined by one space. Null and empty texts have no words, no
    runs and an empty `collapsed`. Rows are taken as they come: repeated rows give repeated rows, a null doc_id stays
    null, other columns don't matter, an empty table gives an empty result. Nothing is shuffled; a task holds the words
    of about a megabyte of text, or of one longer text.
    """
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string"
    )
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_periodic, schema)


def with_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the documents, by CRC-32 of the id, repeat some of their words to their end.

    With h the CRC-32 of the decimal id and g = h / 10: if h is divisible by 10, each word i from a = g % n on becomes
    word a + (i - a) % p of the n original words, where p = 1 + (n - a) / (3 + g % 8). Other texts, also those without
    id, stay as they are.
    """
    h = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8"))
    words = F.regexp_extract_all(F.col("text"), F.lit(f"({WORD})"), F.lit(1))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumns({
        "h": h, "words": F.when(chosen, words)
    }).withColumns({"g": F.floor(F.col("h") / 10), "n": F.size("words")})
    rows = rows.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    again = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    periodic = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(again, F.lit(1), F.col("n") - F.col("a")))
    text = F.when(F.col("a").isNotNull(), F.array_join(periodic, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, the longest of them, and digests of all runs and of the text without repeats."""
    found = periodic_runs(with_periods(table(spark, sf_dir, "documents")))
    most = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p"), r["start"], r["period"]))
    )
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    ended = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("most", most).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "most.start", "most.length", "most.period",
        F.floor(1000 * F.col("most.length") / F.col("most.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.encode(ended, "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )
