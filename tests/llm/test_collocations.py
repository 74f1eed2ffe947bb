import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from notemask.llm import collocations

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, least, most=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    found = {x: a for x, a in f.items() if a >= least and len(x[1]) > 1}
    out = []
    for (lang, words), a in found.items():
        cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        longer = [b for (m, v), b in found.items() if m == lang and len(v) > len(words) and f" {' '.join(words)} " in f" {' '.join(v)} "]
        if not any(b >= a for b in longer):
            out.append((lang, " ".join(words), a, f[lang, words[:k]], f[lang, words[k:]], n[lang], score))
    ranked = []
    for lang in {x[0] for x in out}:
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:most]
        ranked += [(lang, i + 1, *x[1:]) for i, x in enumerate(own)]
    return sorted(ranked)


def check(docs, least, most=2000):
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    wanted = brute(rows, least, most)
    got = sorted(tuple(r) for r in collocations.collocations(docs, least, most=most).collect())
    assert got == wanted
    return wanted


def spoken(seed, n=150):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "Ä", "日本", "x-y", "rare1", "a" * 40]
    phrases = ["state of the art", "new york city hall opened", "of of of of", "in other words"]
    rows = []
    for i in range(n):
        parts = [rng.choice(phrases) if rng.random() < 0.4 else " ".join(rng.choices(words, k=rng.randint(0, 5))) for _ in range(8)]
        parts += [f"own{i} of{i % 40}"]
        rows.append((i, rng.choice([", ", ". ", " ", "\t", "!\r\n", " \x0b"]).join(parts)))
    return rows


@pytest.mark.parametrize("size", [1 << 20, 60])
def test_equals_brute_force(documents, monkeypatch, size):
    monkeypatch.setattr(collocations, "SHARD_WORDS", size)
    monkeypatch.setattr(collocations, "SLICE", size * 4)
    monkeypatch.setattr(collocations, "PER_RANGE", size * 10)
    docs = documents(spoken(1), lang="en").unionByName(documents(spoken(2), lang=None)).unionByName(documents(spoken(3, 40), lang="und"))
    assert len(check(docs, 8)) > 50
    check(docs, 3, most=7)


def test_odd_rows(odd, documents):
    check(odd, 1)
    check(odd, 2)
    check(documents([(1, "a " * 300), (1, "a " * 300), (None, "b, " * 40)]), 5)
    check(documents([(1, " ".join(f"w{i % 700}" for i in range(70_000))), (2, "x")]), 50)
    assert collocations.collocations(odd.limit(0)).count() == 0


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_shorter_limits(documents, longest):
    docs = documents(spoken(6, 80))
    _, counts = collocations.phrase_counts(docs, 8, longest)
    _, every = collocations.phrase_counts(docs, 8)
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, every.filter(F.col("words") <= longest).collect()))


def test_values_that_collide(documents, monkeypatch):
    """Phrases that share the value by which they are pruned are told apart by their words."""
    monkeypatch.setattr(collocations, "_places", lambda h, ranges: h % np.uint64(5))
    check(documents(spoken(5, 60)), 8)


def test_counts_that_are_sent():
    counts = np.array([1, 300, 99, 100])
    sent = collocations._values(0, np.arange(4, dtype=np.uint64), counts, 1, 100)
    assert list(sent.column("counts")[0].as_py()) == [1, 100, 99, 100]
    assert np.cumsum(collocations._restored(sent.column("values")[0].as_py())).tolist() == [0, 1, 2, 3]
    sent = collocations._values(0, np.arange(4, dtype=np.uint64), counts, 1, 400)
    assert np.frombuffer(sent.column("counts")[0].as_py(), np.uint32).tolist() == counts.tolist()


def test_scores_beyond_64_bits(spark):
    sizes = spark.createDataFrame([("en", 10**13)], "lang string, n long")
    counts = [("en", "a", 3 * 10**12, 1), ("en", "b", 7 * 10**11 + 1, 1), ("en", "a b", 6 * 10**11, 2)]
    counts = spark.createDataFrame(counts, "lang string, phrase string, f long, words int")
    row = collocations.scored(sizes, counts).first()
    assert row.score == 1000 * 6 * 10**11 * 10**13 // (3 * 10**12 * (7 * 10**11 + 1))


@pytest.mark.parametrize("n_symbols", [2, 5, 70_000])
def test_intervals_hold_every_place(n_symbols):
    rng = np.random.default_rng(n_symbols)
    row = np.concatenate([[0], rng.integers(0, n_symbols, 400) % rng.choice([3, n_symbols], 400), [0]])
    index = collocations.FmIndex.of(row, n_symbols)
    symbols = np.unique(row[row > 0])
    of, phrases = index.words(symbols), [(int(s),) for s in symbols]
    for k in range(2, collocations.LONGEST + 1):
        low, which = index.left(of)
        grown, begins, symbol = index.right(of)
        longer = [(*phrases[w], int(s)) for w, s in zip(begins, symbol, strict=True)]
        places = Counter(tuple(row[i : i + k].tolist()) for i in range(len(row) - k + 1))
        places = {x: n for x, n in places.items() if 0 not in x}
        assert dict(zip(longer, grown.size.tolist(), strict=True)) == places
        assert set(grown.low.tolist()) <= set(low.tolist())
        of, phrases = grown, longer
