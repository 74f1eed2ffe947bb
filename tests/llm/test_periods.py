import hashlib
import random
import zlib

import numpy as np
import pytest

from notemask.llm import periods


def brute_runs(words):
    """Every maximal stretch of each period, kept under its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= 12:
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def brute(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    if doc_id is not None and words:
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    most = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    shown = (*most, 1000 * most[1] // most[2]) if most else (None,) * 4
    return (doc_id, len(runs), *shown, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def found(texts):
    documents = sorted(([w.encode() for w in t] for t in texts), key=len, reverse=True)
    w, lengths = periods._row(documents)
    runs = periods.runs_of(w, lengths)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])
    out = []
    for k, words in enumerate(documents):
        own = runs[(runs[:, 0] >= begins[k]) & (runs[:, 0] < begins[k + 1])] - [begins[k], begins[k], 0]
        out.append((sorted((s, e - s, q) for s, e, q in own.tolist()), brute_runs(words)))
    return out


def structured(rng):
    """Words with runs inside runs: powers of powers, broken and joined."""
    parts = ["a"]
    for _ in range(rng.randint(1, 6)):
        kind = rng.randint(0, 4)
        if kind == 0:
            parts = parts * rng.randint(2, 5)
        elif kind == 1:
            parts = parts + [rng.choice("abcd") for _ in range(rng.randint(1, 9))]
        elif kind == 2:
            parts = parts[rng.randint(0, len(parts) // 2) :] + parts
        elif kind == 3:
            parts = parts + parts[: rng.randint(1, len(parts))]
        else:
            parts = list(rng.choices("ab", k=rng.randint(1, 30))) + parts
        parts = parts[:700]
    return parts


@pytest.mark.parametrize("seed", range(12))
def test_equals_brute_force(seed):
    rng = random.Random(seed)
    texts = [structured(rng) for _ in range(40)]
    texts += [[rng.choice("ab") for _ in range(rng.randint(0, 300))] for _ in range(10)]
    for got, wanted in found(texts):
        assert got == wanted


def test_regions_that_meet():
    """Squares across the place where two highly periodic regions meet: no position of a set lies in them."""
    for root in ("ab", "abc", "aab", "abcde"):
        for m in (30, 61, 100):
            words = list(root * m)[: 2 * m + 1]
            for got, wanted in found([words + words, words[1:] + words, words * 3 + ["z"] + words]):
                assert got == wanted


def test_long_periods():
    rng = random.Random(1)
    block = [str(rng.random()) for _ in range(900)]
    for got, wanted in found([block * 2 + block[:7], ["x"] + block + block[:-1], block[:333] * 3]):
        assert got == wanted


def test_query_rows(documents, odd, monkeypatch, spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, " \n".join(structured(rng)[:300])) for i in range(150)] + [(None, "a " * 40), (7, "b c " * 50), (7, "b c " * 50)]
    monkeypatch.setattr(periods, "SLICE", 2000)
    for docs in (documents(rows), odd, odd.limit(0)):
        monkeypatch.setattr(periods, "table", lambda *_, docs=docs: docs)
        got = [tuple(r) for r in periods.op12(spark, "").collect()]
        wanted = [brute(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert sorted(got, key=repr) == sorted(wanted, key=repr)


def test_a_very_long_text(documents):
    text = "one two three " * 100_000 + "x y " * 100_000
    row = periods.periodic_runs(documents([(1, text)])).first()
    assert [tuple(r) for r in row.runs] == [(0, 300_000, 3), (300_000, 200_000, 2)] and row.collapsed == "one two three x y"
