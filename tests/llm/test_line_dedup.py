import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from notemask.llm import line_dedup

BLANK = " \t\n\x0b\x0c\r"
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows):
    keys = [[x.strip(BLANK).translate(LOWER) for x in (t or "").split("\n")] for _, t in rows]
    order = lambda d: float("-inf") if d is None else d
    held, holder = Counter(), {}
    for (d, _), own in zip(rows, keys, strict=True):
        for k in {k for k in own if len(k) >= 20}:
            held[k] += 1
            holder[k] = max(holder.get(k, float("-inf")), order(d))
    out = []
    for (d, t), own in zip(rows, keys, strict=True):
        lines = (t or "").split("\n")
        kept = [x for x, k in zip(lines, own, strict=True) if held[k] < 3 or holder[k] == order(d)]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(monkeypatch, docs):
    monkeypatch.setattr(line_dedup, "table", lambda *_: docs)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in line_dedup.op13(docs.sparkSession, "").collect()), key=repr) == brute(rows)


def texts(seed=4, n=200):
    rng = random.Random(seed)
    lines = [f"Line number {i} of the licence, long enough" for i in range(60)]
    lines += ["short", "", " ", "exactly twenty chars", "only nineteen chars", "ÄÖÜ é 日本語 and so on, some more", "x" * 5000]
    out = []
    for i in range(n):
        own = [rng.choice(lines) for _ in range(rng.randint(0, 12))]
        own = [rng.choice([x, x.upper() if x.isascii() else x, f" \t{x}\r"]) for x in own]
        own += [f"own line of document {i}, nobody else's"] * rng.randint(0, 2)
        own += ["The line that every document holds"] * rng.randint(1, 2)
        rng.shuffle(own)
        out.append((i * 7 % 211, "\n".join(own)))
    return out


@pytest.mark.parametrize("block, shard", [(1 << 19, 1 << 19), (50, 40)])
def test_equals_brute_force(documents, monkeypatch, block, shard):
    monkeypatch.setattr(line_dedup, "BLOCK_KEYS", block)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", shard)
    check(monkeypatch, documents(texts()))


def test_odd_rows(odd, documents, monkeypatch):
    line = "a line of more than twenty characters"
    check(monkeypatch, odd)
    check(monkeypatch, documents([(None, line), (None, line + "\nx"), (None, line)]))  # the largest id is none at all
    check(monkeypatch, documents([(None, line), (3, line), (3, line), (3, line.upper()), (-5, line)]))  # ties, repeated rows
    check(monkeypatch, documents([(1, line), (2, line)]))
    check(monkeypatch, documents([(1, f"{line}\n" * 20_000 + "end"), (2, line), (9, f"\n{line}\n")]))
    assert line_dedup.without_repeated_lines(odd.limit(0)).count() == 0


def test_other_columns_stay(odd):
    names = odd.withColumnsRenamed({"key": "row", "score": "drop", "size": "rest", "n": "n_lines"})
    found = line_dedup.without_repeated_lines(names)
    assert found.columns == ["doc", "n_lines", "n_dropped"]
    before = sorted((repr(r.asDict() | {"text": r.text or ""}) for r in names.collect()))
    assert sorted(repr(r.doc.asDict()) for r in found.collect()) == before


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    hi, lo = rng.integers(0, 1 << 63, (2, n)).astype(np.uint64)
    perfect = line_dedup.PerfectHash.of(hi, lo)
    assert sorted(perfect.slots(hi, lo).tolist()) == list(range(n))
    assert perfect.starts[-1] <= 64 * 40 + 8 * n  # a few bits for each key
