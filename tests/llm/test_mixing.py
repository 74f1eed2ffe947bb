import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from notemask.llm import mixing


def water(sizes, weights=(1, 2, 3), most=3):
    """Targets by repeated resharing."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else rest * weight[s] / free for s in names}
        over = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not over:
            return target
        capped |= over


def checked(docs):
    rows = mixing.mix(mixing.sized_documents(docs)).collect()
    assert len(rows) == docs.count()
    texts = Counter((r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect())
    assert Counter((r.doc_id, r.size) for r in rows) == texts
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r["size"]
    want = water(sizes) if rows else {}
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert taken[s] == int(want[s] + 1e-6)  # the budget is met exactly
    return rows


def test_targets_and_budgets(documents):
    source = {i: "abcdefgh"[i % 5] if i % 3 else ("big" if i % 2 else None) for i in range(1, 200)}
    docs = documents([(i, "w " * (i * 7 % 50)) for i in range(1, 200)], source=source)
    rows = checked(docs)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.mix(mixing.sized_documents(docs.repartition(7))).collect()), key=repr)


def test_ranges_change_nothing(documents):
    sized = mixing.sized_documents(documents([(i, "w " * (i % 9)) for i in range(100)], source={i: "ab"[i % 2] for i in range(100)}))
    few, many = ({(r.doc_id, r.taken) for r in mixing.mix(sized, digits=d).collect()} for d in (1, 3))
    assert few == many


def test_odd_rows(odd):
    checked(odd)
    assert mixing.mix(mixing.sized_documents(odd.limit(0))).count() == 0
    assert mixing.mixed_documents(odd.limit(0)).count() == 0


def test_one_source_without_words(documents):
    rows = checked(documents([(1, ""), (2, None)]))
    assert all(r.target == 0 and r.taken == 0 for r in rows)


def test_mixed_documents_have_the_taken_words(documents):
    docs = documents([(i, f" w{i}  x\ty\n" * (1 + i % 4)) for i in range(40)], source={i: "abc"[i % 3] if i % 5 else "d" for i in range(40)})
    plan = {r.doc_id: r.taken for r in mixing.mix(mixing.sized_documents(docs)).collect()}
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in mixed.collect():
        got[r.doc_id] += len(r.text.split())
        assert texts[r.doc_id].startswith(r.text)
    assert got == Counter({d: n for d, n in plan.items() if n})


def test_rows_that_agree_are_taken_in_turn(documents):
    """Null ids of one size and repeated rows: every source gives its budget exactly, and reruns agree."""
    rows = [(None, f"a{i % 40} b c d e") for i in range(300)] + [(7, "same text of five words")] * 30 + [(8, f"x y z {i % 3}") for i in range(30)]
    docs = documents(rows)
    frames = [docs.filter("doc_id IS NULL").withColumn("source", F.expr("element_at(array('a', 'b', 'c'), int(hash(text) % 3 + 3) % 3 + 1)"))]
    frames.append(docs.filter("doc_id IS NOT NULL"))
    docs = frames[0].unionByName(frames[1])
    words = lambda t: len(t.split())
    sizes = Counter()
    for r in docs.collect():
        sizes[r.source] += words(r.text)
    taken = Counter()
    mixed = mixing.mixed_documents(docs).collect()
    for r in mixed:
        taken[r.source] += words(r.text)
    assert taken == Counter({s: int(t + 1e-6) for s, t in water(sizes).items()})
    again = mixing.mixed_documents(docs.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, mixed))


def test_three_sources_without_ids(documents):
    docs = [documents([(None, f"{s} {i} x y z") for i in range(100)], source=None).drop("source").withColumn("source", F.lit(s)) for s in "abc"]
    docs = docs[0].unionByName(docs[1]).unionByName(docs[2])
    taken = Counter()
    for r in mixing.mixed_documents(docs).collect():
        taken[r.source] += len(r.text.split())
    assert taken == {"a": 250, "b": 500, "c": 750}
