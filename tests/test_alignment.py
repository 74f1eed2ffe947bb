import itertools
import random

from notemask.operators.alignment import common_tokens, hunks, token_diff
from notemask.plans import fixtures as fx
from notemask.plans.pipeline import annotate_notes, diffs_of_rejects


def longest(a, b):
    """Length of a longest common subsequence by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
    return row[-1]


def replayed(before, found):
    """The later list from the earlier one and the stretches."""
    out, at = [], 0
    for i, j, dropped, inserted in found:
        out += before[at:i]
        assert len(out) == j and before[i : i + len(dropped)] == dropped
        out += inserted
        at = i + len(dropped)
    return out + before[at:]


def check(a, b, bits):
    met = common_tokens(a, b, bits)
    assert all(a[i] == b[j] for i, j in met)
    assert all(i < k and j < n for (i, j), (k, n) in itertools.pairwise(met))
    assert len(met) == longest(a, b)
    found = hunks(a, b, bits)
    assert replayed(a, found) == b
    assert all(dropped or inserted for _, _, dropped, inserted in found)


def test_alignment_equals_brute_force():
    rng = random.Random(5)
    for k in range(600):
        words = "abcdefghijklmnop"[: rng.choice([1, 2, 3, 16])]
        a, b = ([rng.choice(words) for _ in range(rng.randrange(0, 40))] for _ in range(2))
        if k % 3 == 0:  # an edited copy
            b = [w for w in a if rng.random() > 0.2]
        for bits in (1, 40, 1 << 28):
            check(a, b, bits)
    check([], [], 1)
    check(["a"], [], 1)
    check([], ["a"], 1)


def test_long_lists_are_cut_at_their_middle():
    rng = random.Random(6)
    a = [str(rng.randrange(500)) for _ in range(60_000)]
    b = [w for w in a if rng.random() > 0.01]
    met = common_tokens(a, b, 1 << 24)
    assert len(met) == len(b) and [a[i] for i, _ in met] == b
    assert replayed(a, hunks(a, b, 1 << 24)) == b


def test_diff_of_rows(spark):
    rows = [(1, "a b c", "a X c"), (2, "same", "same"), (3, None, "new words"), (4, "gone", ""), (None, "a b", "b"), (1, "a b c", "a X c"), (6, None, None)]
    got = token_diff(spark.createDataFrame(rows, "`my id` long, x string, y string"), "x", "y", "my id")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(
        map(
            str,
            [
                (1, 1, 1, ["b"], ["X"]), (1, 1, 1, ["b"], ["X"]), (3, 0, 0, [], ["new", "words"]),
                (4, 0, 0, ["gone"], []), (None, 0, 0, ["a"], []),
            ],
        )
    )
    assert got.limit(0).count() == 0
    # columns to keep may be the texts themselves, or none
    both = spark.createDataFrame([("p q", "q")], "x string, y string")
    assert [tuple(r) for r in token_diff(both, "x", "y", "x").collect()] == [("p q", 0, 0, ["p"], [])]
    assert [tuple(r) for r in token_diff(both, "x", "y").collect()] == [(0, 0, ["p"], [])]


def test_rejected_notes_get_a_diff(spark, sf_dir, seed_lexicon):
    notes = fx.notes(spark, sf_dir).unionByName(
        spark.createDataFrame([(-5, "call 'it' Sarah ' now"), (-6, None)], "doc_id long, text string")
    )
    rejected = annotate_notes(notes, seed_lexicon, columns=["cleaned", "sizes", "reject_reason"])
    rejected = {r.doc_id: r for r in rejected.filter("reject_reason = 'size_mismatch'").collect()}
    assert -5 in rejected
    found = {}
    for r in diffs_of_rejects(notes, seed_lexicon).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) == set(rejected)
    for doc_id, rows in found.items():
        own, sizes = sorted(rows, key=lambda r: (r.at_before, r.at_after)), rejected[doc_id].sizes
        after = replayed(rejected[doc_id].cleaned.split(" "), [(r.at_before, r.at_after, r.dropped, r.inserted) for r in own])
        assert len(after) == sizes.length_labels
        assert sum(r.shift for r in own) == sizes.length_labels - sizes.length_text != 0
        assert all(r.shift == len(r.inserted) - len(r.dropped) for r in own)
