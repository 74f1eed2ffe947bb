import hashlib
import random

import numpy as np
import pytest

from notemask.llm import repeats


def brute(rows):
    order = lambda d: -(1 << 63) if d is None else d
    first: dict[bytes, int] = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            s = b[i : i + 50]
            first[s] = min(first.get(s, order(d)), order(d))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < order(d):
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def check(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in repeats.repeated_spans(docs).drop("removed").collect()]
    assert sorted(got, key=repr) == brute(rows)


def passages():
    random.seed(2)
    words = ["alpha", "be", "gamma", "dé", "of", "the", "x"]
    passage = [" ".join(random.choice(words) for _ in range(40)) for _ in range(6)]
    rows = []
    for i in range(120):
        parts = [random.choice([random.choice(passage), " ".join(random.choice(words) for _ in range(30))]) for _ in range(3)]
        text = " ".join(parts)
        if i % 7 == 0:  # a cut copy of another text
            text = rows[-1][1][random.randint(0, 40) :] if rows else text
        rows.append((i * 3 % 121, text))
    return [*rows, (500, "ab" * 300), (501, "ab" * 200 + "c" * 100), (502, "c" * 50), (503, "c" * 49)]


def test_equals_brute_force(documents):
    check(documents(passages()))


@pytest.mark.parametrize("size", [64, 500])
def test_many_chunks_and_pieces(documents, monkeypatch, size):
    for name, value in (("CHUNK", 2000), ("PER_BUCKET", 3000), ("SLICE", size), ("_SORTED", 100)):
        monkeypatch.setattr(repeats, name, value)
    check(documents(passages()))


def test_odd_rows(odd, documents):
    check(odd)
    check(documents([(None, "z" * 60), (1, "y" + "z" * 60), (1, "z" * 55), (2, "z" * 50)]))
    assert repeats.repeated_spans(odd.limit(0)).count() == 0


def test_a_hot_trigger_in_many_tasks(documents, monkeypatch):
    """A passage that meets each document's own text: no task may hold all phrases of its last trigger."""
    for name, value in (("CHUNK", 2000), ("PER_BUCKET", 3000), ("_SORTED", 200)):
        monkeypatch.setattr(repeats, name, value)
    random.seed(5)
    own = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    passage, twice = own(60), own(90)
    rows = [(i, own(40) + passage + own(60) + (twice + passage + own(9)) * (i % 3)) for i in range(100)]
    rows += [(None, passage + own(20)), (7, passage + own(20)), (300, rows[50][1][30:])]
    groups = []
    compare = repeats._dictionary_spans
    monkeypatch.setattr(repeats, "_dictionary_spans", lambda rest: groups.append(most_windows(rest)) or compare(rest))
    dealt = []
    deal = repeats._dealt
    monkeypatch.setattr(repeats, "_dealt", lambda hot: dealt.append(hot) or deal(hot))
    check(documents(rows))
    assert groups[0] > 200 and dealt and all(n > 1 for n in dealt[0].values())


def most_windows(rest):
    return max(r["sum(windows)"] for r in rest.groupBy("bucket").sum("windows").collect())


def test_windows_that_meet_again():
    text = np.frombuffer(b"".join([PASSAGE, b"1", PASSAGE[:60], b"-" * 300]), np.uint8)
    at = np.arange(len(text) - 49)
    windows = [bytes(text[i : i + 50]) for i in at]
    want = [i for i, w in enumerate(windows) if windows.count(w) > 1]
    assert repeats._met_again(text, at).tolist() == want


PASSAGE = bytes(random.Random(3).choices(b"abcdefgh ", k=200))


def test_a_long_run_of_one_letter(documents):
    check(documents([(1, "x" * 30 + "-" * 20_000), (2, "-" * 9_000 + "y"), (3, "-" * 49)]))
