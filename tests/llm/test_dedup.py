"""Exact and near duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from notemask.llm import components, exact_dedup, mixing, ngram_join

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def brute_exact(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), d is not None, d))
    out = []
    for norm, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        for k, m in enumerate(members):
            out.append((m[2], members[0][2], len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def check_exact(docs, size):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in exact_dedup.duplicates(docs, size).drop("key", "copies").collect()]
    assert sorted(got, key=repr) == brute_exact(rows)


def texts():
    random.seed(4)
    base = ["".join(random.choice("ab") for _ in range(random.randint(0, 90))) for _ in range(40)]
    rows = []
    for i in range(150):
        t = random.choice(base)
        rows.append((i, re.sub("(?<=a)b", " b", t) if random.random() < 0.5 else t))
    return [*rows, (900, "ab" * 40 + "c"), (901, "ab" * 40 + "d"), (902, "ab " * 40 + "c")]


@pytest.mark.parametrize("size", [1, 4, 16, 4096])
def test_exact_equals_brute_force(documents, size):
    check_exact(documents(texts()), size)


def test_exact_odd_rows(odd):
    check_exact(odd, 3)
    assert exact_dedup.duplicates(odd.limit(0)).count() == 0
    kept = exact_dedup.without_duplicates(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([None, 3, 4, 5, 6, 7])  # blanks outweigh null and empty


def test_hash_collisions_change_nothing(documents, monkeypatch):
    """Names come from contents: with a hash of four values the result is the same."""
    from pyspark.sql import functions as F

    true = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda *c: true(*c) if len(c) > 1 else F.pmod(true(*c), F.lit(4)))
    check_exact(documents(texts()), 4)


def shingles(text):
    w = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_near(rows):
    order = lambda d: -(1 << 63) if d is None else d
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or (both and 100 * both >= 80 * len(sets[i] | sets[j])):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), order(d)), order(d))
    back = lambda x: None if x == -(1 << 63) else x
    return sorted(((d, len(sets[i]), back(least[find(i)])) for i, (d, _) in enumerate(rows)), key=repr)


def check_near(docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.similar_documents(docs).collect()]
    assert sorted(got, key=repr) == brute_near(rows)


def near_texts():
    random.seed(6)
    word = lambda: random.choice("abcdefghijklmnop") + random.choice("aeiou") + random.choice("xyz")
    passage = " ".join(word() for _ in range(40))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(random.choice([3, 5, 8, 60, 200]))]
        for _ in range(random.choice([1, 2, 12])):
            copy = list(base)
            for _ in range(random.choice([0, 1, 2, 3])):  # about the threshold for short texts
                copy[random.randrange(len(copy))] = word()
            text = " ".join(copy)
            if random.random() < 0.3:
                text += " " + passage
            rows.append((n, text.upper() if random.random() < 0.2 else text))
            n += 1
    return [*rows, (n, "The Ä b c d"), (n + 1, "the Ä b c d"), (n + 2, "the ä b c d"), (n + 3, "one two"), (n + 4, "ONE\ttwo")]


def test_near_equals_brute_force(documents):
    check_near(documents(near_texts()))


def test_near_in_many_parts(documents, monkeypatch):
    for name, value in (("CAPACITY", 900), ("PER_BUCKET", 2000), ("CHAIN_EVERY", 3), ("FANOUT", 2)):
        monkeypatch.setattr(ngram_join, name, value)
    check_near(documents(near_texts()))


@pytest.mark.parametrize("speakers", [1, 8])
def test_near_in_parts_of_one_cluster(documents, monkeypatch, speakers):
    """Long chains of copies of copies, in a cluster that no task could hold."""
    random.seed(9)
    word = lambda: random.choice("abcdefghijklmnop") + random.choice("aeiou") + random.choice("xyz")
    rows, text = [], [word() for _ in range(80)]
    for i in range(150):
        text = list(text) if random.random() < 0.9 else list(rows[random.randrange(len(rows))][1].split() if rows else text)
        text[random.randrange(len(text))] = word()
        rows.append((i, " ".join(text)))
    for name, value in (("CAPACITY", 1500), ("SPEAKERS", speakers), ("MEETING", 3), ("CHAIN_EVERY", 1)):
        monkeypatch.setattr(ngram_join, name, value)
    check_near(documents(rows))


def test_near_without_chains(documents, monkeypatch):
    monkeypatch.setattr(ngram_join, "CHAIN_EVERY", 1 << 40)
    check_near(documents(near_texts()))


def test_near_odd_rows(odd):
    found = ngram_join.similar_documents(odd).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert by_id[1] == (0, 1) and by_id[4] == (0, 4) and by_id[3] == (1, 3) and by_id[None] == (2, None)
    assert ngram_join.similar_documents(odd.limit(0)).count() == 0
    assert ngram_join.without_similar(odd).columns == odd.columns


def test_near_rows_without_id_or_of_one_id(documents):
    random.seed(12)
    word = lambda: random.choice("abcdefghijklmnop") + random.choice("aeiou") + random.choice("xyz")
    base = [[word() for _ in range(80)] for _ in range(12)]
    near = lambda k, w: " ".join([*base[k][:-1], w])
    rows = [(None, near(k, "one")) for k in range(8)] + [(20 + k, near(k, "two")) for k in range(8)]
    rows += [(None, near(0, "three")), (None, near(0, "one")), (None, ""), (None, None)]
    # one id with unlike texts: what is near to either is one component
    rows += [(40, near(9, "one")), (40, near(10, "one")), (40, " "), (31, near(9, "two")), (41, near(10, "two")), (42, near(11, "a"))]
    docs = documents(rows)
    check_near(docs)
    kept = Counter((r.doc_id, None if r.text is None else r.text.split()[:3].__str__()) for r in ngram_join.without_similar(docs).collect())
    want = Counter((None, str(base[k][:3])) for k in range(8))
    want += Counter([(None, "[]"), (None, None), (31, str(base[9][:3])), (42, str(base[11][:3]))])
    assert kept == want


@pytest.mark.parametrize("per_task", [1 << 18, 10])
def test_components(spark, monkeypatch, per_task):
    monkeypatch.setattr(components, "PER_TASK", per_task)
    random.seed(8)
    links = [(i, i + 1) for i in range(0, 60)] + [(random.randint(100, 160), random.randint(100, 160)) for _ in range(40)] + [(7, 7)]
    links += [(500, i) for i in range(501, 560)]
    found = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {n: n for pair in links for n in pair if pair[0] != pair[1]}
    for _ in range(100):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert found == root


def test_links_united_in_a_task():
    rng = np.random.default_rng(4)
    for n in (0, 1, 5, 300):
        a, b = rng.integers(0, 1 + n, (2, n)) * 7
        nodes, roots = components.united(a, b)
        want = {x: x for x in {*a.tolist(), *b.tolist()}}
        for _ in want:
            for x, y in zip(a.tolist(), b.tolist(), strict=True):
                want[x] = want[y] = min(want[x], want[y])
        assert dict(zip(nodes.tolist(), roots.tolist(), strict=True)) == want
    nodes, roots = components.united(np.arange(1, 100_001), np.arange(100_000))
    assert not roots.any()


def test_columns_with_any_names_stay(documents):
    """Columns named like those that the operators use themselves."""
    names = ["__key", "__copies", "__kept_id", "__row", "row", "key", "copies", "kept_id", "kept_key", "a", "unit", "place"]
    base = " ".join(f"word{i}" for i in range(40))
    docs = documents([(1, base), (2, base), (3, base + " more"), (None, "x y z"), (None, "x y z")], **{n: f"'mine {n}'" for n in names})
    for stage in (exact_dedup.without_duplicates, ngram_join.without_similar, mixing.mixed_documents):
        kept = stage(docs)
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert rows and all(r[n] == f"mine {n}" for r in rows for n in names)


def test_components_do_not_stop_early(spark, monkeypatch):
    monkeypatch.setattr(components, "PER_TASK", 10)
    path = spark.createDataFrame([(i * 37 % 101, (i + 1) * 37 % 101) for i in range(60)], "a long, b long")
    with pytest.raises(RuntimeError, match="rounds"):
        components.components(path, most_rounds=1)
