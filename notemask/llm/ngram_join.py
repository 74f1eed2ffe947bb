"""Joins documents whose sets of 5-word shingles are similar (Jaccard 0.8 or more), with signature trees.

A set's signature is a bitmap with one bit per shingle. Signatures are the leaves of a tree whose inner nodes hold the
OR of their leaves and the range of their sizes; two nodes are compared only if their largest possible overlap could
reach the threshold, and documents that are already connected are not compared again.

Trees are small and many. What brings documents together at all is the prefix of their sets in one global order, rare
shingles first: two sets of the wanted similarity share a shingle of their prefixes. The order comes from a sketch of
all shingles of the corpus, of fixed size, so shingles of passages that very many documents share come last. The smaller
set of a pair must even share one of a shorter prefix; a shingle that stands in no set's shorter prefix joins nothing.

1. One row per document: size, name and signature of its set; equal sets have one name and go on as one.
2. Buckets of prefix shingles find those that several sets share.
3. Chains along some of these shingles, kept where the signatures allow the similarity, connect most of each group.
4. For every shared shingle, trees compare the sets that are not connected yet. Any two similar sets are now in one
   cluster.
5. Within each cluster a tree over the texts' own sets finds the links; exact intersections decide. A cluster too
   large for a task is cut into parts: first each part finds its links, then some sets of each part's largest
   component find those between parts, and then only what is still outside the cluster's largest component is
   compared with all parts.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bytes_of, releasing, slices, table, written
from .components import components

WORDS = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Cells of the sketch that orders shingles, and bytes of text that a task works on at once.
CELLS, SLICE = 1 << 20, 1 << 20
#: Bytes of text for which there is one bucket of prefix shingles.
PER_BUCKET = 16 << 20
#: One in so many shared shingles makes a chain.
CHAIN_EVERY = 16
#: Shingles of a cluster, or of part of one, that a task compares at once.
CAPACITY = 1_500_000
#: Sets that speak for the largest component of a part, and parts whose speakers meet in one task.
SPEAKERS, MEETING = 8, 500
FANOUT = 8

_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)
_PLACE_CODES = np.random.default_rng(2).integers(1, 1 << 63, WORDS, dtype=np.int64).astype(np.uint64) | np.uint64(1)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_NO_ID = -(1 << 63)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if 0 not in _POWERS or len(_POWERS[0][0]) <= n:
        up, down = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[0] = np.cumprod(up), np.cumprod(down)
    return _POWERS[0]


def shingle_sets(codes: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of documents that lie in a row (`at`: where each begins, with the end)."""
    n = len(codes)
    if not n:
        return [np.zeros(0, np.uint64)] * (len(at) - 1)
    codes = codes | ((codes >= 65) & (codes <= 90)).astype(np.uint8) << 5
    word = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    begins = np.zeros(n + 1, bool)
    begins[at] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | begins[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | begins[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    h = (total[end] - total[start]) * down[start] + (end - start).astype(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * _MIX
    h ^= h >> np.uint64(29)
    cuts = np.searchsorted(start, at)
    sums = np.zeros(max(0, len(h) - WORDS + 1), np.uint64)
    for k in range(WORDS):
        sums += h[k : len(h) - WORDS + 1 + k] * _PLACE_CODES[k] if len(sums) else sums
    sums = (sums ^ (sums >> np.uint64(32))) * _MIX
    sums ^= sums >> np.uint64(30)
    found = []
    for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
        if b - a >= WORDS:
            found.append(np.unique(sums[a : b - WORDS + 1]))
        elif b > a:  # a short text is one shingle
            whole = int((h[a:b] * _PLACE_CODES[: b - a]).sum(dtype=np.uint64)) ^ (b - a) * _BASE
            found.append(np.array([whole & 0xFFFFFFFFFFFFFFFF], np.uint64))
        else:
            found.append(np.zeros(0, np.uint64))
    return found


def sets_of(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """Sets of a column of texts, a bounded number of bytes at a time."""
    codes, at = bytes_of(column)
    for a, b in slices(np.diff(at), SLICE):
        yield a, b, shingle_sets(codes[at[a] : at[b]], at[a : b + 1] - at[a])


def name_of(items: np.ndarray) -> int:
    """64-bit name of a set."""
    return int.from_bytes(hashlib.blake2b(items.tobytes(), digest_size=8).digest(), "little", signed=True)


def width_of(n: int) -> int:
    """Bits of the signature of a set of n shingles."""
    return 1 << min(max(6, (2 * n - 1).bit_length() if n else 6), 15)


def bitmap(items: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros(width, np.uint8)
    bits[(items & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def folded(signature: bytes, width: int) -> int:
    """A signature as a number, folded to a narrower width."""
    value, own = int.from_bytes(signature, "little"), len(signature) * 8
    while own > width:
        own //= 2
        value = (value >> own) | (value & ((1 << own) - 1))
    return value


def possible(n_a: int, n_b: int, sig_a: bytes, sig_b: bytes) -> bool:
    """Whether two sets can be similar: each bit in which the signatures differ stands for a shingle that only one has,
    and similar sets differ in at most (100 - p) / (100 + p) of their sizes' sum."""
    if 100 * min(n_a, n_b) < PERCENT * max(n_a, n_b):
        return False
    width = 8 * min(len(sig_a), len(sig_b))
    differ = (folded(sig_a, width) ^ folded(sig_b, width)).bit_count()
    return (100 + PERCENT) * differ <= (100 - PERCENT) * (n_a + n_b)


# --- 1. sets and the sketch ------------------------------------------------------------------------------------------

_SETS = "doc_id long, key long, n int, name long, signature binary, cells binary"


@releasing
def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells = np.zeros(CELLS, np.int64)
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("name", pa.int64()), ("signature", pa.binary()),
            ("cells", pa.binary()),
        ]
    )
    for batch in batches:
        ids, row_keys = batch.column("doc_id"), batch.column("key")
        for a, b, sets in sets_of(batch.column("text")):
            if sets:
                cells += np.bincount((np.concatenate(sets) >> np.uint64(44)).astype(np.int64), minlength=CELLS)
            rows = [(len(s), name_of(s), bitmap(s, width_of(len(s))).tobytes(), None) for s in sets]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a), row_keys.slice(a, b - a), *(pa.array(c, schema.field(i + 2).type) for i, c in enumerate(columns))],
                schema=schema,
            )
    block = CELLS // 64
    for k in range(64):
        part = cells[k * block : (k + 1) * block]
        if part.any():
            row = [[None], [None], [k], [None], [None], [np.minimum(part, (1 << 31) - 1).astype("<i4").tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row, schema.types, strict=True)], schema=schema)


def _add(blocks: pa.Table) -> pa.Table:
    total = np.zeros(CELLS // 64, np.int64)
    for column in blocks.column("cells").chunks:
        for x in column:
            total += np.frombuffer(x.as_buffer(), "<i4")
    return pa.table({"n": pa.array([blocks.column("n")[0].as_py()], pa.int32()), "classes": [_classes(total).tobytes()]})


def _classes(cells: np.ndarray) -> np.ndarray:
    """Frequency classes: doublings of a cell's count. At most 63."""
    return np.minimum(np.ceil(np.log2(cells + 1.0)), 63).astype(np.uint8)


def frequency_classes(described: DataFrame) -> np.ndarray:
    """Class of each cell of the sketch: a table of CELLS bytes, whatever the size of the corpus.

    The tasks' counts are added block by block in parallel."""
    blocks = described.filter("cells is not null").groupBy("n").applyInArrow(_add, "n int, classes binary")
    classes = np.zeros(CELLS, np.uint8)
    for row in blocks.collect():
        classes[row.n * (CELLS // 64) : (row.n + 1) * (CELLS // 64)] = np.frombuffer(row.classes, np.uint8)
    return classes


# --- 2. shared prefix shingles ---------------------------------------------------------------------------------------


def prefix(items: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, int]:
    """The first shingles in the global order, and the length of the shorter prefix.

    Similar sets share p percent of the larger one and 2p / (100 + p) of the smaller one at least. The first shingle
    that they share lies within the prefix of the one and within the shorter prefix of the other."""
    n = len(items)
    length = n - -(-PERCENT * n // 100) + 1
    shorter = n - -(-2 * PERCENT * n // (100 + PERCENT)) + 1
    rank = classes[(items >> np.uint64(44)).astype(np.int64)]
    return items[np.lexsort((items, rank))[:length]], shorter


def _prefixes(classes: np.ndarray, n_buckets: int):
    @releasing
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, names, leads = [], [], []
            seen: set[int] = set()
            for _, _, sets in sets_of(batch.column("text")):
                for items in sets:
                    if len(items) and (name := name_of(items)) not in seen:
                        seen.add(name)
                        first, shorter = prefix(items, classes)
                        keys.append(first)
                        names.append(np.full(len(first), name, np.int64))
                        leads.append(np.arange(len(first)) < shorter)
            if not keys:
                continue
            # the last bit of a shingle tells whether it stands in the shorter prefix
            key = (np.concatenate(keys) & ~np.uint64(1)) | np.concatenate(leads)
            name = np.concatenate(names)
            bucket = (((key >> np.uint64(1)) * _MIX) >> np.uint64(32)) % np.uint64(n_buckets)
            order = np.argsort(bucket, kind="stable")
            found, cuts = np.unique(bucket[order], return_index=True)
            pairs = np.stack([key[order].view(np.int64), name[order]], axis=1)
            cuts = np.append(cuts, len(pairs)).tolist()
            data = [pairs[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(data, pa.binary())], ["bucket", "data"])

    return emit


_SHARED = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("lead", pa.bool_())])


def _shared(rows: pa.Table) -> pa.Table:
    """Shingles of a bucket that several sets share, one of them in its shorter prefix: kind 0 has a shingle and a set,
    kind 1 two sets in a chain."""
    pairs = np.frombuffer(b"".join(rows.column("data").to_pylist()), np.int64).reshape(-1, 2)
    key, name, lead = pairs[:, 0] >> 1, pairs[:, 1], (pairs[:, 0] & 1).astype(bool)
    # sets of one shingle are chained in an order of their own
    order = np.lexsort(((name.view(np.uint64) ^ key.view(np.uint64)) * _MIX, key))
    key, name, lead = key[order], name[order], lead[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
    key, name, lead = key[fresh], name[fresh], lead[fresh]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    led = np.logical_or.reduceat(lead, np.flatnonzero(first))[np.cumsum(first) - 1]
    key, name, lead = key[led], name[led], lead[led]
    next_same = np.zeros(len(key), bool)
    next_same[:-1] = key[1:] == key[:-1]
    several = next_same.copy()
    several[1:] |= next_same[:-1]
    sampled = (key.view(np.uint64) * np.uint64(_BASE)) >> np.uint64(32)
    chain = np.flatnonzero(next_same & (sampled % np.uint64(CHAIN_EVERY) == 0))
    low, high = np.minimum(name[chain], name[chain + 1]), np.maximum(name[chain], name[chain + 1])
    edges = np.unique(np.stack([low, high], axis=1), axis=0) if len(chain) else np.zeros((0, 2), np.int64)
    kind = np.concatenate([np.zeros(several.sum(), np.int32), np.ones(len(edges), np.int32)])
    a, b = np.concatenate([key[several], edges[:, 0]]), np.concatenate([name[several], edges[:, 1]])
    leads = np.concatenate([lead[several], np.ones(len(edges), bool)])
    return pa.table([pa.array(kind), pa.array(a), pa.array(b), pa.array(leads)], schema=_SHARED)


# --- 3. and 4. clusters by signatures ---------------------------------------------------------------------------------


def _plausible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "sig_a", "sig_b")]
        keep = [possible(*x) for x in zip(*columns, strict=True)]
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def plausible(edges: DataFrame, sets: DataFrame) -> DataFrame:
    """The links whose signatures allow the similarity."""
    side = lambda s: sets.select(F.col("name").alias(s), F.col("n").alias(f"n_{s}"), F.col("signature").alias(f"sig_{s}"))
    return edges.join(side("a"), "a").join(side("b"), "b").mapInArrow(_plausible, "a long, b long")


class SignatureTree:
    """Sets under nodes with OR-combined signatures and ranges of sizes."""

    def __init__(self, signatures: np.ndarray, sizes: np.ndarray, order: np.ndarray):
        """`signatures`: one row of 64-bit words each; `order`: leaves from left to right, like next to like."""
        self.labels = np.arange(len(sizes))  # sets with one label are known to be connected
        self.order = order
        bits = np.bitwise_count(signatures).sum(axis=1, dtype=np.int64)
        # each level: signatures, least and most size, least bits, and by label whether all below are connected
        self.levels = [(signatures[order], sizes[order], sizes[order], bits[order])]
        while len(self.levels[-1][1]) > FANOUT:
            sig, low, high, few = self.levels[-1]
            cuts = np.arange(0, len(low), FANOUT)
            self.levels.append(
                (np.bitwise_or.reduceat(sig, cuts), np.minimum.reduceat(low, cuts), np.maximum.reduceat(high, cuts), np.minimum.reduceat(few, cuts))
            )

    def union(self, i: int, j: int) -> None:
        a, b = self.labels[i], self.labels[j]
        if a != b:
            self.labels[self.labels == max(a, b)] = min(a, b)

    def _whole(self, level: int) -> np.ndarray:
        """Label of each node whose leaves are all connected, -1 for the others, by the labels of now."""
        labels = self.labels[self.order]
        for _ in range(level):
            cuts = np.arange(0, len(labels), FANOUT)
            low, high = np.minimum.reduceat(labels, cuts), np.maximum.reduceat(labels, cuts)
            labels = np.where(low == high, low, -1)
        return labels

    def _open(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of nodes may hold similar sets that are not connected yet."""
        sig, low, high, few = self.levels[level]
        whole = self._whole(level)
        need = PERCENT * (low[i] + low[j])  # of 100 + PERCENT times the overlap
        keep = (whole[i] < 0) | (whole[i] != whole[j])
        keep &= (100 * high[i] >= PERCENT * low[j]) & (100 * high[j] >= PERCENT * low[i])
        k = np.flatnonzero(keep)
        common = np.bitwise_count(sig[i[k]] & sig[j[k]]).sum(axis=1, dtype=np.int64)
        # of a set with b bits, at least b - common shingles lie outside the other node
        most_i = high[i[k]] - np.maximum(0, few[i[k]] - common)
        most_j = high[j[k]] - np.maximum(0, few[j[k]] - common)
        return k[(100 + PERCENT) * np.minimum(most_i, most_j) >= need[k]]

    def traverse(self) -> Iterator[tuple[int, int]]:
        """Pairs of sets that may be similar and that are not connected when they come up."""
        top = len(self.levels) - 1
        i, j = np.triu_indices(len(self.levels[top][1]))
        stack = [(top, i, j)]
        while stack:
            level, i, j = stack.pop()
            if len(i) > 4096:
                half = len(i) // 2
                stack += [(level, i[half:], j[half:]), (level, i[:half], j[:half])]
                continue
            k = self._open(level, i, j)
            i, j = i[k], j[k]
            if not level:
                for a, b in zip(self.order[i].tolist(), self.order[j].tolist(), strict=True):
                    if self.labels[a] != self.labels[b]:
                        yield a, b
                continue
            below = len(self.levels[level - 1][1])
            step = np.arange(FANOUT)
            a = (i[:, None, None] * FANOUT + step[None, :, None]) + np.zeros_like(step)[None, None, :]
            b = (j[:, None, None] * FANOUT + step[None, None, :]) + np.zeros_like(step)[None, :, None]
            good = (a < below) & (b < below) & (a <= b if level > 1 else a < b)
            good |= (a < below) & (b < below) & (i != j)[:, None, None]
            stack.append((level - 1, a[good], b[good]))


def tree_of(signatures: list[np.ndarray], sizes: np.ndarray, least: np.ndarray) -> SignatureTree:
    order = np.lexsort((sizes, least))
    return SignatureTree(np.stack(signatures), sizes, order)


def _as_words(signature: bytes, width: int) -> np.ndarray:
    return np.frombuffer(folded(signature, width).to_bytes(width // 8, "little"), "<u8")


def _compared(rows: pa.Table) -> pa.Table:
    """Links between clusters that the signatures allow, for all shingles of a bucket."""
    rows = rows.sort_by([("key", "ascending"), ("name", "ascending")])
    keys = rows.column("key").to_numpy()
    names, roots, sizes, leads = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("name", "root", "n", "lead"))
    signatures = rows.column("signature").to_pylist()
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]])).tolist()
    found: set[tuple[int, int]] = set()
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b - a < 2 * FANOUT:
            joined: set[tuple[int, int]] = set()
            for i in range(a, b):
                for j in range(i + 1, b):
                    pair = (roots[i], roots[j])
                    led = (leads[i] and sizes[i] <= sizes[j]) or (leads[j] and sizes[j] <= sizes[i])
                    if led and pair[0] != pair[1] and pair not in joined and possible(sizes[i], sizes[j], signatures[i], signatures[j]):
                        joined |= {pair, pair[::-1]}
                        found.add((int(names[i]), int(names[j])))
            continue
        width = max(64, min(8 * len(s) for s in signatures[a:b]))
        tree = tree_of([_as_words(s, width) for s in signatures[a:b]], sizes[a:b].astype(np.int64), roots[a:b])
        tree.labels = np.unique(roots[a:b], return_inverse=True)[1]
        for i, j in tree.traverse():
            if tree.labels[i] != tree.labels[j] and possible(sizes[a + i], sizes[a + j], signatures[a + i], signatures[a + j]):
                found.add((int(names[a + i]), int(names[a + j])))
                tree.union(i, j)
    pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


# --- 5. links within clusters -----------------------------------------------------------------------------------------


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(a) + len(b)
    overlap = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * overlap >= PERCENT * (both - overlap)


def _linked(rows: pa.Table) -> pa.Table:
    """Links that connect the similar sets of some clusters, as far as they aren't known to be connected (`root`)."""
    clusters, names, roots = (rows.column(c).to_numpy() for c in ("cluster", "name", "root"))
    sets: list[np.ndarray] = []
    for _, _, part in sets_of(rows.column("text")):
        sets += part
    order = np.lexsort((names, clusters))
    cuts = np.flatnonzero(np.concatenate([[True], clusters[order][1:] != clusters[order][:-1], [True]]))
    found: list[tuple[int, int]] = []
    for begin, end in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
        members = order[begin:end]
        members = members[np.unique(names[members], return_index=True)[1]]
        own = [sets[m] for m in members.tolist()]
        sizes = np.array([len(s) for s in own], np.int64)
        width = 1 << max(6, int(4 * sizes.max() - 1).bit_length())
        least = np.array([s[0] if len(s) else 0 for s in own], np.uint64)
        tree = tree_of([bitmap(s, width).view("<u8") for s in own], sizes, least)
        tree.labels = np.unique(roots[members], return_inverse=True)[1]
        neighbours = zip(tree.order.tolist(), tree.order[1:].tolist(), strict=False)
        for x, y in itertools.chain(neighbours, tree.traverse()):
            if tree.labels[x] != tree.labels[y] and _similar(own[x], own[y]):
                tree.union(x, y)
                found.append((int(names[members[x]]), int(names[members[y]])))
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _weight() -> Column:
    return (F.col("n") + 50).cast("long")


def _in_parts(members: DataFrame, name: str) -> DataFrame:
    """Adds the part of each member of a large cluster: sets of about one size, dealt out evenly. No cluster is
    ordered as a whole."""
    sized = members.withColumn("class", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.1))).cast("int"))
    totals = sized.groupBy("cluster", "class").agg(F.ceil(F.sum(_weight()) / (CAPACITY // 2)).alias("pieces"))
    piece = F.pmod(F.xxhash64("name"), F.col("pieces"))
    return sized.join(totals, ["cluster", "class"]).withColumn(name, F.concat_ws(".", "class", piece)).drop("class", "pieces")


def _compare_texts(rows: DataFrame, tasks: DataFrame) -> DataFrame:
    """Links of the tasks' members (task, cluster, name, doc_id, key, root).

    A member's text is that of its own row, as ids alone don't name a row; of equal rows one is taken."""
    texts = rows.join(tasks.hint("merge"), ["doc_id", "key"])
    texts = texts.groupBy("doc_id", "key", "task", "cluster", "name", "root").agg(F.first("text").alias("text"))
    texts = texts.select("task", "cluster", "name", "root", "text")
    return texts.groupBy("task").applyInArrow(_linked, "a long, b long")


def _links(rows: DataFrame, members: DataFrame) -> DataFrame:
    """Links that connect all similar sets of each cluster (members: name, doc_id, key, n, cluster)."""
    totals = written(members.groupBy("cluster").agg(F.sum(_weight()).alias("total")), "totals")
    packed, n_large = totals.agg(
        F.sum(F.when(F.col("total") <= CAPACITY, F.col("total"))), F.count_if(F.col("total") > CAPACITY)
    ).first()
    n_tasks = max(1, -(-(packed or 0) // (CAPACITY // 2)))
    both = members.join(totals, "cluster")
    small = both.filter(F.col("total") <= CAPACITY).withColumn("root", F.col("name"))
    task = F.concat(F.lit("s"), F.pmod(F.xxhash64("cluster"), F.lit(n_tasks))).alias("task")
    mark = ["cluster", "name", "doc_id", "key", "root"]
    if not n_large:
        return written(_compare_texts(rows, small.select(task, *mark)), "links")
    large = written(_in_parts(both.filter(F.col("total") > CAPACITY).drop("total"), "part"), "parts")
    own = large.withColumn("root", F.col("name")).select(F.concat_ws("-", F.lit("l"), "cluster", "part").alias("task"), *mark)
    links = written(_compare_texts(rows, small.select(task, *mark).unionByName(own)), "links")
    links = _add_speakers(rows, large, links)
    return _add_outsiders(rows, large, links)


def _rooted(large: DataFrame, links: DataFrame) -> DataFrame:
    known = components(links).select(F.col("node").alias("name"), "root")
    return written(large.join(known, "name", "left").withColumn("root", F.coalesce("root", "name")), "rooted")


def _most(rooted: DataFrame, by: list[str]) -> DataFrame:
    """The root of the largest component of each group."""
    counts = rooted.groupBy(*by, "root").agg(F.count("*").alias("size"))
    return counts.groupBy(*by).agg(F.max_by("root", F.struct("size", "root")).alias("root"))


def _add_speakers(rows: DataFrame, large: DataFrame, links: DataFrame) -> DataFrame:
    """Links between the largest components of a cluster's parts, found by a few sets of each."""
    rooted = _rooted(large, links)
    largest = rooted.join(_most(rooted, ["cluster", "part"]), ["cluster", "part", "root"])
    place = F.row_number().over(Window.partitionBy("cluster", "part").orderBy(F.xxhash64("name"), "name"))
    speakers = largest.withColumn("place", place).filter(F.col("place") <= SPEAKERS)
    parts = speakers.select("cluster", "part").distinct().groupBy("cluster").agg(F.ceil(F.count("*") / MEETING).alias("meetings"))
    meeting = F.pmod(F.xxhash64("part"), F.col("meetings"))
    tasks = speakers.join(parts, "cluster").select(
        F.concat_ws("-", F.lit("m"), "cluster", meeting).alias("task"), "cluster", "name", "doc_id", "key", "root"
    )
    return written(links.unionByName(_compare_texts(rows, tasks)), "links")


def _add_outsiders(rows: DataFrame, large: DataFrame, links: DataFrame) -> DataFrame:
    """Links of the sets outside a cluster's largest component with all sets of the cluster."""
    rooted = _rooted(large, links)
    main = _most(rooted, ["cluster"]).withColumnRenamed("root", "main")
    outside = written(rooted.join(main, "cluster").filter("root <> main").drop("main"), "outside")
    if outside.isEmpty():
        return links
    outside = written(_in_parts(outside, "own"), "outside")
    ranges = lambda df, part: df.groupBy("cluster", part).agg(F.min("n").alias(f"low_{part}"), F.max("n").alias(f"high_{part}"))
    pairs = ranges(outside, "own").join(ranges(rooted, "part"), "cluster")
    near = (100 * F.col("high_own") >= PERCENT * F.col("low_part")) & (100 * F.col("high_part") >= PERCENT * F.col("low_own"))
    task = F.concat_ws("-", F.lit("o"), "cluster", "own", "part").alias("task")
    pairs = written(pairs.filter(near).select("cluster", "own", "part", task), "pairs")
    mark = ["task", "cluster", "name", "doc_id", "key", "root"]
    tasks = outside.drop("part").join(pairs, ["cluster", "own"]).select(*mark)
    tasks = tasks.unionByName(rooted.join(pairs, ["cluster", "part"]).select(*mark))
    return written(links.unionByName(_compare_texts(rows, tasks)), "links")


def similar_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, class_id (least doc_id with an equal set), component_id (least doc_id
    that links lead to).

    A-Z count as a-z; a text of fewer than five words is one shingle; a text without words has no set and is linked
    with nothing. Null texts count as empty. Rows of one doc_id are one document to the links; a null doc_id comes
    before all others and is given back as null. Other columns don't matter; an empty table gives an empty result.
    """
    back = lambda c: F.when(F.col(c) != _NO_ID, F.col(c)).alias(c)
    return _labelled_rows(docs).select(back("doc_id"), "n_shingles", back("class_id"), back("component_id"))


def _row_key() -> Column:
    return F.xxhash64(F.col("text").cast("string").cast("binary"))


def _labelled_rows(docs: DataFrame) -> DataFrame:
    """The result with a hash of each row's text (key) and the name of its component (root), and without nulls as ids."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"),
        F.col("text").cast("string").cast("binary").alias("text"),
        _row_key().alias("key"),
    )
    described = written(rows.mapInArrow(_describe, _SETS), "sets")
    classes = frequency_classes(described)
    documents = described.filter("cells is null").select("doc_id", "key", "n", "name", "signature")
    sets = documents.filter("n > 0").groupBy("name").agg(
        F.min(F.struct("doc_id", "key")).alias("first"), F.max("n").alias("n"), F.max("signature").alias("signature")
    )
    sets = written(sets.select("name", "first.doc_id", "first.key", "n", "signature"), "distinct-sets")
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    n_buckets = max(1, -(-size // PER_BUCKET))
    prefixes = rows.mapInArrow(_prefixes(classes, n_buckets), "bucket int, data binary")
    shared = written(prefixes.groupBy("bucket").applyInArrow(_shared, "kind int, a long, b long, lead boolean"), "shared")
    chains = written(plausible(shared.filter("kind = 1").select("a", "b").distinct(), sets), "chains")
    known = written(components(chains), "chained")
    later = _across(shared.filter("kind = 0").select(F.col("a").alias("key"), F.col("b").alias("name"), "lead"), known, sets, n_buckets)
    star = known.select(F.col("node").alias("a"), F.col("root").alias("b"))
    clusters = components(star.unionByName(later))
    members = clusters.select(F.col("node").alias("name"), F.col("root").alias("cluster"))
    members = members.join(sets.select("name", "doc_id", "key", "n"), "name")
    links = _links(rows, written(members, "members")).unionByName(_links_of_ids(documents))
    roots = written(components(links), "roots")
    return _labelled(documents, sets, roots)


def _links_of_ids(documents: DataFrame) -> DataFrame:
    """Links between the sets of one doc_id. Rows without id need none: each component that has one is named by null."""
    named = documents.filter((F.col("n") > 0) & (F.col("doc_id") != _NO_ID)).select("doc_id", "name")
    several = named.groupBy("doc_id").agg(F.min("name").alias("a"), F.max("name").alias("b")).filter("a <> b")
    return named.join(several.select("doc_id", "a"), "doc_id").filter("a <> name").select("a", F.col("name").alias("b")).distinct()


def without_similar(docs: DataFrame) -> DataFrame:
    """The rows, with all their columns, of one document of each component: the one with the least doc_id.

    Rows without id are documents of their own: of those in one component, one is kept."""
    found = written(_labelled_rows(docs), "labelled")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    kept = found.filter((F.col("doc_id") != _NO_ID) & (F.col("doc_id") == F.col("component_id")))
    kept = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    named = rows.join(kept.hint("merge"), F.col("row.doc_id") == F.col("kept_id"), "left_semi").select("row.*")
    nameless = found.filter(F.col("doc_id") == _NO_ID)
    first = nameless.filter("n_shingles > 0").groupBy("root").agg(F.min("key").alias("key")).select("key")
    text = F.xxhash64(F.col("row.text").cast("string").cast("binary"))
    rows = rows.filter("row.doc_id is null").select("row", text.alias("key"))
    once = rows.join(first.hint("merge"), "key").groupBy("key").agg(F.first("row").alias("row"))
    without_words = nameless.filter("n_shingles = 0").select("key").distinct()
    wordless = rows.join(without_words.hint("merge"), "key", "left_semi")
    return named.unionByName(once.select("row.*")).unionByName(wordless.select("row.*"))


def _across(shared: DataFrame, known: DataFrame, sets: DataFrame, n_buckets: int) -> DataFrame:
    """Links between different clusters that share a shingle, where the signatures allow them."""
    rows = shared.join(known.select(F.col("node").alias("name"), "root"), "name", "left")
    rows = written(rows.select("key", "name", "lead", F.coalesce("root", "name").alias("root")), "shared-roots")
    several = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    rows = rows.join(several.select("key"), "key").join(sets.select("name", "n", "signature"), "name")
    bucket = F.pmod(F.xxhash64("key"), F.lit(n_buckets)).alias("bucket")
    rows = rows.select(bucket, "key", "name", "root", "lead", "n", "signature")
    return rows.groupBy("bucket").applyInArrow(_compared, "a long, b long").distinct()


def _labelled(documents: DataFrame, sets: DataFrame, roots: DataFrame) -> DataFrame:
    """Documents with the least doc_id of their component; documents without words with their own."""
    known = roots.select(F.col("node").alias("name"), "root")
    of_set = sets.select("name", F.col("doc_id").alias("class_id")).join(known, "name", "left")
    of_set = of_set.withColumn("root", F.coalesce("root", "name"))
    least = of_set.groupBy("root").agg(F.min("class_id").alias("component_id"))
    labels = of_set.join(least, "root").select("name", "class_id", "component_id", "root")
    found = documents.select("doc_id", "key", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("name")).alias("name"))
    found = found.join(labels, "name", "left")
    # a row without words belongs to the document that the other rows of its id are
    of_id = found.filter("n_shingles > 0").select("doc_id", F.col("component_id").alias("of_id"))
    of_id = of_id.join(found.filter("n_shingles = 0").select("doc_id").distinct(), "doc_id", "left_semi").distinct()
    rest = found.filter("n_shingles = 0").join(of_id.groupBy("doc_id").agg(F.min("of_id").alias("of_id")), "doc_id", "left")
    columns = ["doc_id", "key", "n_shingles", "class_id", "component_id", "root"]
    rest = rest.withColumns({"class_id": F.col("doc_id"), "component_id": F.coalesce("of_id", "doc_id")})
    return found.filter("n_shingles > 0").select(*columns).unionByName(rest.select(*columns))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of similar documents of every document."""
    return similar_documents(table(spark, sf_dir, "documents"))
