"""Connected components of a link table: unions within tasks, then alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import releasing, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", "a"))).first())


#: Links that a task unites at once, about.
PER_TASK = 1 << 18


def united(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some links, ascending, and the least node that each is connected to."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a) :]
    least = np.arange(len(nodes))
    while True:
        x, y = least[i], least[j]
        open_ = np.flatnonzero(x != y)
        if not len(open_):
            return nodes, nodes[least]
        i, j = i[open_], j[open_]
        low, high = np.minimum(x[open_], y[open_]), np.maximum(x[open_], y[open_])
        np.minimum.at(least, high, low)
        while True:  # each node to the end of its chain
            further = least[least]
            if (further == least).all():
                break
            least = further


@releasing
def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a task's links with the least node that these connect it to."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        waiting.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        if sum(len(x) for x, _ in waiting) > PER_TASK:
            a, b = united(*(np.concatenate([own, *more]) for own, more in zip((a, b), zip(*waiting, strict=True), strict=True)))
            waiting = []
    if waiting or len(a):
        parts = zip(*waiting, strict=True) if waiting else ((), ())
        a, b = united(*(np.concatenate([own, *more]) for own, more in zip((a, b), parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def components(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """node, root of every node of a table of links (a, b): root is the least node that it is connected to.

    Tasks first unite their own links and keep one per node. What several tasks have left goes on in rounds, each of
    which joins every node to the least neighbour of its neighbourhood: minima are aggregated before the shuffle, and a
    node with many links is one row on one side of a join. The number of rounds grows with the logarithm of the longest
    path. The table is written once a round, so no round repeats an earlier one. Roots that still change after
    `most_rounds` are an error.
    """
    links = written(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).filter("a <> b"), "links")
    parts = max(1, -(-links.count() // PER_TASK))
    forest = links.coalesce(parts).mapInArrow(_forest, "a long, b long")
    if parts == 1:
        return forest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    links = written(forest.filter("a <> b").distinct(), "links")
    state = _state(links)
    for _ in range(most_rounds):
        if not state[0]:
            break
        links = written(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            break
    else:
        if state[0]:
            raise RuntimeError(f"components still change after {most_rounds} rounds")
    roots = links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    """The larger neighbours of each node are linked to the least of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("least"))
    least = least.select("u", F.least("u", "least").alias("least"))
    larger = links.select(F.col("b").alias("u"), F.col("a").alias("v"))  # every link, seen from its smaller end
    return larger.join(least, "u").select(F.col("v").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """The smaller neighbours of each node, and the node, are linked to the least of them."""
    least = links.groupBy("a").agg(F.min("b").alias("least"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
    return moved.unionByName(least.select("a", F.col("least").alias("b"))).distinct()
