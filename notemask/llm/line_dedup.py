"""Line deduplication by a sharded minimal perfect hash.

Lines of many documents (licences, menus, headers) lose all their places but those in one document.

1. Every document gives 128-bit keys of its lines. A task collects them in blocks; within a block each distinct key comes
   once, with the number of documents that hold it and the largest of their ids.
2. Keys are cut into shards by their leading bits. The task of a shard builds a minimal perfect hash of its distinct keys
   (levels of bits; a key belongs to the first level on which its bit is its own, and the number of bits before it is its
   slot) and lays fingerprints, document counts and largest ids into arrays by slot. The shards are written: the index.
3. Blocks probe the shards with their distinct keys; no line meets another one. Only the keys that occur in enough
   documents come back to the block, which tells each document what lines to drop.

A line that stands in a third of all documents is one key of each block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import releasing, table, text_slices, written

#: Code points that a key has at least, and documents that hold it at least, for its lines to be dropped.
LEAST_CHARS, LEAST_DOCUMENTS = 20, 3
#: Keys of a block about, and distinct keys of a shard about.
BLOCK_KEYS, SHARD_KEYS = 1 << 19, 1 << 19
#: Bytes of text that are Python strings at a time.
SLICE = 1 << 20
#: Bits of a level for each key that is still without a slot.
BITS_PER_KEY = 2

_BLANK = b" \t\n\x0b\x0c\r"
_NO_ID = -(1 << 63)


def _scattered(hi: np.ndarray, lo: np.ndarray, level: int) -> np.ndarray:
    """64 bits of a key for one level."""
    x = (hi ^ np.uint64((level * 0x9E3779B97F4A7C15) & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= (x >> np.uint64(31)) ^ lo
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit keys: `bits` of all levels in a row and where each level begins."""

    def __init__(self, bits: np.ndarray, starts: list[int]) -> None:
        self.bits, self.starts = bits, starts
        counts = np.bitwise_count(self.bits.view(np.uint64)).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])

    @classmethod
    def of(cls, hi: np.ndarray, lo: np.ndarray) -> PerfectHash:
        levels, starts, level = [], [0], 0
        while len(hi):
            size = -(-BITS_PER_KEY * len(hi) // 64) * 64
            at = (_scattered(hi, lo, level) % np.uint64(size)).astype(np.int64)
            own = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(own, bitorder="little"))
            starts.append(starts[-1] + size)
            left = ~own[at]
            hi, lo, level = hi[left], lo[left], level + 1
        return cls(np.concatenate([np.zeros(0, np.uint8), *levels]), starts)

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level has a bit. Keys that the hash wasn't built of may get any slot."""
        found = np.full(len(hi), -1, np.int64)
        open_ = np.arange(len(hi))
        words = self.bits.view(np.uint64)
        for level, (start, end) in enumerate(zip(self.starts[:-1], self.starts[1:], strict=True)):
            if not len(open_):
                break
            at = start + (_scattered(hi[open_], lo[open_], level) % np.uint64(end - start)).astype(np.int64)
            word, bit = words[at >> 6], (at & 63).astype(np.uint64)
            has = (word >> bit) & np.uint64(1) == 1
            inside = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            found[open_[has]] = (self.before[at >> 6] + inside)[has]
            open_ = open_[~has]
        return found


def _key(line: bytes) -> bytes | None:
    """The key of a line, or None if it is too short."""
    line = line.strip(_BLANK)
    if len(line) < LEAST_CHARS or not line.isascii() and len(line.decode()) < LEAST_CHARS:
        return None
    return xxhash.xxh3_128_digest(line.lower())  # bytes lower-case A-Z only


def _halves(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(data, np.uint64).reshape(-1, 2)
    return pairs[:, 0], pairs[:, 1]


def _packed(*columns: np.ndarray) -> bytes:
    return np.stack(columns, 1).tobytes()


_BLOCKS = pa.schema([
    ("block", pa.int64()), ("doc_id", pa.int64()), ("row", pa.binary()), ("lines", pa.binary()), ("numbers", pa.binary()),
    ("keys", pa.binary()), ("counts", pa.binary()), ("largest", pa.binary()),
])
_BLOCKS_SQL = (
    "block long, doc_id long, row binary, lines binary, numbers binary, keys binary, counts binary, largest binary"
)


class _Block:
    """Lines of some documents: keys in a row, the number of the document of each, and its place there."""

    def __init__(self) -> None:
        self.documents: list[tuple[int | None, bytes]] = []
        self.keys, self.places, self.owners = [], [], []

    def add(self, doc_id: int | None, row: bytes, text: str) -> None:
        found = [(k, i) for i, k in enumerate(map(_key, text.encode().split(b"\n"))) if k is not None]
        if found:
            self.keys.extend(k for k, _ in found)
            self.places.extend(i for _, i in found)
            self.owners.extend([len(self.documents)] * len(found))
            self.documents.append((doc_id, row))

    def emitted(self, name: int) -> Iterator[pa.RecordBatch]:
        """One row for each document with keys, then one with the distinct keys."""
        if not self.keys:
            return
        hi, lo = _halves(b"".join(self.keys))
        owners = np.array(self.owners, np.int64)
        order = np.lexsort((owners, lo, hi))
        hi, lo, by = hi[order], lo[order], owners[order]
        fresh = np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])
        number = np.cumsum(fresh) - 1
        own = fresh | np.concatenate([[True], by[1:] != by[:-1]])  # a key once for each document
        ids = np.array([_NO_ID if d is None else d for d, _ in self.documents], np.int64)
        begins = np.flatnonzero(fresh)
        counts = np.add.reduceat(own.astype(np.int64), begins)
        largest = np.maximum.reduceat(ids[by], begins)
        numbers = np.empty(len(number), np.int32)
        numbers[order] = number
        places = np.array(self.places, np.int32)
        cuts = np.flatnonzero(np.diff(owners)) + 1
        n = len(self.documents)
        none = [None] * n
        yield pa.RecordBatch.from_arrays([
            pa.array([name] * n, pa.int64()), pa.array([d for d, _ in self.documents], pa.int64()),
            pa.array([r for _, r in self.documents], pa.binary()),
            pa.array([x.tobytes() for x in np.split(places, cuts)], pa.binary()),
            pa.array([x.tobytes() for x in np.split(numbers, cuts)], pa.binary()),
            *(pa.array(none, pa.binary()) for _ in range(3)),
        ], schema=_BLOCKS)
        keys = [_packed(hi[fresh], lo[fresh]), counts.tobytes(), largest.tobytes()]
        yield pa.RecordBatch.from_arrays([
            pa.array([name], pa.int64()), pa.nulls(1, pa.int64()), *(pa.nulls(1, pa.binary()) for _ in range(3)),
            *(pa.array([x], pa.binary()) for x in keys),
        ], schema=_BLOCKS)


@releasing
def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, block = TaskContext.get().partitionId() << 32, _Block()
    for batch in batches:
        ids, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
        for a, b, texts in text_slices(batch.column("text"), SLICE):
            for doc_id, row, text in zip(ids[a:b], rows[a:b], texts, strict=True):
                block.add(doc_id, row, text)
                if len(block.keys) >= BLOCK_KEYS:
                    yield from block.emitted(name)
                    name, block = name + 1, _Block()
    yield from block.emitted(name)


def _dealt(shards: int):
    """Cuts the distinct keys of blocks by shard: shard, block, first (number of its first key), keys, counts, largest."""

    @releasing
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, keys, counts, largest in zip(*(batch.column(x).to_pylist() for x in ("block", "keys", "counts", "largest")), strict=True):
                hi, lo = _halves(keys)
                shard = (hi >> np.uint64(32)).astype(np.int64) * shards >> 32  # ascends, as keys do
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1])
                ends = np.concatenate([cuts[1:], [len(shard)]])
                parts = [
                    [_packed(hi[a:b], lo[a:b]) for a, b in zip(cuts, ends, strict=True)],
                    [counts[8 * a : 8 * b] for a, b in zip(cuts, ends, strict=True)],
                    [largest[8 * a : 8 * b] for a, b in zip(cuts, ends, strict=True)],
                ]
                for i in range(0, len(cuts), 4096):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(shard[cuts[i : i + 4096]], pa.int64()), pa.array([block] * len(cuts[i : i + 4096]), pa.int64()),
                        pa.array(cuts[i : i + 4096], pa.int64()), *(pa.array(x[i : i + 4096], pa.binary()) for x in parts),
                    ], ["shard", "block", "first", "keys", "counts", "largest"])

    return deal


_DEALT_SQL = "shard long, block long, first long, keys binary, counts binary, largest binary"
_INDEX_SQL = "shard long, n_keys long, bits binary, starts array<long>, fingerprints binary, counts binary, largest binary"


def _indexed(parts: pa.Table) -> pa.Table:
    """The index of one shard."""
    hi, lo = _halves(b"".join(parts.column("keys").to_pylist()))
    counts, largest = (np.frombuffer(b"".join(parts.column(x).to_pylist()), np.int64) for x in ("counts", "largest"))
    order = np.lexsort((lo, hi))
    hi, lo = hi[order], lo[order]
    begins = np.flatnonzero(np.concatenate([[True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]))
    counts, largest = np.add.reduceat(counts[order], begins), np.maximum.reduceat(largest[order], begins)
    hi, lo = hi[begins], lo[begins]
    perfect = PerfectHash.of(hi, lo)
    slots = perfect.slots(hi, lo)
    by_slot = np.empty(len(slots), np.int64)
    by_slot[slots] = np.arange(len(slots))
    fingerprints = (lo & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return pa.table({
        "shard": parts.column("shard")[:1].combine_chunks(), "n_keys": pa.array([len(hi)], pa.int64()),
        "bits": pa.array([perfect.bits.tobytes()], pa.binary()), "starts": pa.array([perfect.starts], pa.list_(pa.int64())),
        "fingerprints": pa.array([fingerprints[by_slot].tobytes()], pa.binary()),
        "counts": pa.array([counts[by_slot].tobytes()], pa.binary()), "largest": pa.array([largest[by_slot].tobytes()], pa.binary()),
    })


_FOUND_SQL = "block long, numbers binary, largest binary"


def _probing(least: int):
    """Keys of the blocks that occur in enough documents by the index of their shard."""

    def probe(parts: pa.Table, index: pa.Table) -> pa.Table:
        found: dict[str, list] = {"block": [], "numbers": [], "largest": []}
        if index.num_rows:
            shard = index.to_pylist()[0]
            perfect = PerfectHash(np.frombuffer(shard["bits"], np.uint8), shard["starts"])
            fingerprints = np.frombuffer(shard["fingerprints"], np.uint32)
            counts, largest = (np.frombuffer(shard[x], np.int64) for x in ("counts", "largest"))
            for block, first, keys in zip(*(parts.column(x).to_pylist() for x in ("block", "first", "keys")), strict=True):
                hi, lo = _halves(keys)
                slots = perfect.slots(hi, lo)
                same = (slots >= 0) & (fingerprints[slots] == (lo & np.uint64(0xFFFFFFFF)).astype(np.uint32))
                at = np.flatnonzero(same & (counts[slots] >= least))
                if len(at):
                    found["block"].append(block)
                    found["numbers"].append((at + first).astype(np.int64).tobytes())
                    found["largest"].append(largest[slots[at]].tobytes())
        return pa.table({k: pa.array(v, pa.int64() if k == "block" else pa.binary()) for k, v in found.items()})

    return probe


_DROPS_SQL = "doc_id long, row binary, drop binary"


def _decided(documents: pa.Table, found: pa.Table) -> pa.Table:
    """Lines that each document of a block drops, as the bytes of their numbers."""
    numbers = np.frombuffer(b"".join(found.column("numbers").to_pylist()), np.int64)
    largest = np.frombuffer(b"".join(found.column("largest").to_pylist()), np.int64)
    out: tuple[list, list, list] = ([], [], [])
    if len(numbers):
        top = int(numbers.max()) + 1
        holder, often = np.zeros(top + 1, np.int64), np.zeros(top + 1, bool)
        holder[numbers], often[numbers] = largest, True
        columns = (documents.column(x).to_pylist() for x in ("doc_id", "row", "lines", "numbers"))
        for doc_id, row, lines, own in zip(*columns, strict=True):
            key = np.minimum(np.frombuffer(own, np.int32), top)
            drop = often[key] & (holder[key] != (_NO_ID if doc_id is None else doc_id))
            if drop.any():
                out[0].append(doc_id)
                out[1].append(row)
                out[2].append(np.frombuffer(lines, np.int32)[drop].tobytes())
    kinds = (pa.int64(), pa.binary(), pa.binary())
    return pa.table([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["doc_id", "row", "drop"])


@releasing
def _stripped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        drops = batch.column("drop")
        for a, b, texts in text_slices(batch.column("text"), SLICE):
            total, gone, kept = [], [], []
            for text, drop in zip(texts, drops.slice(a, b - a).to_pylist(), strict=True):
                total.append(text.count("\n") + 1)
                if drop is None:
                    gone.append(0)
                    kept.append(text)
                else:
                    lines, out = text.split("\n"), np.frombuffer(drop, np.int32).tolist()
                    for i in out:
                        lines[i] = None
                    gone.append(len(out))
                    kept.append("\n".join([x for x in lines if x is not None]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rest").slice(a, b - a), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())],
                ["rest", "n_lines", "n_dropped", "kept"],
            )


def _row(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def line_index(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The index, one row for each shard, and what it was built of: the written blocks, and their keys by shard.

    `docs` has doc_id (long), text and row. The number of shards grows with the number of keys.
    """
    blocks = written(docs.select("doc_id", "row", "text").mapInArrow(_blocks, _BLOCKS_SQL), "line-blocks")
    total = blocks.agg(F.sum(F.octet_length("keys"))).first()[0] or 0
    shards = max(1, math.ceil(total / 16 / SHARD_KEYS))
    distinct = blocks.filter("keys IS NOT NULL").select("block", "keys", "counts", "largest")
    dealt = distinct.mapInArrow(_dealt(shards), _DEALT_SQL)
    return written(dealt.groupBy("shard").applyInArrow(_indexed, _INDEX_SQL), "line-index"), blocks, dealt


def without_repeated_lines(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """`docs` with the lines of frequent keys dropped: its columns, text replaced, inside the struct column `doc`, and
    n_lines (before dropping) and n_dropped.

    A text is split at LF; a null or empty one is one empty line. A line's key is the line without the six ASCII blanks
    at both ends, A-Z lower-cased. Keys of at least 20 code points that at least `least` rows hold lose all their lines,
    except in the rows with the largest doc_id holding them. Every row counts, also a repeated one; a row without id
    counts as the smallest. The other lines stay in their order. doc_id is a whole number. The columns of `docs` may have
    any names; an empty table gives an empty result. Keys are told apart by 128 bits.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    rows = rows.select("doc", F.col("doc.doc_id").cast("long").alias("doc_id"), F.col("doc.text").cast("string").alias("text"))
    rows = rows.withColumn("row", _row(F.col("text")))
    index, blocks, dealt = line_index(rows)
    found = dealt.drop("counts", "largest").groupBy("shard").cogroup(index.groupBy("shard")).applyInArrow(_probing(least), _FOUND_SQL)
    documents = blocks.filter("keys IS NULL").select("block", "doc_id", "row", "lines", "numbers")
    drops = documents.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(_decided, _DROPS_SQL)
    # equal rows of one id drop the same lines; the others are one row here
    drops = written(drops, "line-drops").groupBy("doc_id", "row").agg(F.first("drop").alias("drop"))
    drops = drops.select(F.col("doc_id").alias("of_id"), F.col("row").alias("of_row"), "drop")
    rest = F.struct(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c != "text"))
    texts = rows.select(rest.alias("rest"), "text", "doc_id", "row")
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("row") == F.col("of_row"))
    joined = texts.join(drops.hint("merge"), same, "left").select("rest", "text", "drop")
    schema = f"rest {joined.schema['rest'].dataType.simpleString()}, n_lines long, n_dropped long, kept string"
    stripped = joined.mapInArrow(_stripped, schema)
    doc = F.struct(*(F.col("kept").alias("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns))
    return stripped.select(doc.alias("doc"), "n_lines", "n_dropped")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before dropping, dropped lines, and the digest of what is left."""
    found = without_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.encode("doc.text", "UTF-8"), 256).alias("kept_sha256")
    return found.select("doc.doc_id", "n_lines", "n_dropped", kept)


OP13_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS i FROM d),
k AS (
  SELECT doc_id, line, i,
    translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (
  SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, holder IS NOT NULL AND doc_id <> holder AS gone FROM k LEFT JOIN often USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
