"""Phrase collocations by FM-indexes over word numbers.

Texts are cut into pieces at punctuation, and phrases never cross pieces. A task lays the words of its documents in a row,
as numbers, with a separator between pieces; such a row is a shard, written once.

1. Phrases are pruned before they are named. Shards send a 32-bit value and a small count of each distinct phrase to the
   range of its hash; the values whose counts add up to the least count go back. Equal phrases have equal values, so no
   frequent phrase is lost. What is left is sent once more, with its words and full counts, and summed exactly; a phrase
   that shared a value by chance drops out there.
2. Single words are pruned first, the others become separators. An FM-index of the row (the last columns of the sorted
   contexts of the row and of its reverse) then gives the pairs, which are pruned too. Words in no such pair become
   separators as well, and the FM-index of what is left, by contexts of `LONGEST` words, is written for each shard.
3. Phrases grow one word a round, and those of more than three words in one. A shard keeps the intervals, in both columns, of its phrases that are left. Extending
   all of them to the left gives intervals of longer phrases whose rest is left; extending all to the right gives those
   whose beginning is. A longer phrase that comes from both sides is counted: the size of its interval.

Shards and ranges exchange packed arrays; rows of single phrases exist only of those that are frequent over all shards.
Nothing is broadcast.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import releasing, slices, table, written

#: Words of a phrase at most, its least count, and phrases reported for each language.
LONGEST, LEAST, MOST = 5, 100, 2000
#: Words of a shard about, and bytes of text that are split at a time.
SHARD_WORDS, SLICE = 1 << 21, 1 << 20
#: Words of the corpus for which there is one range of hashes.
PER_RANGE = 1 << 22
#: Parts that the candidates of a language are first ranked in.
RANKED_IN = 64

#: Separators of pieces become LF, tabs blanks, A-Z a-z.
_SPLIT = bytes.maketrans(b".,;:!?\x0b\x0c\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * 9 + b" abcdefghijklmnopqrstuvwxyz")
_NO_LANG = "und"


class _Shard:
    """Words of some texts as numbers; 0 stands between pieces."""

    def __init__(self) -> None:
        self.numbers: dict[str, defaultdict[bytes, int]] = {}
        self.fresh = count(1).__next__
        self.rows: list[np.ndarray] = []
        self.size = 0

    def add(self, lang: str, texts: list[bytes]) -> None:
        if lang not in self.numbers:
            self.numbers[lang] = defaultdict(self.fresh, {b"\n": 0, b"": -1})
        parts = b"\n".join(texts).translate(_SPLIT).replace(b"\n", b" \n ").split(b" ")
        row = np.fromiter(map(self.numbers[lang].__getitem__, parts), np.int32, len(parts))
        row = row[row >= 0]
        row = np.append(row[(row > 0) | (np.append(row[1:], 0) > 0)], np.int32(0))  # one separator of several
        self.rows.append(row)
        self.size += len(row)

    def emitted(self, name: int) -> pa.RecordBatch:
        """One row with the shard. Words are numbered by falling count, so that most numbers are small."""
        row = np.concatenate([np.zeros(1, np.int32), *self.rows])
        words, langs = [b""] * int(row.max() + 1), np.zeros(int(row.max()) + 1, np.int32)
        for i, numbers in enumerate(self.numbers.values()):
            for word, number in numbers.items():
                if number > 0:
                    words[number], langs[number] = word, i
        counts = np.bincount(row)
        order = np.argsort(-counts[1:], kind="stable") + 1
        places = np.zeros(len(counts), np.int32)
        places[order] = np.arange(1, len(counts))
        sizes = np.bincount(langs[1:], counts[1:], minlength=len(self.numbers)).astype(np.int64)
        return pa.RecordBatch.from_pydict({
            "shard": [name], "row": [_stored(places[row])], "size": [len(row)], "words": [_squeezed(b"\n".join([words[i] for i in order]))],
            "lang_of": [_stored(langs[order])], "counts": [_stored(counts[order])], "langs": [list(self.numbers)], "sizes": [sizes.tolist()],
        }, _SHARDS)


_SHARDS = pa.schema([
    ("shard", pa.int64()), ("row", pa.binary()), ("size", pa.int64()), ("words", pa.binary()), ("lang_of", pa.binary()),
    ("counts", pa.binary()), ("langs", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64())),
])
_SHARDS_SQL = (
    "shard long, row binary, size long, words binary, lang_of binary, counts binary, langs array<string>, sizes array<long>"
)


def _squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unsqueezed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _stored(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32, byte by byte of all of them: the higher bytes are nearly all zero and shrink."""
    return _squeezed(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _restored(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unsqueezed(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1).astype(np.int64)


def _batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A batch in which the columns that aren't given are null."""
    size = len(columns["shard"])
    made = [
        c.cast(f.type) if isinstance(c := columns.get(f.name), pa.Array) else pa.nulls(size, f.type) if c is None else pa.array(c, f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(made, schema=schema)


@releasing
def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    name, shard = TaskContext.get().partitionId() << 32, _Shard()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(sizes, SLICE):
            texts: defaultdict[str, list[bytes]] = defaultdict(list)
            part = batch.slice(a, b - a)
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").cast(pa.binary()).to_pylist(), strict=True):
                texts[lang].append(text or b"")
            for lang, own in texts.items():
                shard.add(lang, own)
            if shard.size >= SHARD_WORDS:
                yield shard.emitted(name)
                name, shard = name + 1, _Shard()
    if shard.size:
        yield shard.emitted(name)


def _hashes(langs: list[str], lang_of: np.ndarray, words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words of languages."""
    seeds = [xxhash.xxh3_64_intdigest(lang.encode()) for lang in langs]
    hashed = xxhash.xxh3_64_intdigest
    return np.fromiter((hashed(w, seeds[x]) for x, w in zip(lang_of.tolist(), words, strict=True)), np.uint64, len(words))


def _joined(first: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases that are one word longer."""
    x = (first * np.uint64(0x9E3779B97F4A7C15)) ^ (word * np.uint64(0xC2B2AE3D27D4EB4F))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _places(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Range (upper half) and value within it (lower half) of each hash."""
    at = (hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    return at << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)


#: kind is "values" or "named" (phrases of a shard for a range), "index" or "state" (of a shard). lang_of counts in langs.
_SENT = pa.schema([
    ("shard", pa.int64()), ("kind", pa.string()), ("range", pa.int64()), ("values", pa.binary()), ("counts", pa.binary()),
    ("phrases", pa.binary()), ("lang_of", pa.binary()), ("langs", pa.list_(pa.string())), ("symbols", pa.binary()), ("low", pa.binary()),
    ("back", pa.binary()), ("last", pa.binary()), ("last_back", pa.binary()),
])
_SENT_SQL = (
    "shard long, kind string, range long, values binary, counts binary, phrases binary, lang_of binary, "
    "langs array<string>, symbols binary, low binary, back binary, last binary, last_back binary"
)
_FOUND_SQL = "shard long, range long, values binary"


@dataclass
class Words:
    """Distinct words of a shard: languages (as numbers), texts, hashes and counts."""

    lang_of: np.ndarray
    names: np.ndarray  # of bytes objects
    hashes: np.ndarray
    counts: np.ndarray

    def take(self, which: np.ndarray) -> Words:
        return Words(self.lang_of[which], self.names[which], self.hashes[which], self.counts[which])


@dataclass
class Phrases:
    """Distinct phrases of a shard: the numbers of their words, a row each; intervals and hashes."""

    symbols: np.ndarray
    of: Intervals
    hashes: np.ndarray

    def take(self, which: np.ndarray) -> Phrases:
        of = Intervals(self.of.low[which], self.of.back[which], self.of.size[which])
        return Phrases(self.symbols[which], of, self.hashes[which])


def _listed(names: list[bytes]) -> np.ndarray:
    made = np.empty(len(names), object)
    made[:] = names
    return made


def _by_range(hashes: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]:
    """Order of phrases by place, their places in it, and range, first and end of each range that has some."""
    places = _places(hashes, ranges)
    order = np.argsort(places)
    places = places[order]
    at = (places >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(at)) + 1
    bounds = zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)], strict=True) if len(at) else ()
    return order, places, [(int(at[a]), a, b) for a, b in bounds]


def _ascending(values: np.ndarray) -> bytes:
    """Ascending values by their differences."""
    return _stored(np.diff(values, prepend=0))


def _values(shard: int, hashes: np.ndarray, counts: np.ndarray, ranges: int, least: int) -> pa.RecordBatch:
    """Values and counts of a shard's distinct phrases by range; counts above the least one are sent as that."""
    order, places, bounds = _by_range(hashes, ranges)
    counts = np.minimum(counts[order], least).astype(np.uint8 if least < 256 else np.uint32)
    values, n = (places & np.uint64(0xFFFFFFFF)).astype(np.int64), len(bounds)
    return _batch(
        _SENT, shard=[shard] * n, kind=["values"] * n, range=[r for r, _, _ in bounds],
        values=[_ascending(values[a:b]) for _, a, b in bounds], counts=[counts[a:b].tobytes() for _, a, b in bounds],
    )


def _named(shard: int, langs: list[str], words: Words, phrases: Phrases, ranges: int) -> pa.RecordBatch:
    """Words and counts of a shard's phrases by range."""
    order, _, bounds = _by_range(phrases.hashes, ranges)
    phrases, n = phrases.take(order), len(bounds)
    names = words.names[phrases.symbols[:, 0] - 1]
    for k in range(1, phrases.symbols.shape[1]):
        names = names + b" " + words.names[phrases.symbols[:, k] - 1]
    lang_of = words.lang_of[phrases.symbols[:, 0] - 1]
    return _batch(
        _SENT, shard=[shard] * n, kind=["named"] * n, range=[r for r, _, _ in bounds], langs=[langs] * n,
        phrases=[_squeezed(b"\n".join(names[a:b])) for _, a, b in bounds],
        lang_of=[_stored(lang_of[a:b]) for _, a, b in bounds], counts=[_stored(phrases.of.size[a:b]) for _, a, b in bounds],
    )


def _common(least: int):
    """Of a range, the values of each shard that are frequent over all shards."""

    def common(sent: pa.Table) -> pa.Table:
        values = [np.cumsum(_restored(x)) for x in sent.column("values").to_pylist()]
        kind = np.uint8 if least < 256 else np.uint32
        counts = np.concatenate([np.frombuffer(x, kind) for x in sent.column("counts").to_pylist()])
        every = np.concatenate(values)
        order = np.argsort(every)
        every = every[order]
        begins = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        frequent = every[begins][np.add.reduceat(counts[order].astype(np.int64), begins) >= least]
        found = [_ascending(x[np.isin(x, frequent)]) for x in values]
        return pa.table({
            "shard": _one(sent.column("shard")), "range": _one(sent.column("range")), "values": pa.array(found, pa.binary()),
        })

    return common


def _summed(least: int):
    """Of a range, the phrases that are frequent over all shards."""

    def total(sent: pa.Table) -> pa.Table:
        parts = []
        for row in sent.select(["langs", "phrases", "lang_of", "counts"]).to_pylist():
            langs = pa.array(row["langs"], pa.string()).take(pa.array(_restored(row["lang_of"])))
            phrases = pa.array(_unsqueezed(row["phrases"]).split(b"\n"), pa.binary())
            parts.append(pa.table([langs, phrases, pa.array(_restored(row["counts"]))], ["lang", "phrase", "f"]))
        found = pa.concat_tables(parts).group_by(["lang", "phrase"]).aggregate([("f", "sum")])
        found = found.select(["lang", "phrase", "f_sum"]).filter(pc.greater_equal(found.column("f_sum"), least))
        return found.rename_columns(["lang", "phrase", "f"]).cast(_TOTALS)

    return total


_TOTALS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])


def _kept(hashes: np.ndarray, ranges: int, found: pa.Table) -> np.ndarray:
    """Which hashes are among the frequent values that came back to a shard."""
    back = [
        np.cumsum(_restored(v)).astype(np.uint64) | np.uint64(r << 32)
        for r, v in zip(found.column("range").to_pylist(), found.column("values").to_pylist(), strict=True)
    ]
    return np.isin(_places(hashes, ranges), np.concatenate([np.zeros(0, np.uint64), *back]))


def _vocabulary(shard: dict) -> Words:
    """The words of a shard, by number from 1."""
    lang_of = _restored(shard["lang_of"])
    words = _unsqueezed(shard["words"]).split(b"\n") if len(lang_of) else []
    return Words(lang_of, _listed(words), _hashes(shard["langs"], lang_of, words), _restored(shard["counts"]))


def _words_sent(ranges: int, least: int):
    @releasing
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                words = _vocabulary(shard)
                yield _values(shard["shard"], words.hashes, words.counts, ranges, least)

    return send


@dataclass
class Intervals:
    """Places of phrases: the first row in either order of contexts, and how many rows."""

    low: np.ndarray
    back: np.ndarray
    size: np.ndarray


class FmIndex:
    """Last columns of the sorted contexts of a row and of its reverse; symbols are 0 (separator) to n_symbols - 1.

    Contexts are compared by `depth` symbols. Intervals of phrases shorter than that extend as in a full sort: the rows
    before an interval are those of smaller phrases, so the symbols among them count the rows before the extension."""

    def __init__(self, last: np.ndarray, last_back: np.ndarray, n_symbols: int) -> None:
        self.last, self.last_back = last, last_back
        sizes = np.bincount(last, minlength=n_symbols)
        self.starts = np.concatenate([[0], np.cumsum(sizes)])

    @classmethod
    def of(cls, row: np.ndarray, n_symbols: int, depth: int = LONGEST) -> FmIndex:
        return cls(_last_column(row, n_symbols, depth), _last_column(row[::-1], n_symbols, depth), n_symbols)

    def words(self, symbols: np.ndarray) -> Intervals:
        low = self.starts[symbols]
        return Intervals(low, low, self.starts[symbols + 1] - low)

    def left(self, of: Intervals) -> tuple[np.ndarray, np.ndarray]:
        """First row in forward order of each extension to the left, and which interval it extends."""
        low, _, which, _ = self._extended(self.last, of.low, of.size)
        return low, which

    def right(self, of: Intervals) -> tuple[Intervals, np.ndarray, np.ndarray]:
        """The extensions to the right, which interval each extends, and by what symbol."""
        back, size, which, symbol = self._extended(self.last_back, of.back, of.size)
        order = np.lexsort((symbol, which))
        back, size, which, symbol = back[order], size[order], which[order], symbol[order]
        before = np.cumsum(size) - size  # rows of smaller symbols in the interval stand before in forward order
        first = np.concatenate([[True], which[1:] != which[:-1]]) if len(which) else np.zeros(0, bool)
        within = before - np.repeat(before[first], np.diff(np.append(np.flatnonzero(first), len(which))))
        word = symbol > 0
        return Intervals((of.low[which] + within)[word], back[word], size[word]), which[word], symbol[word]

    def _extended(self, last: np.ndarray, low: np.ndarray, size: np.ndarray):
        """Extensions of disjoint intervals by every symbol in the last column: first row, size, interval, symbol.

        A row's symbol tells where the row one symbol longer stands. Those of one interval and symbol are neighbours."""
        owner = np.full(len(last), -1, np.int32)
        rows = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        owner[rows] = np.repeat(np.arange(len(low), dtype=np.int32), size)
        order = np.argsort(last, kind="stable")  # longer row -> row
        owner, symbol = owner[order], last[order]
        inside = np.flatnonzero(owner >= 0)
        owner, symbol = owner[inside], symbol[inside].astype(np.int64)
        cut = np.concatenate([[True], (owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1])]) if len(inside) else np.zeros(0, bool)
        begins = np.flatnonzero(cut)
        return inside[begins], np.diff(np.append(begins, len(inside))), owner[begins].astype(np.int64), symbol[begins]


def _last_column(row: np.ndarray, n_symbols: int, depth: int) -> np.ndarray:
    """The symbols before the contexts, in the order of the contexts' first symbols (cyclic)."""
    bits = max(1, int(n_symbols - 1).bit_length())
    each = min(depth, 63 // bits)
    keys = []
    for first in range(0, depth, each):
        key = np.zeros(len(row), np.int64)
        for k in range(first, min(first + each, depth)):
            key = (key << bits) | np.roll(row, -k)
        keys.append(key)
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    return row[order - 1].astype(np.uint16 if n_symbols <= 1 << 16 else np.int64)


def _pieces(row: np.ndarray) -> np.ndarray:
    """A row that begins and ends with a separator, with one of several in a row."""
    row = np.concatenate([[0], row, [0]])
    return np.append(row[:-1][(row[:-1] > 0) | (row[1:] > 0)], 0)


def _longer(index: FmIndex, of: Intervals) -> tuple[Intervals, np.ndarray, np.ndarray]:
    """Extensions by one word whose beginning and rest both are given: intervals, number of the beginning, word."""
    from_rest, _ = index.left(of)
    grown, which, symbol = index.right(of)
    both = np.isin(grown.low, from_rest, assume_unique=True)
    return Intervals(grown.low[both], grown.back[both], grown.size[both]), which[both], symbol[both]


def _grown(index: FmIndex, phrases: Phrases, words: Words) -> Phrases:
    """Extensions of all phrases by one word."""
    of, which, symbol = _longer(index, phrases.of)
    symbols = np.concatenate([phrases.symbols[which], symbol[:, None]], 1)
    return Phrases(symbols, of, _joined(phrases.hashes[which], words.hashes[symbol - 1]))


def _single(index: FmIndex, words: Words) -> Phrases:
    """The words themselves."""
    symbols = np.arange(1, len(words.names) + 1)
    return Phrases(symbols[:, None], index.words(symbols), words.hashes)


def _left(longer: Phrases, kept: np.ndarray) -> Phrases:
    """The phrases that are kept, in the order of their intervals."""
    kept = np.flatnonzero(kept)
    return longer.take(kept[np.argsort(longer.of.low[kept])])


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def _sent(batches: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(batches, schema=_SENT)


class _Frequent:
    """A shard in which the words that aren't left are separators; symbols are the others by number from 1."""

    def __init__(self, shard: dict, ranges: int, found: pa.Table) -> None:
        words = _vocabulary(shard)
        kept = np.flatnonzero(_kept(words.hashes, ranges, found))
        self.words = words.take(kept)
        symbols = np.zeros(len(words.names) + 1, np.int64)
        symbols[kept + 1] = np.arange(1, len(kept) + 1)
        self.row = _pieces(symbols[_restored(shard["row"])])


def _pairs_sent(ranges: int, least: int):
    """The words of a shard that are left, and the values of their pairs."""

    def send(shards: pa.Table, found: pa.Table) -> pa.Table:
        if not shards.num_rows or not found.num_rows:
            return _sent([])
        shard = shards.to_pylist()[0]
        own = _Frequent(shard, ranges, found)
        n = len(own.words.names)
        index = FmIndex.of(own.row, n + 1, 2)
        words = _single(index, own.words)
        pairs = _grown(index, words, own.words)
        return _sent([
            _named(shard["shard"], shard["langs"], own.words, words, ranges),
            _values(shard["shard"], pairs.hashes, pairs.of.size, ranges, least),
        ])

    return send


def _stored_phrases(shard: int, phrases: Phrases) -> pa.RecordBatch:
    columns = {"symbols": phrases.symbols.T.reshape(-1), "low": phrases.of.low, "back": phrases.of.back, "counts": phrases.of.size}
    return _batch(_SENT, shard=[shard], kind=["state"], **{name: [_stored(x)] for name, x in columns.items()})


def _restored_phrases(row: dict, words: Words) -> Phrases:
    of = Intervals(*(_restored(row[x]) for x in ("low", "back", "counts")))
    symbols = _restored(row["symbols"]).reshape(-1, len(of.low)).T if len(of.low) else np.zeros((0, 1), np.int64)
    hashes = words.hashes[symbols[:, 0] - 1]
    for k in range(1, symbols.shape[1]):
        hashes = _joined(hashes, words.hashes[symbols[:, k] - 1])
    return Phrases(symbols, of, hashes)


def _round(shard: int, langs: list[str], index: FmIndex, phrases: Phrases, words: Words, ranges: int, least: int, ahead: int):
    """What a shard sends in a round: its phrases, and if longer ones are to come, their intervals and the values of
    phrases that are up to `ahead` words longer."""
    yield _named(shard, langs, words, phrases, ranges)
    if ahead:
        yield _stored_phrases(shard, phrases)
        longer = _longer_ones(index, phrases, words, ahead)
        hashes, sizes = (np.concatenate(x) for x in zip(*((p.hashes, p.of.size) for p in longer), strict=True))
        yield _values(shard, hashes, sizes, ranges, least)


def _longer_ones(index: FmIndex, phrases: Phrases, words: Words, ahead: int) -> list[Phrases]:
    """The phrases that are one word longer, those that are two words longer, and so on."""
    found = [phrases]
    for _ in range(ahead):
        found.append(_grown(index, _left(found[-1], np.ones(len(found[-1].hashes), bool)), words))
    return found[1:]


def _indexed(ranges: int, least: int, ahead: int):
    """The index of a shard over the words of its pairs that are left, and its first round."""

    def build(shards: pa.Table, found: pa.Table) -> pa.Table:
        if not shards.num_rows or not found.num_rows:
            return _sent([])
        shard = shards.to_pylist()[0]
        level = found.column("level")
        own, pairs_left = _Frequent(shard, ranges, found.filter(pc.equal(level, 1))), found.filter(pc.equal(level, 2))
        first, second = own.row[:-1], own.row[1:]
        hashes = np.concatenate([np.zeros(1, np.uint64), own.words.hashes])
        pairs = (first > 0) & (second > 0)
        pairs[pairs] = _kept(_joined(hashes[first[pairs]], hashes[second[pairs]]), ranges, pairs_left)
        inside = np.append(pairs, False) | np.append(False, pairs)
        used = np.unique(own.row[inside])
        words = own.words.take(used - 1)
        symbols = np.zeros(len(hashes), np.int64)
        symbols[used] = np.arange(1, len(used) + 1)
        index = FmIndex.of(_pieces(np.where(inside, symbols[own.row], 0)), len(used) + 1)
        longer = _grown(index, _single(index, words), words)
        phrases = _left(longer, _kept(longer.hashes, ranges, pairs_left))
        named = _batch(
            _SENT, shard=[shard["shard"]], kind=["index"], langs=[shard["langs"]], phrases=[_squeezed(b"\n".join(words.names))],
            lang_of=[_stored(words.lang_of)], last=[_stored(index.last)], last_back=[_stored(index.last_back)],
        )
        return _sent([named, *_round(shard["shard"], shard["langs"], index, phrases, words, ranges, least, ahead)])

    return build


def _extended(ranges: int, least: int, more: int, ahead: int):
    """A further round of a shard: from its index and state, and the values of phrases up to `more` words longer that came
    back."""

    def extend(own: pa.Table, found: pa.Table) -> pa.Table:
        rows = {row["kind"]: row for row in own.to_pylist()}
        if "index" not in rows or "state" not in rows or not found.num_rows:
            return _sent([])
        index, langs = rows["index"], rows["index"]["langs"]
        lang_of = _restored(index["lang_of"])
        names = _unsqueezed(index["phrases"]).split(b"\n") if len(lang_of) else []
        words = Words(lang_of, _listed(names), _hashes(langs, lang_of, names), np.zeros(len(names), np.int64))
        kind = np.uint16 if len(names) < 1 << 16 else np.int64
        fm = FmIndex(*(_restored(index[x]).astype(kind) for x in ("last", "last_back")), len(names) + 1)
        longer = _longer_ones(fm, _restored_phrases(rows["state"], words), words, more)
        *whole, phrases = [_left(p, _kept(p.hashes, ranges, found)) for p in longer]
        named = [_named(index["shard"], langs, words, p, ranges) for p in whole]
        return _sent([*named, *_round(index["shard"], langs, fm, phrases, words, ranges, least, ahead)])

    return extend


def _returned(sent: DataFrame, least: int) -> DataFrame:
    values = sent.filter("kind = 'values'").select("range", "shard", "values", "counts")
    return values.groupBy("range").applyInArrow(_common(least), _FOUND_SQL)


def _totals(sent: DataFrame, least: int) -> DataFrame:
    named = sent.filter("kind = 'named'").select("range", "langs", "phrases", "lang_of", "counts")
    found = named.groupBy("range").applyInArrow(_summed(least), "lang string, phrase string, f long")
    return found.withColumn("words", F.size(F.split("phrase", " ")))


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """Words of each language (lang, n), and all phrases of up to `longest` (2 to LONGEST) words with at least that count,
    single words too: lang, phrase, f, words.

    Texts are lower-cased (A-Z) and split at `.,;:!?` and LF, VT, FF, CR into pieces, those into words at blanks and
    tabs. Counts are those of all places within pieces, overlaps included. Null texts are empty, a null lang is `und`.
    Repeated rows count again, ids and other columns don't matter, an empty table gives empty results.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(_NO_LANG))
    rows = docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text"))
    shards = written(rows.mapInArrow(_words, _SHARDS_SQL), "phrase-shards")
    sizes = shards.select(F.explode(F.arrays_zip("langs", "sizes")).alias("x")).groupBy(F.col("x.langs").alias("lang"))
    sizes = sizes.agg(F.sum("x.sizes").alias("n"))
    ranges = max(1, -(-(shards.agg(F.sum("size")).first()[0] or 0) // PER_RANGE))

    def both(own: DataFrame, found: DataFrame, step) -> DataFrame:
        return own.groupBy("shard").cogroup(found.groupBy("shard")).applyInArrow(step, _SENT_SQL)

    rows = shards.select("shard", "row", "words", "lang_of", "counts", "langs")
    found = _returned(rows.drop("row").mapInArrow(_words_sent(ranges, least), _SENT_SQL), least)
    words = written(found.withColumn("level", F.lit(1)), "frequent-words")
    sent = written(both(rows, words, _pairs_sent(ranges, least)), "phrases-1")
    counts = _totals(sent, least)
    found = words.unionByName(_returned(sent, least).withColumn("level", F.lit(2)))
    index = sent = written(both(rows, found, _indexed(ranges, least, min(1, longest - 2))), "phrases-2")
    counts = counts.unionByName(_totals(sent, least))
    # most triples are rare; few places are left after them, so all that is longer goes in one round
    more = [x for x in (1, longest - 3) if x > 0][: max(0, longest - 2)]
    for i, words_more in enumerate(more):
        own = index.filter("kind = 'index'").unionByName(sent.filter("kind = 'state'"))
        step = _extended(ranges, least, words_more, more[i + 1] if i + 1 < len(more) else 0)
        sent = written(both(own, _returned(sent, least), step), "longer-phrases")
        counts = counts.unionByName(_totals(sent, least))
    return sizes, written(counts, "phrase-counts")


def _words_of(phrase: Column, first: Column | int, n: Column | int) -> Column:
    return F.array_join(F.slice(F.split(phrase, " "), first, n), " ")


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in exact arithmetic of 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    top = (wide(a) * wide(n)).cast("decimal(35,0)") * F.lit(1000).cast("decimal(4,0)")
    under = (wide(left) * wide(right)).cast("decimal(38,0)")
    return F.call_function("div", top.cast("decimal(38,0)"), under)


def scored(sizes: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases of two words and more with the cut that scores lowest: lang, phrase, a, l, r, n, score, and what may stand
    beside them: most_beside, the largest count of a phrase that is one word longer and holds it (null: none is counted).

    A cut after the first k words gives l = f(first part), r = f(rest) and floor(1000 a n / (l r)); of equal scores the
    smallest k counts. All parts of a frequent phrase are frequent, so every join finds its row.
    """
    parts = counts.select(F.col("lang").alias("in"), F.col("phrase").alias("part"), F.col("f").alias("of_part"))
    longer = counts.filter("words > 1").select("lang", "phrase", F.col("f").alias("a"), "words")
    cuts = longer.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    for name, part in (("l", _words_of(F.col("phrase"), F.lit(1), F.col("k"))), ("r", _words_of(F.col("phrase"), F.col("k") + 1, F.col("words")))):
        named = cuts.withColumn("own", part)
        joined = named.join(parts.hint("merge"), (F.col("lang") == F.col("in")) & (F.col("own") == F.col("part")))
        cuts = joined.withColumnRenamed("of_part", name).drop("in", "part", "own")
    cuts = cuts.join(sizes.select(F.col("lang").alias("in"), "n").hint("merge"), F.col("lang") == F.col("in")).drop("in")
    best = F.min(F.struct(_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("best")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(best)
    shorter = F.array(_words_of(F.col("phrase"), F.lit(1), F.col("words") - 1), _words_of(F.col("phrase"), F.lit(2), F.col("words")))
    beside = longer.filter("words > 2").select(F.col("lang").alias("in"), F.explode(shorter).alias("part"), "a")
    beside = beside.groupBy("in", "part").agg(F.max("a").alias("most_beside"))
    joined = best.join(beside.hint("merge"), (F.col("lang") == F.col("in")) & (F.col("phrase") == F.col("part")), "left")
    return joined.select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score", "most_beside")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, most: int = MOST) -> DataFrame:
    """The `most` best phrases of each language: lang, rank, phrase, a, l, r, n, score; see `phrase_counts`, `scored`.

    A phrase that some longer candidate contains as often as it occurs is left out; then one that is one word longer does
    so too. Ranked by score, then count, both falling, then by phrase in byte order. Languages are first ranked in parts.
    """
    sizes, counts = phrase_counts(docs, least, longest)
    found = scored(sizes, counts).filter("most_beside IS NULL OR most_beside < a")
    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    found = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_IN)))
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    found = found.filter(F.col("rank") <= most)  # no part can give more than all
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return found.filter(F.col("rank") <= most).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best collocations of each language."""
    return collocations(table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS t,
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
s AS (SELECT lang, t, unnest(pieces) AS piece, unnest(range(0, len(pieces))) AS i FROM p),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM s),
g AS (
  SELECT lang, array_to_string(words[i + 1:i + k], ' ') AS phrase, k
  FROM (SELECT lang, words, k, unnest(range(0, greatest(len(words) - k + 1, 0))) AS i FROM w, (SELECT unnest(range(1, 6)) AS k))),
f AS (SELECT lang, phrase, k, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k > 1 AND f >= 100),
cut AS (SELECT *, unnest(range(1, k)) AS j FROM c),
scores AS (
  SELECT cut.lang, cut.phrase, a, l.f AS l, r.f AS r, n, j,
    (1000::HUGEINT * a * n // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cut
  JOIN f l ON l.lang = cut.lang AND l.phrase = array_to_string(words[1:j], ' ')
  JOIN f r ON r.lang = cut.lang AND r.phrase = array_to_string(words[j + 1:], ' ')
  JOIN n ON n.lang = cut.lang),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, array_to_string(words[i + 1:i + m], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(0, k - m + 1)) AS i FROM c, (SELECT unnest(range(2, 5)) AS m) WHERE m < k)
  GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000
"""
