"""Repeated passages by prefix-free parsing.

Every 50-byte string that a document shares with an earlier one is removed. The strings are too many to be sorted one
by one, so the text is parsed first: a rolling hash runs over it, and within the grams of a 50-byte window the one with
the least hash is the window's trigger. Windows in a row with one trigger form a phrase. Consecutive phrases overlap by
49 bytes, so each window lies in exactly one phrase, and two equal windows lie in phrases with one trigger.

* The parse of a chunk of documents is its list of (trigger, phrase) names. Chunks are ranges of doc_id. Buckets of
  triggers compare the parses: a phrase that an earlier chunk has too is removed as a whole, wherever it occurs.
* The dictionary holds one copy of each phrase whose trigger also occurs with other phrases. Its suffixes of at least
  50 bytes, sorted, bring equal windows together; each takes the first document of all phrases in its class.
* A trigger with too many open windows for a task is dealt out by hashes of its windows: equal windows still meet, each
  distinct one comes once from a chunk, and the least document of each goes back to the chunks.

In highly repetitive text nearly everything is settled by the parse, and the dictionary stays small. Trigger names may
collide (that only makes two phrases meet whose windows then differ); phrase names have 56 bits within a trigger.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bytes_of, shared_folder, table, written

LENGTH = 50
#: Bytes of a trigger gram; a window of LENGTH bytes holds LENGTH - GRAM + 1 of them.
GRAM = 16
#: Bytes of text that a chunk holds about, that a task parses at once, and for which there is one bucket of triggers.
CHUNK, SLICE, PER_BUCKET = 8 << 20, 1 << 20, 12 << 20

_BASE, _MIX, _NAME = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PLACE = np.uint64((1 << 22) - 1)
_LOW40, _LOW56 = np.uint64((1 << 40) - 1), np.uint64((1 << 56) - 1)
_BYTE_CODES = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_NO_ID = -(1 << 63)

_SPAN = np.dtype([("row", "<i8"), ("start", "<i8"), ("end", "<i8")])
_PHRASE = np.dtype([("trigger", "<u8"), ("doc", "<i8"), ("row", "<i8"), ("start", "<i8"), ("size", "<i4"), ("chunk", "<i4")])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, for positions up to n."""
    if 0 not in _POWERS or len(_POWERS[0][0]) <= n:
        up, down = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[0] = np.cumprod(up), np.cumprod(down)
    return _POWERS[0]


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` keys in a row, by doubling."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def parse(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Phrases of some documents that lie in a row: document, first window, end of the phrase, trigger and phrase names.

    `at` says where the documents begin, with the end; places count from the start of `codes`."""
    windows = np.maximum(np.diff(at) - (LENGTH - 1), 0)
    n = int(windows.sum())
    if not n:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    up, down = _powers(len(codes))
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[codes] * up[: len(codes)], out=total[1:])
    grams = (total[GRAM:] - total[:-GRAM]) * down[: len(codes) + 1 - GRAM]
    keys = ((grams ^ (grams >> np.uint64(29))) * _MIX) & ~_PLACE | np.arange(len(grams), dtype=np.uint64)
    trigger = _least(keys, LENGTH - GRAM + 1) & _PLACE
    x = np.arange(n) + np.repeat(at[:-1] - (np.cumsum(windows) - windows), windows)
    own = trigger[x]
    first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    last = np.append(first[1:], n) - 1
    start, end, place = x[first], x[last] + LENGTH, own[first].astype(np.int64)
    name = grams[place]
    name = ((name ^ (name >> np.uint64(32))) * _NAME) ^ (name >> np.uint64(17))
    phrase = (total[end] - total[start]) * down[start]
    phrase = ((phrase ^ (phrase >> np.uint64(31))) + (end - start).astype(np.uint64)) * _MIX
    doc = np.searchsorted(at, start, "right") - 1
    return doc, start, end, name, (phrase ^ (phrase >> np.uint64(30))) & _LOW56


class Parse:
    """All phrases of a chunk, and its entries: distinct (bucket, trigger, phrase), sorted."""

    def __init__(self, rows: pa.Table, n_buckets: int):
        self.codes, self.at = bytes_of(rows.column("text"))
        self.ids = rows.column("doc_id").cast(pa.int64()).fill_null(_NO_ID).to_numpy()
        self.rows = rows.column("row").to_numpy()
        parts = [self._piece(*p) for p in self._pieces()]
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else list(parse(self.codes, self.at))
        self.doc, self.start, self.end, name, phrase = columns
        # buckets and 40-bit names within them, in one number
        entry = ((name >> np.uint64(40)) % np.uint64(n_buckets)) << np.uint64(40) | (name & _LOW40)
        order = np.lexsort((phrase, entry))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (entry[order][1:] != entry[order][:-1]) | (phrase[order][1:] != phrase[order][:-1])
        self.entry_of = np.empty(len(order), np.int64)
        self.entry_of[order] = np.cumsum(fresh) - 1
        self.triggers, self.phrases = entry[order][fresh], phrase[order][fresh]
        firsts = np.flatnonzero(fresh)
        ids = self.ids[self.doc]
        self.first_id = np.minimum.reduceat(ids[order], firsts) if len(firsts) else np.zeros(0, np.int64)

    def _pieces(self) -> Iterator[tuple[int, int, int, int]]:
        """Ranges of documents, or a range of windows within a long one: (document, documents, start, end)."""
        i, n = 0, len(self.at) - 1
        while i < n:
            if self.at[i + 1] - self.at[i] > SLICE:
                for start in range(int(self.at[i]), int(self.at[i + 1]), SLICE):
                    yield i, 1, start, min(start + SLICE + LENGTH - 1, int(self.at[i + 1]))
                i += 1
                continue
            j = max(i + 1, int(np.searchsorted(self.at, self.at[i] + SLICE, "right")) - 1)
            yield i, j - i, int(self.at[i]), int(self.at[j])
            i = j

    def _piece(self, doc: int, n: int, start: int, end: int) -> tuple[np.ndarray, ...]:
        at = self.at[doc : doc + n + 1] - start if n > 1 or end - start <= SLICE else np.array([0, end - start])
        at = np.clip(at, 0, end - start)
        d, s, e, name, phrase = parse(self.codes[start:end], at)
        return d + doc, s + start, e + start, name, phrase


def _spans(rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), _SPAN)
    out["row"], out["start"], out["end"] = rows, start, end
    return out


def _merged(spans: np.ndarray) -> np.ndarray:
    """Union of spans by row: sorted, apart from each other."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["start"], spans["row"]))]
    # rows are set apart on one number line, so that a running maximum of the ends stays within a row
    rows = np.concatenate([[0], np.cumsum(spans["row"][1:] != spans["row"][:-1])])
    gap = int(spans["end"].max()) + 1
    start, end = spans["start"] + rows * gap, np.maximum.accumulate(spans["end"] + rows * gap)
    fresh = np.concatenate([[True], start[1:] > end[:-1]])
    firsts = np.flatnonzero(fresh)
    out = spans[firsts].copy()
    out["end"] = end[np.append(firsts[1:], len(spans)) - 1] - rows[firsts] * gap
    return out


def _bytes(column: np.ndarray, n: int) -> np.ndarray:
    """The low n bytes of each number."""
    return np.ascontiguousarray(column.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n])


def _numbers(data: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((len(data) // n, 8), np.uint8)
    out[:, :n] = data.reshape(-1, n)
    return out.view("<u8").ravel()


def _parses(n_buckets: int):
    def emit(rows: pa.Table) -> pa.Table:
        chunk = rows.column("chunk")[0].as_py()
        p = Parse(rows.drop_columns(["chunk"]), n_buckets)
        buckets = (p.triggers >> np.uint64(40)).astype(np.int64)
        found, cuts = np.unique(buckets, return_index=True)
        cuts = np.append(cuts, len(buckets)).tolist()
        names, phrases = _bytes(p.triggers, 5), _bytes(p.phrases, 7)
        data = [names[a:b].tobytes() + phrases[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
        return pa.table(
            {"bucket": pa.array(found, pa.int32()), "chunk": pa.array([chunk] * len(found), pa.int32()), "data": pa.array(data, pa.binary())}
        )

    return emit


def _compare(rows: pa.Table) -> pa.Table:
    """What becomes of each entry of each chunk in a bucket: 1 if an earlier chunk has it, 2 if its trigger also
    occurs with another phrase, else 0."""
    bucket = rows.column("bucket")[0].as_py()
    chunks = rows.column("chunk").to_numpy()
    parts = [np.frombuffer(x, np.uint8) for x in rows.column("data").to_pylist()]
    sizes = np.array([len(x) // 12 for x in parts])
    trigger = np.concatenate([_numbers(x[: n * 5], 5) for x, n in zip(parts, sizes.tolist(), strict=True)])
    phrase = np.concatenate([_numbers(x[n * 5 :], 7) for x, n in zip(parts, sizes.tolist(), strict=True)])
    order = np.lexsort((np.repeat(chunks, sizes), phrase, trigger))
    t, p = trigger[order], phrase[order]
    new_trigger = np.concatenate([[True], t[1:] != t[:-1]])
    new_phrase = new_trigger | np.concatenate([[True], p[1:] != p[:-1]])
    group = np.cumsum(new_trigger) - 1
    several = np.bincount(group, weights=new_phrase) > 1
    status = np.empty(len(order), np.uint8)
    status[order] = np.where(new_phrase, np.where(several[group], 2, 0), 1)
    ends = np.cumsum(sizes)
    data = [status[e - n : e].tobytes() for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
    return pa.table(
        {"chunk": pa.array(chunks, pa.int32()), "bucket": pa.array([bucket] * len(chunks), pa.int32()), "data": pa.array(data, pa.binary())}
    )


_SETTLED = "chunk int, bucket int, kind int, windows long, meta binary, data binary"


def _settle(n_buckets: int):
    """From a chunk and the statuses of its entries: spans that are settled (kind 0), and for each bucket the phrases
    of the dictionary (kind 1)."""

    def settle(rows: pa.Table, statuses: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return _arrow(_SETTLED).empty_table()
        chunk = rows.column("chunk")[0].as_py()
        p = Parse(rows.drop_columns(["chunk"]), n_buckets)
        parts = statuses.sort_by("bucket").column("data").to_pylist()
        status = np.frombuffer(b"".join(parts), np.uint8)
        if len(status) != len(p.triggers):
            raise RuntimeError("a chunk was parsed in two ways")
        own, ids, row = status[p.entry_of], p.ids[p.doc], p.rows[p.doc]
        origin = p.at[p.doc]
        gone = (own == 1) | (ids > p.first_id[p.entry_of])
        spans = _merged(_spans(row[gone], (p.start - origin)[gone], (p.end - origin)[gone]))
        out = [(chunk, None, 0, None, spans.tobytes(), None)]
        open_ = np.flatnonzero(~gone & (own == 2))
        trigger = p.triggers[p.entry_of[open_]]
        order = np.argsort(trigger >> np.uint64(40), kind="stable")
        open_, trigger = open_[order], trigger[order]
        buckets, cuts = np.unique((trigger >> np.uint64(40)).astype(np.int64), return_index=True)
        cuts = np.append(cuts, len(open_)).tolist()
        data = p.codes.tobytes()
        for bucket, a, b in zip(buckets.tolist(), cuts, cuts[1:], strict=False):
            i = open_[a:b]
            meta = np.empty(len(i), _PHRASE)
            meta["trigger"], meta["doc"], meta["row"], meta["chunk"] = trigger[a:b], ids[i], row[i], chunk
            meta["start"], meta["size"] = (p.start - origin)[i], (p.end - p.start)[i]
            text = b"".join([data[s:e] for s, e in zip(p.start[i].tolist(), p.end[i].tolist(), strict=True)])
            out.append((chunk, bucket, 1, len(text) - (LENGTH - 1) * len(i), meta.tobytes(), text))
        return _rows(out, _SETTLED)

    return settle


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _rows(rows: list[tuple], ddl: str) -> pa.Table:
    schema = _arrow(ddl)
    if not rows:
        return schema.empty_table()
    return pa.table(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)


#: Windows of the dictionary that are sorted at once, and that a trigger has before it is dealt out.
_SORTED = 1 << 20


def _dictionary(rows: pa.Table) -> pa.Table:
    """Spans of the dictionary's windows that an earlier document has too, from the sorted suffixes of a bucket."""
    meta, text = _open(rows)
    begin = np.cumsum(meta["size"], dtype=np.int64) - meta["size"]
    order = np.argsort(meta["trigger"], kind="stable")
    windows = np.cumsum(meta["size"][order].astype(np.int64) - LENGTH + 1)
    fresh = np.concatenate([[True], meta["trigger"][order][1:] != meta["trigger"][order][:-1]])
    found, a = [], 0
    borders = np.append(np.flatnonzero(fresh), len(order))
    while a < len(order):  # whole triggers, a bounded number of windows at a time
        done = windows[a - 1] if a else 0
        k = int(np.searchsorted(windows, done + _SORTED, "right"))
        b = int(borders[max(np.searchsorted(borders, k, "right") - 1, 0)])
        if b <= a:
            b = int(borders[np.searchsorted(borders, a, "right")])
        found.append(_shared(meta[order[a:b]], begin[order[a:b]], text))
        a = b
    spans = np.concatenate(found) if found else np.zeros(0, [*_SPAN.descr, ("chunk", "<i4")])
    chunks = np.unique(spans["chunk"])
    data = [_merged(_spans(*(spans[spans["chunk"] == c][k] for k in ("row", "start", "end")))).tobytes() for c in chunks]
    return pa.table({"chunk": pa.array(chunks, pa.int32()), "meta": pa.array(data, pa.binary())})


def _words(text: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The windows that begin at these places, as numbers of 8 bytes each."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    words = []
    for k in range(0, LENGTH, 8):
        n = min(8, LENGTH - k)
        word = np.zeros(len(at), np.uint64)
        for j in range(n):
            word = (word << np.uint64(8)) | padded[at + k + j]
        words.append(word)
    return words


def _shared(meta: np.ndarray, begin: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Sorts the suffixes of some phrases by trigger and by their first LENGTH bytes.

    Suffixes whose window has a hash of its own are left out first: nothing else begins like them."""
    counts = meta["size"].astype(np.int64) - LENGTH + 1
    phrase = np.repeat(np.arange(len(meta)), counts)
    offset = np.arange(len(phrase)) - np.repeat(np.cumsum(counts) - counts, counts)
    sizes = meta["size"].astype(np.int64)
    own = np.cumsum(sizes) - sizes
    text, begin = text[np.repeat(begin - own, sizes) + np.arange(int(sizes.sum()))], own  # only these phrases
    again = _met_again(text, begin[phrase] + offset)
    phrase, offset = phrase[again], offset[again]
    if not len(phrase):
        return np.zeros(0, [*_SPAN.descr, ("chunk", "<i4")])
    words = _words(text, begin[phrase] + offset)
    trigger = np.concatenate([[0], np.cumsum(meta["trigger"][1:] != meta["trigger"][:-1])])[phrase]
    order = np.lexsort((*words[::-1], trigger))
    fresh = np.ones(len(order), bool)
    fresh[1:] = trigger[order][1:] != trigger[order][:-1]
    for word in words:
        fresh[1:] |= word[order][1:] != word[order][:-1]
    group = np.cumsum(fresh) - 1
    doc = meta["doc"][phrase][order]
    least = np.minimum.reduceat(doc, np.flatnonzero(fresh))
    gone = order[doc > least[group]]
    out = np.empty(len(gone), [*_SPAN.descr, ("chunk", "<i4")])
    start = meta["start"][phrase[gone]] + offset[gone]
    out["row"], out["start"], out["end"], out["chunk"] = meta["row"][phrase[gone]], start, start + LENGTH, meta["chunk"][phrase[gone]]
    return out


def _met_again(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the windows that begin at these places have the hash of another one."""
    up, down = _powers(len(text))
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[text] * up[: len(text)], out=total[1:])
    name = (total[at + LENGTH] - total[at]) * down[at]
    name = (name ^ (name >> np.uint64(31))) * _MIX
    order = np.argsort(name)
    same = name[order[1:]] == name[order[:-1]]
    again = np.zeros(len(at), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return np.flatnonzero(again)


_WINDOWS = "chunk int, bucket int, kind int, trigger long, salt int, docs binary, meta binary, data binary"
_LEAST = "chunk int, trigger long, salt int, docs binary"


def _open(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Phrases and their text of some rows of the dictionary."""
    meta = np.frombuffer(b"".join(rows.column("meta").to_pylist()), _PHRASE)
    return meta, np.frombuffer(b"".join(rows.column("data").to_pylist()), np.uint8)


def _counted(rows: pa.Table) -> pa.Table:
    """Open windows of each trigger of a chunk."""
    meta = np.frombuffer(b"".join(rows.column("meta").to_pylist()), _PHRASE)
    triggers, group = np.unique(meta["trigger"], return_inverse=True)
    n = np.bincount(group, weights=meta["size"] - (LENGTH - 1)).astype(np.int64)
    return pa.table({"trigger": pa.array(triggers.astype(np.int64)), "n": pa.array(n)})


def _distinct(meta: np.ndarray, text: np.ndarray, hot: dict[int, int]) -> Iterator[tuple]:
    """For each hot trigger (with its number of salts) and each salt: phrase, offset and number of every window, and the
    place and least document of every distinct window, by the order of their bytes."""
    begin = np.cumsum(meta["size"], dtype=np.int64) - meta["size"]
    up, down = _powers(len(text))
    total = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[text] * up[: len(text)], out=total[1:])
    for trigger in np.intersect1d(meta["trigger"], np.array(list(hot), np.uint64)).tolist():
        i = np.flatnonzero(meta["trigger"] == trigger)
        counts = meta["size"][i].astype(np.int64) - LENGTH + 1
        phrase = np.repeat(i, counts)
        offset = np.arange(len(phrase)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = begin[phrase] + offset
        name = (total[at + LENGTH] - total[at]) * down[at]
        name = ((name ^ (name >> np.uint64(31))) * _MIX) >> np.uint64(24)
        salt = (name % np.uint64(hot[trigger])).astype(np.int64)
        order = np.argsort(salt, kind="stable")
        found, cuts = np.unique(salt[order], return_index=True)
        cuts = np.append(cuts, len(order)).tolist()
        for s, a, b in zip(found.tolist(), cuts, cuts[1:], strict=False):
            own = order[a:b]
            by_bytes, group = _classes(_words(text, at[own]))
            firsts = np.flatnonzero(np.diff(group, prepend=-1))
            number = np.empty(len(own), np.int64)
            number[by_bytes] = group
            docs = meta["doc"][phrase[own]]
            yield trigger, s, phrase[own], offset[own], number, at[own][by_bytes][firsts], np.minimum.reduceat(docs[by_bytes], firsts)


def _classes(words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order of windows by their bytes, and in that order the number of each one's class of equal windows."""
    order = np.lexsort(words[::-1])
    fresh = np.zeros(len(order), bool)
    for word in words:
        fresh[1:] |= word[order][1:] != word[order][:-1]
    return order, np.cumsum(fresh)


def _dealt(hot: dict[int, int]):
    """A chunk's rows of the buckets that have hot triggers: the phrases of other triggers (kind 1), and by salt the
    distinct windows of hot ones with their least documents (kind 2)."""

    def deal(rows: pa.Table) -> pa.Table:
        chunk, out = rows.column("chunk")[0].as_py(), []
        for k, bucket in enumerate(rows.column("bucket").to_pylist()):
            meta, text = _open(rows.slice(k, 1))
            cold = ~np.isin(meta["trigger"], np.array(list(hot), np.uint64))
            if cold.any():
                rest = text[np.repeat(cold, meta["size"])]
                out.append((chunk, bucket, 1, None, None, None, meta[cold].tobytes(), rest.tobytes()))
            for trigger, salt, _, _, _, at, docs in _distinct(meta, text, hot):
                keys = np.lib.stride_tricks.sliding_window_view(text, LENGTH)[at]
                out.append((chunk, bucket, 2, trigger, salt, docs.tobytes(), None, keys.tobytes()))
        return _rows(out, _WINDOWS)

    return deal


def _least_documents(rows: pa.Table) -> pa.Table:
    """The least document of each distinct window of each chunk, over all chunks."""
    docs = [np.frombuffer(x, np.int64) for x in rows.column("docs").to_pylist()]
    keys = np.frombuffer(b"".join(rows.column("data").to_pylist()), np.uint8)
    doc = np.concatenate(docs)
    order, group = _classes(_words(keys, np.arange(len(doc)) * LENGTH))
    least = np.empty(len(doc), np.int64)
    least[order] = np.minimum.reduceat(doc[order], np.flatnonzero(np.diff(group, prepend=-1)))[group]
    parts = np.split(least, np.cumsum([len(x) for x in docs])[:-1])
    return rows.select(["chunk", "trigger", "salt"]).append_column("docs", pa.array([x.tobytes() for x in parts], pa.binary()))


def _told(hot: dict[int, int]):
    """Spans of a chunk's windows of hot triggers that an earlier document has too."""

    def told(rows: pa.Table, answers: pa.Table) -> pa.Table:
        columns = (answers.column(c).to_pylist() for c in ("trigger", "salt", "docs"))
        least = {(t, s): np.frombuffer(d, np.int64) for t, s, d in zip(*columns, strict=True)}
        out = []
        for k in range(rows.num_rows):
            meta, text = _open(rows.slice(k, 1))
            for trigger, salt, phrase, offset, number, _, _ in _distinct(meta, text, hot):
                gone = np.flatnonzero(meta["doc"][phrase] > least[trigger, salt][number])
                start = meta["start"][phrase[gone]] + offset[gone]
                out.append(_merged(_spans(meta["row"][phrase[gone]], start, start + LENGTH)))
        spans = _merged(np.concatenate(out)) if out else np.zeros(0, _SPAN)
        chunks = rows.column("chunk").to_pylist()[:1]
        return pa.table({"chunk": pa.array(chunks, pa.int32()), "meta": pa.array([spans.tobytes()] * len(chunks), pa.binary())})

    return told


def _dictionary_spans(rest: DataFrame) -> DataFrame:
    """Spans of the dictionary: bucket by bucket, but for triggers with more windows than are sorted at once."""
    spans = "chunk int, meta binary"
    by_bucket = lambda df: df.select("bucket", "meta", "data").groupBy("bucket").applyInArrow(_dictionary, spans)
    large = [r.bucket for r in rest.groupBy("bucket").agg(F.sum("windows").alias("n")).filter(F.col("n") > _SORTED).collect()]
    if not large:
        return by_bucket(rest)
    counts = rest.filter(F.col("bucket").isin(large)).select("chunk", "meta").groupBy("chunk")
    counts = counts.applyInArrow(_counted, "trigger long, n long").groupBy("trigger").agg(F.sum("n").alias("n"))
    # each of these has more than _SORTED windows, so they are few
    hot = {r.trigger: -(-2 * r.n // _SORTED) for r in counts.filter(F.col("n") > _SORTED).collect()}
    if not hot:
        return by_bucket(rest)
    is_hot = F.col("bucket").isin(sorted({t >> 40 for t in hot}))
    mixed = rest.filter(is_hot).select("chunk", "bucket", "meta", "data")
    dealt = written(mixed.groupBy("chunk").applyInArrow(_dealt(hot), _WINDOWS), "dealt")
    cold = rest.filter(~is_hot).select("bucket", "meta", "data")
    cold = cold.unionByName(dealt.filter("kind = 1").select("bucket", "meta", "data"))
    windows = dealt.filter("kind = 2").select("chunk", "trigger", "salt", "docs", "data")
    answers = windows.groupBy("trigger", "salt").applyInArrow(_least_documents, _LEAST)
    told = mixed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_told(hot), spans)
    return by_bucket(cold).unionByName(told)


def _cut(id_type: pa.DataType):
    """Each document of a chunk without its spans."""

    def cut(rows: pa.Table, spans: pa.Table) -> pa.Table:
        codes, at = bytes_of(rows.column("text"))
        parts = spans.column("meta").to_pylist()
        all_spans = _merged(np.frombuffer(b"".join(parts), _SPAN))
        ids = rows.column("row").to_numpy()
        first, last = (np.searchsorted(all_spans["row"], ids, side) for side in ("left", "right"))
        data, out = codes.tobytes(), []
        starts, ends = all_spans["start"].tolist(), all_spans["end"].tolist()
        for i, (a, b) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
            text, digest, done = data[at[i] : at[i + 1]], hashlib.sha256(), 0
            for k in range(a, b):
                digest.update(text[done : starts[k]])
                done = ends[k]
            digest.update(text[done:])
            removed = sum(ends[a:b]) - sum(starts[a:b])
            runs = ",".join(f"{starts[k]}:{ends[k]}" for k in range(a, b))
            out.append((len(text), removed, b - a, digest.hexdigest(), runs))
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        arrays = [rows.column("doc_id").cast(id_type), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
        return pa.table(dict(zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"), arrays, strict=True)))

    return cut


def in_chunks(docs: DataFrame, n_chunks: int) -> DataFrame:
    """row, chunk, doc_id, text of all documents as a table bucketed by chunk; chunks are ranges of doc_id, null first.

    The table is written once, so every later pass sees the same chunks and needs no shuffle of texts."""
    spark = docs.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    rows = rows.repartitionByRange(n_chunks, "doc_id").withColumns(
        {"chunk": F.spark_partition_id(), "row": F.monotonically_increasing_id()}
    )
    writer = rows.write.bucketBy(n_chunks, "chunk").option("path", f"{shared_folder(spark)}/{name}")
    writer.option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (runs as `start:end`, in bytes).

    A byte is removed if it lies in a LENGTH-byte string that also starts in a document with a smaller doc_id. Null
    texts count as empty; a null doc_id is smaller than all others; rows of one doc_id don't take from each other.
    Other columns don't matter; an empty table gives an empty result.
    """
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    n_chunks, n_buckets = max(1, -(-total // CHUNK)), max(1, -(-total // PER_BUCKET))
    chunks = in_chunks(docs, n_chunks)
    by_chunk = lambda df: df.groupBy("chunk")
    parses = by_chunk(chunks).applyInArrow(_parses(n_buckets), "bucket int, chunk int, data binary")
    statuses = parses.groupBy("bucket").applyInArrow(_compare, "chunk int, bucket int, data binary")
    settled = written(by_chunk(chunks).cogroup(by_chunk(statuses)).applyInArrow(_settle(n_buckets), _SETTLED), "settled")
    spans = settled.filter("kind = 0").select("chunk", "meta")
    spans = spans.unionByName(_dictionary_spans(settled.filter("kind = 1").drop("kind")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = by_chunk(chunks).cogroup(by_chunk(spans)).applyInArrow(
        _cut(pa.int64()), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed string"
    )
    return cut.withColumn("doc_id", F.col("doc_id").cast(kind))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of earlier ones."""
    return repeated_spans(table(spark, sf_dir, "documents"))
