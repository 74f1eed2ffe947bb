"""SentencePiece encoding and decoding by a batched Viterbi search in numpy.

Texts fall into segments at borders that no piece crosses. New segments are gathered, and those of equal length advance
together: at each end position the hashes of all substrings probe the sorted hashes of the pieces, every piece that
can end there is joined to the best path at its beginning, and the vectorised maximum keeps one backpointer.

For a model of the unigram type, the path with the largest sum of piece scores is the encoding. For a model of the
merge (BPE) type, the encoding is the one sequence in which no neighbouring pair of pieces could have been merged
earlier than the pieces themselves; the search then scores such pairs as impossible, and the path that remains is
exactly the one that merging finds. The model's own type decides.
"""

from __future__ import annotations

import heapq
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import releasing, table, text_slices

#: Where the vocabulary lies; its contents travel with the tasks.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"

SPACE = "▁"
#: Segments whose ids a task remembers, and bytes of text that it encodes at once.
KNOWN_SEGMENTS, SLICE = 400_000, 1_000_000
#: Cells (segments times length) that advance together.
CELLS = 1 << 19

_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 20
_NEVER = np.iinfo(np.int64).max


def _hash_of(codes: np.ndarray) -> int:
    h = 0
    for c in codes.tolist():
        h = (h * int(_BASE) + c + 1) & 0xFFFFFFFFFFFFFFFF
    return h


@dataclass
class Vocabulary:
    """Pieces of a model, their sorted hashes, and for the merge type how pieces come apart and go together."""

    pieces: list[str]
    scores: np.ndarray
    kinds: np.ndarray
    unigram: bool
    prefix: bool  # whether a space is put before a text
    hashes: np.ndarray = field(init=False)  # sorted
    ids: np.ndarray = field(init=False)  # of the sorted hashes
    longest: int = field(init=False)
    byte_ids: np.ndarray = field(init=False)
    rank: np.ndarray = field(init=False)  # order in which pieces are made; single characters come before all
    left: np.ndarray = field(init=False)  # parts of a piece in its last merge, -1 for single characters
    right: np.ndarray = field(init=False)
    pair_keys: np.ndarray = field(init=False)  # sorted left * size + right of all pairs that make a piece
    pair_ids: np.ndarray = field(init=False)
    blank_runs: dict[int, list[int]] = field(init=False)
    hash_slots: np.ndarray = field(init=False)  # whether any piece's hash has these first bits
    pair_slots: np.ndarray = field(init=False)
    asked: np.ndarray = field(init=False)  # pairs of pieces asked for last, and the answers
    answers: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        usable = np.flatnonzero(self.kinds == _NORMAL)
        keys = np.array([_hash_of(np.array([ord(c) for c in self.pieces[i]])) for i in usable], np.uint64)
        order = np.argsort(keys)
        self.hashes, self.ids = keys[order], usable[order].astype(np.int64)
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces have one hash")
        self.hash_slots = np.zeros(1 << _SLOT_BITS, bool)
        self.hash_slots[self.hashes >> np.uint64(64 - _SLOT_BITS)] = True
        self.longest = max(len(self.pieces[i]) for i in usable)
        self.byte_ids = np.full(256, -1, np.int64)
        for i in np.flatnonzero(self.kinds == _BYTE):
            self.byte_ids[int(self.pieces[i][1:-1], 16)] = i
        if not self.unigram:
            self._merges(usable)

    def _merges(self, usable: np.ndarray) -> None:
        """Merges in order of score; equal scores occur among runs of blanks only, which are encoded apart."""
        index = {self.pieces[i]: int(i) for i in usable}
        size = len(self.pieces)
        by_score = sorted((i for i in usable if len(self.pieces[i]) > 1), key=lambda i: (-self.scores[i], i))
        self.rank = np.full(size, -1, np.int64)
        self.rank[by_score] = np.arange(len(by_score))
        self.left, self.right = np.full(size, -1, np.int64), np.full(size, -1, np.int64)
        pairs = []
        for i in by_score:
            piece, best = self.pieces[i], None
            for k in range(1, len(piece)):
                a, b = index.get(piece[:k]), index.get(piece[k:])
                if a is not None and b is not None:
                    pairs.append((a * size + b, i))
        pairs.sort()
        self.pair_keys = np.array([k for k, _ in pairs] or [-1], np.int64)
        self.pair_ids = np.array([i for _, i in pairs] or [0], np.int64)
        self.pair_slots = np.zeros(1 << _SLOT_BITS, bool)
        self.pair_slots[self._slot(self.pair_keys)] = True
        for i in by_score:  # the last merge of a piece follows from merging its characters
            path = self._merged(self.pieces[i], index, stop=int(i))
            if path is not None:
                self.left[i], self.right[i] = path
        self.blank_runs = {}
        self.asked = np.full(1 << _SLOT_BITS, -1, np.int64)
        self.answers = np.zeros(1 << _SLOT_BITS, bool)

    def _merged(self, piece: str, index: dict[str, int], stop: int) -> tuple[int, int] | None:
        """The two parts that merging leaves before the last step; None if merging doesn't make the piece."""
        parts = [index.get(c, -1) for c in piece]
        while len(parts) > 1:
            best, at = _NEVER, -1
            for k in range(len(parts) - 1):
                if parts[k] >= 0 and parts[k + 1] >= 0:
                    made = index.get(self.pieces[parts[k]] + self.pieces[parts[k + 1]])
                    if made is not None and self.rank[made] < best:
                        best, at = self.rank[made], k
            if at < 0:
                return None
            made = index[self.pieces[parts[at]] + self.pieces[parts[at + 1]]]
            if made == stop and len(parts) == 2:
                return parts[0], parts[1]
            parts[at : at + 2] = [made]
        return None

    def blanks(self, n: int) -> list[int]:
        """Ids of a run of n blanks. Merges of blanks have one score in common, so the leftmost pair goes first."""
        if n not in self.blank_runs:
            index = {self.pieces[i]: int(i) for i in self.ids.tolist() if set(self.pieces[i]) == {SPACE}}
            made = {len(p): (i, float(self.scores[i])) for p, i in index.items()}
            sizes, before, behind = [1] * n, list(range(-1, n - 1)), list(range(1, n + 1))
            waiting: list[tuple[float, int, int, int]] = []  # score, place and sizes of neighbours that may merge

            def offer(k: int) -> None:
                if k >= 0 and behind[k] < n and (total := sizes[k] + sizes[behind[k]]) in made:
                    heapq.heappush(waiting, (-made[total][1], k, sizes[k], sizes[behind[k]]))

            for k in range(n - 1):
                offer(k)
            while waiting:
                _, k, own, other = heapq.heappop(waiting)
                next_ = behind[k]
                if sizes[k] != own or next_ >= n or sizes[next_] != other:
                    continue  # one of them has merged since
                sizes[k], sizes[next_], behind[k] = own + other, 0, behind[next_]
                if behind[k] < n:
                    before[behind[k]] = k
                offer(before[k])
                offer(k)
            sizes = [s for s in sizes if s]
            if len(self.blank_runs) > 10_000:
                self.blank_runs.clear()
            self.blank_runs[n] = [made[s][0] for s in sizes]
        return self.blank_runs[n]

    def made_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that each pair would merge into; a large number if none."""
        key = a * len(self.pieces) + b
        made = np.full(len(key), _NEVER, np.int64)
        likely = np.flatnonzero(self.pair_slots[self._slot(key)])
        at = np.minimum(np.searchsorted(self.pair_keys, key[likely]), len(self.pair_keys) - 1)
        same = self.pair_keys[at] == key[likely]
        made[likely[same]] = self.rank[self.pair_ids[at[same]]]
        return made

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (key.astype(np.uint64) * _BASE) >> np.uint64(64 - _SLOT_BITS)

    def probe(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are those of pieces, and the pieces' ids."""
        likely = np.flatnonzero(self.hash_slots[hashes >> np.uint64(64 - _SLOT_BITS)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[likely]), len(self.hashes) - 1)
        same = self.hashes[at] == hashes[likely]
        return likely[same], self.ids[at[same]]

    def stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """`_stable` by way of a table of the pairs asked for last; unknown characters (-1) never merge."""
        key = a * len(self.pieces) + b
        ok = (a < 0) | (b < 0)
        slot = self._slot(key)
        hit = self.asked[slot] == key
        ok[hit] |= self.answers[slot[hit]]
        new = np.flatnonzero(~hit & ~ok)
        if len(new):
            answer = self._stable(a[new], b[new])
            ok[new] = answer
            # of several pairs for one slot all write the same place: the last one written is asked for again
            self.asked[slot[new]] = key[new]
            last = self.asked[slot[new]] == key[new]
            self.answers[slot[new[last]]] = answer[last]
        return ok

    def _stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the characters of two neighbouring pieces ends with exactly these two.

        Going back through the merges of both, latest first: at no time may the parts that touch have a merge that
        comes earlier than the one that was made next to them."""
        ok = np.ones(len(a), bool)
        live = np.arange(len(a))
        x, y = a, b
        limit = np.full(len(live), _NEVER, np.int64)
        while len(live):
            bad = self.made_of(x, y) < limit
            ok[live[bad]] = False
            # a merge on the left goes before an equal one on the right, so the right one is undone first
            rx, ry = self.rank[x], self.rank[y]
            undo_right = ry >= rx
            top = np.maximum(rx, ry)
            done = bad | (top < 0)
            limit = np.where(undo_right, top + 1, top)
            # on the right, an equal merge of the touching parts would lie further left and so come first
            y = np.where(undo_right, self.left[y], y)
            x = np.where(undo_right, x, self.right[x])
            live, x, y, limit = live[~done], x[~done], y[~done], limit[~done]
        return ok


def load(path: str = MODEL_PATH) -> Vocabulary:
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
        raise ValueError("only models that leave the text as it is are supported")
    if proto.trainer_spec.model_type not in (1, 2):
        raise ValueError("only models of the unigram and merge types are supported")
    vocabulary = Vocabulary(
        [p.piece for p in proto.pieces], np.array([p.score for p in proto.pieces], np.float64),
        np.array([p.type for p in proto.pieces]), proto.trainer_spec.model_type == 1,
        proto.normalizer_spec.add_dummy_prefix,
    )
    if (vocabulary.byte_ids < 0).any():
        raise ValueError("the model has no bytes to fall back on")
    normal = [vocabulary.pieces[i] for i in vocabulary.ids.tolist()]
    if any(SPACE in p[1:] and set(p) != {SPACE} for p in normal):
        raise ValueError("a piece goes on behind a space")
    runs = [vocabulary.scores[i] for i in vocabulary.ids if len(vocabulary.pieces[i]) > 1 and set(vocabulary.pieces[i]) == {SPACE}]
    if runs and not vocabulary.unigram and max(runs) > min(vocabulary.scores[i] for i in vocabulary.ids):
        raise ValueError("blanks merge with each other before words do")
    return vocabulary


class Encoder(dict):
    """Ids of segments as bytes, for as long as there are few."""

    # blanks with the word behind them, blanks alone, line feeds: no piece crosses the borders between these
    SEGMENTS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary
        if any("\n" in p and len(p) > 1 for p in vocabulary.pieces):
            raise ValueError("a piece goes across a line feed")

    def encode(self, rows: list[str]) -> list[np.ndarray]:
        if len(self) > KNOWN_SEGMENTS:
            self.clear()
        segments = [self.SEGMENTS.findall(self.shown(t)) for t in rows]
        new = {s for part in segments for s in part if s not in self}
        wide = set() if self.v.unigram else {s for s in new if s.startswith(SPACE * 2)}
        plain = (new - wide) | {s for s in map(self._narrow, wide) if s and s not in self}
        self._learn(sorted(plain, key=len))
        for segment in wide:
            self[segment] = np.array(self._wide(segment), np.int32).tobytes()
        return [np.frombuffer(b"".join(map(self.__getitem__, part)), np.int32) for part in segments]

    def shown(self, text: str) -> str:
        """A text as the pieces spell it: spaces visible, and one before a text that has any character."""
        if not text:
            return ""
        return (" " + text if self.v.prefix else text).replace(" ", SPACE)

    @staticmethod
    def _narrow(segment: str) -> str:
        """A segment with one blank before its word; empty without a word."""
        word = segment.lstrip(SPACE)
        return word and SPACE + word

    def _wide(self, segment: str) -> list[int]:
        """Ids of a segment that begins with several blanks. Blanks merge with each other last of all: the word takes
        the blank before it if there is a piece for that, and the rest is a run."""
        narrow = self._narrow(segment)
        n = len(segment) - len(narrow) + 1 if narrow else len(segment)
        if not narrow:
            return self.v.blanks(n)
        ids = np.frombuffer(self[narrow], np.int32).tolist()
        return self.v.blanks(n) + ids[1:] if self.v.pieces[ids[0]] == SPACE else self.v.blanks(n - 1) + ids

    def _learn(self, new: list[str]) -> None:
        """Encodes segments, sorted by length, a bounded number of equal length at a time."""
        at = 0
        while at < len(new):
            length, end = len(new[at]), at
            most = max(1, CELLS // length)
            while end < len(new) and len(new[end]) == length and end - at < most:
                end += 1
            self.update(zip(new[at:end], self._search(new[at:end], length), strict=True))
            at = end

    def _search(self, segments: list[str], length: int) -> list[bytes]:
        v = self.v
        n = len(segments)
        codes = np.frombuffer("".join(segments).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length)
        codes = codes.astype(np.uint64) + np.uint64(1)
        floor = v.scores[v.ids].min() - 10.0
        best = np.full((length + 1, n), -np.inf)
        best[0] = 0
        piece = np.full((length + 1, n), -1, np.int64)  # the last piece of the best path to an end; -1: unknown
        back = np.zeros((length + 1, n), np.int64)
        run = np.zeros((min(v.longest, length), n), np.uint64)  # hashes of the substrings that end here, by length
        for end in range(1, length + 1):
            c = codes[:, end - 1]
            sizes = min(len(run), end)
            run[1:sizes] = run[: sizes - 1] * _BASE + c
            run[0] = c
            hit, ids = v.probe(run[:sizes].ravel())
            found_size, found_row = hit // n + 1, hit % n
            begin = end - found_size
            reached = np.isfinite(best[begin, found_row])
            ids, begin, found_row = ids[reached], begin[reached], found_row[reached]
            if v.unigram:
                value = best[begin, found_row] + v.scores[ids]
            else:
                inner = begin > 0
                ok = np.ones(len(ids), bool)
                ok[inner] = v.stable(piece[begin[inner], found_row[inner]], ids[inner])
                ok &= (v.left[ids] >= 0) | (v.rank[ids] < 0)  # pieces that merging makes
                ids, begin, found_row = ids[ok], begin[ok], found_row[ok]
                value = np.zeros(len(ids))
            known = np.zeros(n, bool)
            known[found_row[begin == end - 1]] = True
            single = np.zeros(n, bool)
            single[hit[: np.searchsorted(hit, n)]] = True  # the character alone is a piece
            unknown = np.flatnonzero(~single & np.isfinite(best[end - 1]))
            rows = np.concatenate([found_row, unknown])
            values = np.concatenate([value, best[end - 1, unknown] + (floor if v.unigram else 0.0)])
            ids = np.concatenate([ids, np.full(len(unknown), -1)])
            begin = np.concatenate([begin, np.full(len(unknown), end - 1)])
            if not len(rows):
                continue
            order = np.lexsort((-begin, values, rows))  # of equal values the longer piece
            last = np.append(rows[order][1:] != rows[order][:-1], True)
            take = order[last]
            best[end, rows[take]] = values[take]
            piece[end, rows[take]], back[end, rows[take]] = ids[take], begin[take]
        return self._paths(segments, piece, back, length)

    def _paths(self, segments: list[str], piece: np.ndarray, back: np.ndarray, length: int) -> list[bytes]:
        """Ids along the backpointers, as bytes; unknown characters spelled in bytes."""
        n = len(segments)
        ids = np.full((n, length), -2, np.int32)
        ends, rows = np.full(n, length), np.arange(n)
        while len(rows):
            begin = back[ends, rows]
            ids[rows, begin] = piece[ends, rows]
            keep = begin > 0
            ends, rows = begin[keep], rows[keep]
        cuts = np.concatenate([[0], np.cumsum((ids > -2).sum(axis=1))]) * 4
        data, cuts = ids[ids > -2].tobytes(), cuts.tolist()
        out = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        for r in np.flatnonzero((ids == -1).any(axis=1)).tolist():
            path: list[int] = []
            for k, i in enumerate(ids[r].tolist()):
                if i >= 0:
                    path.append(i)
                elif i == -1:
                    path += self.v.byte_ids[list(segments[r][k].encode("utf-8", "surrogatepass"))].tolist()
            out[r] = np.array(path, np.int32).tobytes()
        return out


def decode(v: Vocabulary, ids: np.ndarray, spelled: list[bytes] | None = None) -> str:
    """The text of ids. Bytes that are no valid UTF-8 become replacement characters; control pieces give nothing."""
    spelled = spelled or spelling(v)
    data = b"".join(map(spelled.__getitem__, ids.tolist()))
    text = data.decode("utf-8", "replace")
    return text[1:] if v.prefix and text.startswith(" ") else text


def spelling(v: Vocabulary) -> list[bytes]:
    """Bytes of each piece."""
    found = []
    for piece, kind in zip(v.pieces, v.kinds.tolist(), strict=True):
        if kind == _BYTE:
            found.append(bytes([int(piece[1:-1], 16)]))
        elif kind == _NORMAL:
            found.append(piece.replace(SPACE, " ").encode())
        else:
            found.append(" ⁇ ".encode() if kind == _UNKNOWN else b"")
    return found


def encode_documents(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ids (array of int) of every row.

    Null and empty texts have no ids. Texts are never cut. Repeated rows give repeated results; a null doc_id stays
    null; other columns don't matter."""
    names = [*keep, "ids"]

    @releasing
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:
            for a, b, rows in text_slices(batch.column("__text"), SLICE):
                found = encoder.encode(rows)
                offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found), pa.int32()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(a, b - a) for c in keep), ids], names)

    kept = [F.col(f"`{c}`") for c in keep]
    schema = docs.select(*kept).schema.add("ids", T.ArrayType(T.IntegerType()))
    return docs.select(*kept, F.col("text").cast("string").alias("__text")).mapInArrow(encoded, schema)


def decode_documents(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and text of every row of ids. Null ids count as none and give an empty text."""

    @releasing
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = spelling(vocabulary)
        for batch in batches:
            rows = [decode(vocabulary, np.array(x or [], np.int64), spelled) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(decoded, f"doc_id {kind}, text string")


def digests(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the ids as little-endian 32-bit numbers), round_trip (whether decoding gives the
    text back; a text with U+2581 comes back with spaces there) of every row, in one pass over the texts."""

    @releasing
    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, spelled = Encoder(vocabulary), spelling(vocabulary)
        names = ["doc_id", "n_tokens", "ids_sha256", "round_trip"]
        for batch in batches:
            for a, b, rows in text_slices(batch.column("text"), SLICE):
                found = encoder.encode(rows)
                hashes = [hashlib.sha256(x.tobytes()).hexdigest() for x in found]
                same = [decode(vocabulary, x, spelled) == t for x, t in zip(found, rows, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array([len(x) for x in found], pa.int64()),
                     pa.array(hashes, pa.string()), pa.array(same, pa.bool_())], names,
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(digested, f"doc_id {kind}, n_tokens long, ids_sha256 string, round_trip boolean")


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and whether they decode to it."""
    return digests(table(spark, sf_dir, "documents"), load())
