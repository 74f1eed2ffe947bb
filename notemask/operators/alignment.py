"""Alignment of a text's tokens before and after masking when their numbers differ.

Tokens are aligned by a longest common subsequence. Rows of its table of lengths are kept as bits of one integer
(a bit is unset where the length grows), so one row costs a few operations on whole integers. Where the rows of
both texts would not fit into a fixed number of bits, the table is cut at its middle row and both halves are
aligned on their own, which needs two rows only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the table that are kept at a time (32 MB).
TABLE_BITS = 1 << 28

#: Hunks that a task gives out at a time.
BATCH = 4096

HUNK = "at_before int, at_after int, dropped array<string>, inserted array<string>"


def _rows(before: list[str], after: list[str]) -> Iterator[int]:
    """For each number of tokens of ``before``, from 0 on: the bits at which the length over ``after`` does not grow."""
    full = (1 << len(after)) - 1
    places: dict[str, int] = {}
    for j, token in enumerate(after):
        places[token] = places.get(token, 0) | 1 << j
    row = full
    yield row
    for token in before:
        hits = row & places.get(token, 0)
        row = ((row + hits) | (row - hits)) & full
        yield row


def _lengths(row: int, n: int) -> np.ndarray:
    """The row as lengths, for the first 0 to n tokens of ``after``."""
    bits = np.unpackbits(np.frombuffer(row.to_bytes(n // 8 + 1, "little"), np.uint8), count=n, bitorder="little")
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _last(rows: Iterator[int]) -> int:
    found = 0
    for found in rows:  # noqa: B007
        pass
    return found


def common_tokens(before: list[str], after: list[str], table_bits: int = TABLE_BITS) -> list[tuple[int, int]]:
    """Places of a longest common subsequence in both lists, in order."""
    found: list[tuple[int, int]] = []
    # ranges of both lists that are still to be aligned, the first on top
    todo = [(0, len(before), 0, len(after))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and before[a] == after[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        tail = []
        while a < b and c < d and before[b - 1] == after[d - 1]:
            b, d = b - 1, d - 1
            tail.append((b, d))
        if a == b or c == d:
            found += tail[::-1]
            continue
        x, y = before[a:b], after[c:d]
        if len(x) > 1 and len(x) * len(y) > table_bits:
            half = len(x) // 2
            ahead = _lengths(_last(_rows(x[:half], y)), len(y))
            behind = _lengths(_last(_rows(x[:half - 1 : -1], y[::-1])), len(y))
            cut = int(np.argmax(ahead + behind[::-1]))
            # what was equal at the end comes behind both halves
            todo += [(b, b + len(tail), d, d + len(tail)), (a + half, b, c + cut, d), (a, a + half, c, c + cut)]
            continue
        rows = list(_rows(x, y))
        i, j = len(x), len(y)
        met = []
        while i and j:
            if rows[i] >> (j - 1) & 1:  # the last token of ``after`` adds nothing
                j -= 1
            elif not rows[i - 1] >> (j - 1) & 1:  # it added as much before this token of ``before``
                i -= 1
            else:
                i, j = i - 1, j - 1
                met.append((a + i, c + j))
        found += met[::-1] + tail[::-1]
    return found


def hunks(before: list[str], after: list[str], table_bits: int = TABLE_BITS) -> list[tuple[int, int, list[str], list[str]]]:
    """Stretches in which the lists differ: where they begin in both, the tokens that go and those that come."""
    found = []
    i = j = 0
    for a, b in [*common_tokens(before, after, table_bits), (len(before), len(after))]:
        if i < a or j < b:
            found.append((i, j, before[i:a], after[j:b]))
        i, j = a + 1, b + 1
    return found


def token_diff(rows: DataFrame, before: str, after: str, *keep: str) -> DataFrame:
    """One row per stretch of tokens that differs: ``keep``, at_before, at_after, dropped, inserted.

    Tokens are parted by single blanks, as the size check counts them; an empty or null text has none. Putting
    ``inserted`` in the place of ``dropped`` everywhere gives the later text from the earlier one. Equal texts give
    no rows, repeated rows give repeated rows. Each row is aligned in its own task, whatever its length.
    """
    kept = rows.select(*keep)
    schema = kept.schema
    names = [*kept.columns, "at_before", "at_after", "dropped", "inserted"]

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = pa.list_(pa.string())
        kinds = [pa.int32(), pa.int32(), strings, strings]

        def batch_of(batch: pa.RecordBatch, at: list[int], found: list[tuple]) -> pa.RecordBatch:
            own = batch.take(pa.array(at, pa.int64())).columns[:-2]
            new = [pa.array([h[k] for h in found], kind) for k, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays([*own, *new], names)

        for batch in batches:
            at: list[int] = []
            found: list[tuple] = []
            for i in range(batch.num_rows):
                x, y = (batch.column(c)[i].as_py() for c in (-2, -1))
                here = hunks(x.split(" ") if x else [], y.split(" ") if y else [])
                at += [i] * len(here)
                found += here
                if len(found) >= BATCH:
                    yield batch_of(batch, at, found)
                    at, found = [], []
            if found:
                yield batch_of(batch, at, found)

    fields = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)
    return rows.select(*keep, F.col(before), F.col(after)).mapInArrow(aligned, ", ".join(x for x in (fields, HUNK) if x))
