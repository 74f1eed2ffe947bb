"""Secret scan with structural confirmation.

Three plain patterns give the base spans. Runs of base64 or hex that could hold a key are then decoded, and are
reported only if what they decode to has the structure of a key: DER with nested lengths that add up, a binary
public-key record, or the header of a signed token.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import releasing, table, text_slices

#: Bytes of text that are Python strings at once in a task.
SLICE = 1_000_000

#: Kinds in the order that breaks ties of one start.
KINDS = ("assign", "access", "hex", "token", "der", "record")

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

#: Candidates of the structural kinds.
SIGNED = re.compile(r"(?<![A-Za-z0-9_.-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{4,})\.([A-Za-z0-9_-]{16,})(?![A-Za-z0-9_-])")
#: Between the lines of a key: real line ends or written ones (`\n` in strings of JSON and of shells), and blanks around.
BREAK = re.compile(r"(?:[\x20\t]*(?:\r?\n|(?:\\+r)?\\+n))+[\x20\t]*")


def _lines_of(letters: str) -> re.Pattern[str]:
    """Runs of lines of an alphabet. The letter of a written escape in front (`\n`) doesn't belong to the run."""
    return re.compile(rf"(?<![{letters}])(?:(?<=\\)[nrt])?([{letters}]{{24,}}(?:{BREAK.pattern}[{letters}]+)*={{0,2}})")


BASE64, BASE64_URL = _lines_of("A-Za-z0-9+/"), _lines_of("A-Za-z0-9_-")
HEX_ANY = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{2}){24,}(?![0-9A-Za-z])")

#: DER tags that may stand in a key structure: boolean, integer, strings, null, identifier, sequence, set, explicit.
_DER_TAGS = {1, 2, 3, 4, 5, 6, 12, 16, 17, 19, 22, 23, 24}

_RECORD_TYPE, _CONTAINER = re.compile(rb"(ssh|ecdsa|sk-ssh|sk-ecdsa)-[a-z0-9@.-]+"), b"openssh-key-v1\0"


def decoded(text: str) -> bytes | None:
    """Bytes of a base64 text, in either alphabet, with or without padding and line ends."""
    body = re.sub(r"[\r\n=]", "", text).replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _der_item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, begin and end of the content of the DER item that begins at `at`; None if it doesn't end by `end`."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        size, at = int.from_bytes(data[at : at + n], "big"), at + n
        if size < 128 or (n > 1 and size < 1 << (8 * (n - 1))):
            return None  # not the shortest form
    if tag & 0x1F not in _DER_TAGS and not tag & 0x80 or at + size > end:
        return None
    return tag, at, at + size


def der_items(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """Tag, begin and end of the DER items that fill a range exactly; None if their lengths don't add up."""
    items = []
    while at < end:
        item = _der_item(data, at, end)
        if item is None:
            return None
        items.append(item)
        at = item[2]
    return items


def _adds_up(data: bytes, at: int, end: int, known: dict[tuple[int, int], bool]) -> bool:
    """Whether the items of a range and all nested ones fill what they lie in; each range is walked once (`known`)."""
    stack = [[at, end, at]]
    while stack:
        begin, end, at = stack[-1]
        if at == end:
            known[begin, end] = True
            stack.pop()
            continue
        item = _der_item(data, at, end)
        inner = item and item[0] & 0x20 and known.get(item[1:])
        if item is None or inner is False:
            known.update({(b, e): False for b, e, _ in stack})
            return False
        stack[-1][2] = item[2]
        if item[0] & 0x20 and inner is None:
            stack.append([item[1], item[2], item[1]])
    return True


def is_der_key(data: bytes, at: int = 0, end: int | None = None, known: dict[tuple[int, int], bool] | None = None) -> bool:
    """A DER sequence, filled exactly, whose nested sequences add up too and which holds an integer of a key's size,
    a bit or octet string with an algorithm identifier, or an octet string behind a version number."""
    end, known = len(data) if end is None else end, {} if known is None else known
    top = _der_item(data, at, end)
    if not top or top[0] != 0x30 or top[2] != end or known.get(top[1:]) is False:
        return False
    if top[1:] not in known and not _adds_up(data, top[1], end, known):
        return False
    items = der_items(data, top[1], end)
    if not items or len(items) < 2:
        return False
    tags = [tag for tag, _, _ in items]
    ints = [b - a for tag, a, b in items if tag == 2]
    algorithm = any(tag == 0x30 and data[a : min(b, a + 1)] == b"\x06" for tag, a, b in items)
    return (
        (algorithm and (3 in tags or 4 in tags))  # public or wrapped private key
        or (len(ints) >= 2 and max(ints) >= 20 and set(tags) == {2})  # numbers of a key or a signature
        or (tags[:2] == [2, 4] and data[items[0][1] : items[0][2]] == b"\x01" and items[1][2] - items[1][1] >= 16)  # curve key
    )


def is_record(data: bytes) -> bool:
    """A binary public-key record: a named type, then length-prefixed fields that fill it; or a private key container."""
    if data.startswith(_CONTAINER):
        return True
    at, fields = 0, []
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + size > len(data):
            return False
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return len(fields) >= 2 and _RECORD_TYPE.fullmatch(fields[0]) is not None


def is_signed_header(text: str) -> bool:
    """Whether a token's first part decodes to a header that names its algorithm."""
    data = decoded(text)
    if not data or data[:1] != b"{":
        return False
    try:
        header = json.loads(data)
    except (ValueError, RecursionError):
        return False
    return isinstance(header, dict) and isinstance(header.get("alg"), str)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the three plain patterns; matches of each kind are leftmost and don't overlap."""
    spans = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], s[2]))


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of candidates whose decoded structure is that of a key or token."""
    spans = []
    if "." in text:
        spans += [(m.start(), m.end(), 3) for m in SIGNED.finditer(text) if is_signed_header(m[1]) and decoded(m[3])]
    # line ends may join a run to words around it, so keys are looked for from each of its lines on
    keys: dict[int, tuple[bool, int, int]] = {}
    for pattern in (BASE64, BASE64_URL):
        for m in pattern.finditer(text):
            for start, end, kind, exact in _line_runs(text, m.start(1), m.end(1)):
                keys[start] = max(keys.get(start, (False, 0, 0)), (exact, end, kind))
    spans += [(start, end, kind) for start, (_, end, kind) in keys.items()]
    for m in HEX_ANY.finditer(text):
        data = bytes.fromhex(m[0])
        kind = 4 if is_der_key(data) else 5 if is_record(data) else 0
        if kind:
            spans.append((m.start(), m.end(), kind))
    return sorted(set(spans), key=lambda s: (s[0], s[2], s[1]))


def _line_runs(text: str, start: int, end: int) -> list[tuple[int, int, int, bool]]:
    """Keys within a run of base64 lines: start, end, kind number, and whether the structure says where the key ends."""
    breaks = [(m.start(), m.end()) for m in BREAK.finditer(text, start, end)]
    lines = list(zip([start, *(b for _, b in breaks)], [*(a for a, _ in breaks), end], strict=True))
    bodies = [text[a:b].rstrip("=") for a, b in lines]
    upto = list(itertools.accumulate(map(len, bodies)))  # characters up to the end of each line
    body = "".join(bodies).replace("-", "+").replace("_", "/")
    phases: dict[int, tuple[bytes, dict]] = {}  # a line may begin at each of four places within a group of characters
    found, i = [], 0
    while i < len(lines):
        before = upto[i - 1] if i else 0
        if body[before : before + 1] not in _FIRST:
            i += 1
            continue
        if before % 4 not in phases:
            rest = body[before % 4 :]
            phases[before % 4] = decoded(rest[: len(rest) - (len(rest) % 4 == 1)]) or b"", {}
        data, known = phases[before % 4]
        at = before // 4 * 3

        def line_at(stop: int, before: int = before, at: int = at) -> int | None:
            """The line that ends with this byte."""
            wanted = before - (at - stop) * 4 // 3
            j = bisect.bisect_left(upto, wanted)
            return j if j < len(upto) and upto[j] == wanted else None

        j, kind, exact = None, 5, True
        size = _announced(data[at : at + 6])
        if size and (last := line_at(at + size)) is not None and is_der_key(data, at, at + size, known):
            j, kind = last, 4
        elif data.startswith(_CONTAINER, at):
            stop = _container_end(data, at)
            j = line_at(stop) if stop else None
            if j is None:  # cut short or unknown within: all lines that can be decoded
                j = next((k for k in range(len(lines) - 1, i - 1, -1) if (upto[k] - before) % 4 != 1), None)
                exact = False
        else:
            j = _record_line(data, at, line_at)
        if j is not None:
            found.append((lines[i][0], lines[j][1], kind, exact))
            i = j
        i += 1
    return found


#: First characters of a DER sequence, a record and a container of private keys.
_FIRST = frozenset("MAb")


def _field_end(data: bytes, at: int) -> int | None:
    """End of the length-prefixed field that begins here."""
    stop = at + 4 + int.from_bytes(data[at : at + 4], "big")
    return stop if at + 4 <= len(data) and stop <= len(data) else None


def _record_line(data: bytes, at: int, line_at: Callable[[int], int | None]) -> int | None:
    """The last line that ends with a field of the public-key record that begins here; another record ends it too."""
    stop = _field_end(data, at)
    if stop is None or not _RECORD_TYPE.fullmatch(data, at + 4, stop):
        return None
    found = None
    while (following := _field_end(data, stop)) is not None:
        if found is not None and found == line_at(stop) and _RECORD_TYPE.fullmatch(data, stop + 4, following):
            break
        stop = following
        line = line_at(stop)
        found = found if line is None else line
    return found


def _container_end(data: bytes, at: int) -> int | None:
    """Where a container of private keys ends: cipher, derivation and its options, a number, public keys, private part."""
    stop: int | None = at + len(_CONTAINER)
    for _ in range(3):
        stop = None if stop is None else _field_end(data, stop)
    if stop is None:
        return None
    n, stop = int.from_bytes(data[stop : stop + 4], "big"), stop + 4
    for _ in range(n + 1):
        stop = _field_end(data, stop)
        if stop is None:
            return None
    return stop


def _announced(data: bytes) -> int:
    """Bytes of the DER sequence that begins here by its own length, else 0."""
    if len(data) < 4 or data[0] != 0x30:
        return 0
    if not data[1] & 0x80:
        return 2 + data[1]
    n = data[1] & 0x7F
    return 2 + n + int.from_bytes(data[2 : 2 + n], "big") if n <= 4 and len(data) >= 2 + n else 0


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


@releasing
def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in (t for _, _, part in text_slices(batch.column("text"), SLICE) for t in part):
            base = base_spans(text)
            kinds = [k for _, _, k in base]
            every = sorted({*base, *confirmed_spans(text)}, key=lambda s: (s[0], s[2], s[1]))
            rows.append(
                (kinds.count(0), kinds.count(1), kinds.count(2), hashlib.sha256(joined(base).encode()).hexdigest(), joined(every))
            )
        columns = list(zip(*rows, strict=True)) or [()] * 5
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names
        )


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of the base spans, and all spans as text.

    A span is `kind:start:end` in code points, end exclusive, ordered by start, then by kind. Null and empty texts
    have no spans. Repeated rows give repeated results, a null doc_id stays null, other columns don't matter.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(
        _scan, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def op8(spark, sf_dir: str) -> DataFrame:
    """Every secret of every document."""
    return secret_spans(table(spark, sf_dir, "documents"))
