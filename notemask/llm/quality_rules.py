"""Quality rules as a bitmask ledger.

Each rule is evaluated once per document. The ledger row keeps the measurements and one bit per failed rule, so
that policies (which rules reject) can be applied, versioned and compared later without reading a text again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, releasing, slices, table

#: Bytes of text that a task measures at a time; a longer text is measured alone.
SLICE = 4 << 20

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"

#: Rules in the order of their bits: name, and the measurement-based condition that fails.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "10 * n_symbols > 3 * n_words"),
    ("many_dup_lines", "100 * n_dup_lines > 60 * n_lines"),
    ("long_words", "word_chars > 100 * n_words"),
    ("short_words", "word_chars < 2 * n_words"),
    ("many_capitals", "10 * n_upper > 8 * n_letters and n_letters > 0"),
    ("few_letters", "10 * n_letters < 5 * word_chars"),
]

BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}

#: Policies by version: a document is rejected if it fails one of these rules.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": tuple(BIT),
}

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper",
)

_SYMBOL_BYTES = np.isin(np.arange(256), np.frombuffer(SYMBOLS.encode(), np.uint8))
_BLANK_BYTES = np.isin(np.arange(256), [32, *range(9, 14)])


def _repeat_words(words: list[bytes]) -> int:
    """Words covered by a 3-word window that occurs twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    if len(ids) == n:
        return 0
    size = len(ids)
    if size < 2_000_000:  # three ids fit into 63 bits
        keys = (w[:-2] * size + w[1:-1]) * size + w[2:]
    else:
        pairs = np.unique(w[:-1] * size + w[1:], return_inverse=True)[1]
        keys = pairs[:-1] * size + w[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again = np.zeros(len(keys), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= again
    return int(covered.sum())


def _measure_one(text: bytes) -> tuple[int, int, int, int]:
    """Words, lines with a word, such lines equal to an earlier line, words in repeated windows."""
    words = text.split()  # bytes split at exactly the six blanks
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), len(lines), len(lines) - len(set(lines)), _repeat_words(words)


@releasing
def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        for a, b in slices(lengths, SLICE):
            yield _measured(batch.slice(a, b - a))


def _measured(batch: pa.RecordBatch) -> pa.RecordBatch:
    codes, at = bytes_of(batch.column("text"))
    data, starts = codes.tobytes(), at.tolist()
    own = np.array([_measure_one(data[a:b]) for a, b in zip(starts, starts[1:], strict=False)], np.int64)
    own = own.reshape(-1, 4)

    def counted(flags: np.ndarray) -> np.ndarray:
        """Flags set in each text; no running totals, which would take eight bytes for each byte of text."""
        return np.array([np.count_nonzero(flags[a:b]) for a, b in zip(starts, starts[1:], strict=False)], np.int64)

    upper = (codes >= 65) & (codes <= 90)
    other = ((codes >= 97) & (codes <= 122)) | (codes >= 0xC3)  # a-z and lead bytes from U+00C0 on
    columns = {
        "n_words": own[:, 0],
        "word_chars": counted(((codes & 0xC0) != 0x80) & ~_BLANK_BYTES[codes]),
        "n_symbols": counted(_SYMBOL_BYTES[codes]),
        "n_lines": own[:, 1],
        "n_dup_lines": own[:, 2],
        "n_repeat_words": own[:, 3],
        "n_letters": counted(upper | other),
        "n_upper": counted(upper),
    }
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), *(pa.array(columns[x]) for x in MEASURES)], ["doc_id", *MEASURES]
    )


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the measurements, and `failed`, a bit for each rule that it fails.

    Words are runs of anything but the six ASCII blanks. `word_chars` counts the code points in words,
    `n_dup_lines` the lines with a word that equal an earlier line, `n_repeat_words` the words covered by 3-word
    windows that occur at least twice. Null and empty texts have 0 everywhere and fail `few_words`. Rows are taken
    as they come: repeated rows give repeated ledger rows, a null doc_id stays null, other columns don't matter. An empty
    table gives an empty ledger.
    """
    schema = "doc_id " + docs.schema["doc_id"].dataType.simpleString() + "".join(f", {x} long" for x in MEASURES)
    measured = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_measure, schema)
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, rule) in enumerate(RULES)]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measured.withColumn("failed", failed)


def mask_of(rules: tuple[str, ...]) -> int:
    """The bits of some rules."""
    return sum({BIT[x] for x in rules})


def rejects(policy: str, failed: Column) -> Column:
    """Whether a policy rejects a document with these failure bits."""
    return failed.bitwiseAND(F.lit(mask_of(POLICIES[policy]))) != 0


def ablations(ledger_rows: DataFrame, policy: str) -> DataFrame:
    """For each rule of a policy: documents that fail it, and documents that only it rejects.

    One aggregate over the failure bits; no text is read. A document is rejected by one rule alone if its bits under
    the policy's mask are exactly that rule's bit. An empty ledger gives zeros.
    """
    mask, rules = mask_of(POLICIES[policy]), POLICIES[policy]
    under = F.col("failed").bitwiseAND(F.lit(mask))
    counts = [F.count(F.when(under.bitwiseAND(F.lit(BIT[x])) != 0, 1)).alias(f"fail_{x}") for x in rules]
    alone = [F.count(F.when(under == BIT[x], 1)).alias(f"only_{x}") for x in rules]
    row = ledger_rows.agg(*counts, *alone)
    items = F.array(
        *(
            F.struct(F.lit(x).alias("rule"), F.col(f"fail_{x}").alias("failed"), F.col(f"only_{x}").alias("only"))
            for x in rules
        )
    )
    return row.select(F.explode(items).alias("item")).select("item.*")


def op9(spark, sf_dir: str) -> DataFrame:
    """The ledger of all documents with the verdicts of the base policy and of policy v1."""
    rows = ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        rejects("base", F.col("failed")).alias("base_failed"),
        (~rejects("v1", F.col("failed"))).alias("kept"),
        F.col("failed").alias("failed_bits"),
    )
