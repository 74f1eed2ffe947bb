"""Helpers shared by the corpus operators: inputs, written intermediate tables, slices of batches."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, as a regular expression class: space, tab, LF, VT, FF, CR.
BLANKS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only in a local session where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="notemask-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Writes a table into the shared folder and reads it back: the lineage ends there, so a lost executor
    costs no recomputation of what came before and two readers see the same rows."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column, modulus: int, fold: int) -> Column:
    """Whether a row belongs to the fold that labels are never learnt from."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % modulus == fold, F.lit(True))


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Texts of a column as Python strings; null counts as empty."""
    return [x or "" for x in column.to_pylist()]


Batches = Iterator[pa.RecordBatch]


def releasing(process: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """Gives memory back to the system after each partition: Python workers stay alive beside later JVM work."""

    @functools.wraps(process)
    def run(batches: Batches) -> Batches:
        try:
            yield from process(batches)
        finally:
            release_memory()

    return run


def release_memory() -> None:
    """Gives freed memory back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_slices(column: pa.Array, limit: int) -> Iterator[tuple[int, int, list[str]]]:
    """Ranges of rows of about `limit` bytes with their texts, of which only these are Python strings at a time."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(lengths, limit):
        yield a, b, texts(column.slice(a, b - a))


def slices(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `limit` units in all; a single longer row is a range of its own."""
    start, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


def bytes_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a column in a row, and where each begins (one more than rows)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    codes = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return codes, offsets - offsets[0]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, fold: int, per_class: int, max_bytes: int
) -> DataFrame:
    """doc_id, text, lang, label, weight: at most `per_class` rows of each label outside the held-out fold, by hash order.

    weight is the number of labelled rows that a row stands for. Documents above `max_bytes` are left out, so that
    the sample is bounded in bytes too. The labels are chosen before any text is read, and only the chosen ids
    (2 * per_class at most) are broadcast to the scan of the documents. Rows without label or id don't count.
    """
    usable = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), modulus, fold))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = usable.filter("label = 0").orderBy(*order).limit(per_class)
    chosen = chosen.unionByName(usable.filter("label = 1").orderBy(*order).limit(per_class))
    share = usable.groupBy("label").agg(F.greatest(F.lit(1.0), F.count("*") / per_class).alias("weight"))
    chosen = chosen.join(F.broadcast(share), "label")
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), lang.alias("lang"))
    return rows.join(F.broadcast(chosen), "doc_id").filter(
        F.coalesce(F.octet_length("text"), F.lit(0)) <= max_bytes
    )


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
