"""Notes that arrive as a stream.

The lexicon is static; each micro-batch goes through the same plan as a table of notes, so the lookups, their grouping
and every masking step are those of ``tag_notes``. A batch is written as one run (see ``sources.runs``): Spark repeats a
batch that was under way when the stream ended, under the same number, and the repeat takes the place of the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from notemask.operators.gazetteers import Lexicon
from notemask.plans.pipeline import annotate_notes, label_rows, unusable_reason
from notemask.sources.runs import read_runs, write_run


def _names(id_cols: list[str] | str) -> list[str]:
    return [id_cols] if isinstance(id_cols, str) else list(id_cols)


def checked_notes(
    notes: DataFrame, lexicon: Lexicon, id_cols: list[str] | str = "doc_id", text_col: str = "text", strict: bool = False
) -> DataFrame:
    """Every note with its labels or the reason of its reject; a note that can't be tagged has ids and reason alone."""
    id_cols = _names(id_cols)
    wanted = [text_col, "cleaned", "iob", "masked", "reject_reason"]
    annotated = annotate_notes(notes, lexicon, id_cols, text_col, strict, columns=wanted)
    unusable = notes.select(*id_cols, unusable_reason(id_cols, text_col).alias("reject_reason"))
    return annotated.unionByName(unusable.filter("reject_reason is not null"), allowMissingColumns=True)


def label_stream(
    notes: DataFrame,
    lexicon: Lexicon,
    folder: str,
    checkpoint: str,
    id_cols: list[str] | str = "doc_id",
    text_col: str = "text",
    strict: bool = False,
) -> DataStreamWriter:
    """A stream of notes into runs of checked notes in ``folder``; set its trigger and start it.

    ``checkpoint`` is the stream's own folder. Labels and rejects come from one run of the taggers and become visible
    together. Null ids and texts are rejects, as in ``rejected_notes``; a batch without notes gives a run without rows.
    """

    def tag(batch: DataFrame, number: int) -> None:
        write_run(checked_notes(batch, lexicon, id_cols, text_col, strict), folder, f"batch-{number}")

    return notes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(tag)


def streamed_labels(
    spark: SparkSession, folder: str, id_cols: list[str] | str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Label rows of all batches so far, one per distinct cleaned text: the rows that ``tag_notes`` gives for all notes."""
    return label_rows(read_runs(spark, folder), _names(id_cols), text_col)


def streamed_rejects(spark: SparkSession, folder: str, id_cols: list[str] | str = "doc_id") -> DataFrame:
    """Rejects of all batches so far, with their reasons."""
    return read_runs(spark, folder).select(*_names(id_cols), "reject_reason").filter("reject_reason is not null")


def first_texts(
    labels: DataFrame, id_cols: list[str] | str = "doc_id", seen_at: str | None = None, keep_for: str = "1 day"
) -> DataFrame:
    """The lowest id of each cleaned text in a stream, as keyed state: text_key and the ids.

    In update mode a row comes out whenever a text is new or a lower id of it arrives. The state holds a hash and an id
    for each text, no texts. Without ``seen_at`` it grows with the number of different texts. With it, a timestamp
    column, a text is known for ``keep_for`` (by windows of that length) and is given as new again afterwards;
    ``least_ids`` puts the windows together, so its result is the same. Rows later than ``keep_for`` behind the newest are
    dropped by Spark then: choose it longer than the longest delay of the source.
    """
    keys = [F.sha2("cleaned", 256).alias("text_key")]
    if seen_at is not None:
        labels = labels.withWatermark(seen_at, keep_for)
        keys.append(F.window(seen_at, keep_for).alias("seen"))
    least = labels.groupBy(*keys).agg(F.min(F.struct(*_names(id_cols))).alias("first"))
    return least.select("text_key", "first.*")


def first_text_stream(
    labels: DataFrame,
    folder: str,
    checkpoint: str,
    id_cols: list[str] | str = "doc_id",
    seen_at: str | None = None,
    keep_for: str = "1 day",
) -> DataStreamWriter:
    """A stream of cleaned texts into runs of new lowest ids in ``folder``; read them by ``least_ids``."""

    def keep(batch: DataFrame, number: int) -> None:
        write_run(batch, folder, f"batch-{number}")

    firsts = first_texts(labels, id_cols, seen_at, keep_for)
    return firsts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(keep)


def least_ids(spark: SparkSession, folder: str, id_cols: list[str] | str = "doc_id") -> DataFrame:
    """The lowest id per text among all batches of ``first_text_stream`` so far: text_key and the ids."""
    runs = read_runs(spark, folder)
    return runs.groupBy("text_key").agg(F.min(F.struct(*_names(id_cols))).alias("first")).select("text_key", "first.*")
