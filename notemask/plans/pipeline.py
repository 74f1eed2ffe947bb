"""From notes to label rows.

Street addresses are masked first; the remaining words are looked up once (see
``operators.matches``) and the results are written into the text as marks. All later steps are
regular-expression rewrites of one string column inside each row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from notemask.functions.labels import bio_labels, iob_raw, label_code, label_units, size_check
from notemask.functions.marks import erase_marks, with_reserved, without_reserved, write_marks
from notemask.functions.patterns import extract_ssn, mask_email, pattern_steps
from notemask.functions.spans import let
from notemask.functions.tokens import (
    clean_masked,
    clean_text,
    drop_separators,
    edit_script,
    label_spans,
    space_count,
    space_specials,
    special_locations,
)
from notemask.operators.address import (
    CLEANUP_STEPS,
    PLACE_STEPS,
    known_address_words,
    mask_street,
    mask_zip,
)
from notemask.operators.alignment import token_diff
from notemask.operators.gazetteers import Lexicon, ensure_checkpoint_dir
from notemask.operators.matches import attach_marks
from notemask.operators.names import NAME_STEPS
from notemask.operators.quality import keep_first_text, valid_rows


def run_steps(
    rows: DataFrame, column: str, steps: Iterable[Callable[[Column], Column]]
) -> DataFrame:
    """Rewrite one column step by step, one projection each; Spark merges those it can."""
    for step in steps:
        rows = rows.withColumn(column, step(F.col(column)))
    return rows


def seal(rows: DataFrame) -> DataFrame:
    """Keep later filters above the steps so far.

    Catalyst moves a filter below a projection by inserting the projection's expressions into it.
    Through a long chain of rewriting steps that would repeat all of them, many times over, for a
    filter on their result. It never moves a filter on a generated column below the generator.
    """
    return rows.select(F.explode(F.array(F.struct(*rows.columns))).alias("row")).select("row.*")


def unusable_reason(id_cols: list[str], text_col: str) -> Column:
    """Why a note cannot be tagged at all; null if it can."""
    no_id = F.lit(False)
    for c in id_cols:
        no_id = no_id | F.col(c).isNull()
    return F.when(no_id, "null_id").when(F.col(text_col).isNull(), "null_text")


def mark_notes(
    notes: DataFrame, lexicon: Lexicon, id_cols: list[str], text_col: str = "text"
) -> DataFrame:
    """Usable notes with ``marked``: streets masked, lookup results written into the text.

    Each condition is a filter of its own: the join that brings the lookups back asks for ids that are
    not null, and only if both of its sides have the same filters is their exchange one.
    """
    usable = notes.select(*id_cols, text_col)
    for column in [*id_cols, text_col]:
        usable = usable.filter(F.col(column).isNotNull())
    joined = attach_marks(usable, lexicon, id_cols, text_col, prepare=masked_streets)
    marked = write_marks(F.coalesce("prepared", text_col), F.col("marks"), F.col("places"))
    return joined.withColumn("marked", marked).drop("prepared", "marks", "places")


def masked_streets(text: Column) -> Column:
    """Streets masked in a text without reserved characters."""
    return let(without_reserved(text), mask_street)


def shown(text: Column, marked: Column) -> Column:
    """A masked text as it is given out: no marks, and the text's own reserved characters."""
    return with_reserved(text, erase_marks(marked))


def mask_addresses(marked: DataFrame, column: str = "marked") -> DataFrame:
    """Add ``address_masked`` (still with marks)."""
    rows = run_steps(marked.withColumn("address_masked", F.col(column)), "address_masked", PLACE_STEPS)
    zips = mask_zip(F.col("address_masked"), known_address_words(F.col(column)))
    return run_steps(rows.withColumn("address_masked", zips), "address_masked", CLEANUP_STEPS)


def mask_names(rows: DataFrame, column: str = "address_masked") -> DataFrame:
    """Add ``name_masked`` (marks removed)."""
    return run_steps(rows.withColumn("name_masked", F.col(column)), "name_masked", NAME_STEPS)


def annotate_notes(
    notes: DataFrame,
    lexicon: Lexicon,
    id_cols: list[str] | str = "doc_id",
    text_col: str = "text",
    strict: bool = False,
    with_locations: bool = False,
    with_script: bool = False,
    columns: Iterable[str] | None = None,
) -> DataFrame:
    """Usable notes with masked and cleaned text, labels, checks and a ``reject_reason``.

    ``columns`` names what is wanted besides the ids; only that is computed.
    """
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    text = F.col(text_col)
    rows = mask_names(mask_addresses(mark_notes(notes, lexicon, id_cols, text_col)))
    rows = rows.withColumn("name_masked", with_reserved(text, F.col("name_masked")))
    rows = rows.withColumn("ssn_matches", extract_ssn(mask_email(F.col("name_masked"))))
    rows = run_steps(
        rows.withColumn("masked", F.col("name_masked")), "masked", pattern_steps(strict)
    ).withColumn("spaced", space_specials(text, F.col("masked")))
    if with_locations:
        rows = rows.withColumn("locations", special_locations(F.col("spaced")))
    if with_script:
        rows = rows.withColumn("script", edit_script(text, F.col("masked")))
    rows = (
        rows.withColumn("cleaned", clean_text(F.col("spaced")))
        # labels stand for the words and special characters, whatever the spaces between them
        .withColumn("iob_raw", iob_raw(drop_separators(F.col("masked"))))
        .withColumn("iob", bio_labels(F.col("iob_raw")))
        .withColumn("label_code", label_code(F.col("iob")))
        .withColumn("sizes", size_check(F.col("cleaned"), F.col("iob")))
    )

    def misaligned(column: str) -> Column:
        return space_count(F.col(column)) != space_count(text)

    reason = (
        F.when(misaligned("address_masked"), "address_misaligned")
        .when(misaligned("name_masked"), "name_misaligned")
        .when(F.col("label_code") == 5, "labels_empty")
        .when(F.col("label_code") == 2, "labels_unknown")
        .when(F.col("sizes.split_equals") == 0, "size_mismatch")
    )
    rows = rows.withColumns({"ssn_count": F.size("ssn_matches"), "reject_reason": reason})
    everything = [
        text_col, "masked", "ssn_matches", "ssn_count", "spaced", "cleaned",
        *(["locations"] if with_locations else []), *(["script"] if with_script else []), "iob_raw", "iob", "label_code", "sizes", "reject_reason",
    ]
    wanted = everything if columns is None else list(columns)
    return seal(rows.select(*id_cols, *wanted))


def tag_notes(
    notes: DataFrame,
    lexicon: Lexicon,
    id_cols: list[str] | str = "doc_id",
    text_col: str = "text",
    strict: bool = False,
) -> DataFrame:
    """Label rows: id, text, cleaned, iob and masked of valid notes, one per distinct cleaned text."""
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    wanted = [text_col, "cleaned", "iob", "masked", "reject_reason"]
    annotated = annotate_notes(notes, lexicon, id_cols, text_col, strict, columns=wanted)
    return label_rows(annotated, id_cols, text_col)


def label_rows(annotated: DataFrame, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """Label rows of annotated notes."""
    kept = valid_rows(annotated).select(*id_cols, text_col, "cleaned", "iob", "masked")
    return keep_first_text(kept, id_cols)


def rejected_notes(
    notes: DataFrame,
    lexicon: Lexicon,
    id_cols: list[str] | str = "doc_id",
    text_col: str = "text",
    strict: bool = False,
) -> DataFrame:
    """Every note that yields no label row, with the reason (repeats of a text are not rejects)."""
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    annotated = annotate_notes(notes, lexicon, id_cols, text_col, strict, columns=["reject_reason"])
    return reject_rows(notes, annotated, id_cols, text_col)


def reject_rows(
    notes: DataFrame, annotated: DataFrame, id_cols: list[str], text_col: str = "text"
) -> DataFrame:
    """Rejects among notes and their annotated rows."""
    unusable = notes.select(*id_cols, unusable_reason(id_cols, text_col).alias("reject_reason"))
    return unusable.unionByName(annotated.select(*id_cols, "reject_reason")).filter(
        "reject_reason is not null"
    )


def diffs_of_rejects(
    notes: DataFrame,
    lexicon: Lexicon,
    id_cols: list[str] | str = "doc_id",
    text_col: str = "text",
    strict: bool = False,
) -> DataFrame:
    """Where the tokens of a rejected note and of its masked form part: ids, reject_reason, at_before, at_after, dropped,
    inserted, shift.

    Notes whose token counts differ have one row per stretch of tokens that differs, a masked name as well. Those with
    a ``shift`` other than 0 are what the note was rejected for. The tokens before are those of the cleaned text, or,
    where a masking step lost the count, of the note split at blanks; after it they are those that got labels, or of
    the masked note. Only rejected notes are aligned.
    """
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    wanted = [text_col, "cleaned", "masked", "reject_reason"]
    annotated = annotate_notes(notes, lexicon, id_cols, text_col, strict, columns=wanted)
    rejected = annotated.filter(F.col("reject_reason").isin("size_mismatch", "address_misaligned", "name_misaligned"))
    sizes = F.col("reject_reason") == "size_mismatch"
    rows = rejected.select(
        F.struct(*id_cols, "reject_reason").alias("note"),
        F.when(sizes, F.col("cleaned")).otherwise(F.col(text_col)).alias("before"),
        F.when(sizes, label_units(clean_masked(F.col("masked")))).otherwise(F.col("masked")).alias("after"),
    )
    shift = (F.size("inserted") - F.size("dropped")).alias("shift")
    return token_diff(rows, "before", "after", "note").select(
        "note.*", "at_before", "at_after", "dropped", "inserted", shift
    )


def labels_and_rejects(
    notes: DataFrame,
    lexicon: Lexicon,
    id_cols: list[str] | str = "doc_id",
    text_col: str = "text",
    strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``tag_notes`` and ``rejected_notes`` from one run of the taggers.

    The annotated notes are written once, to the checkpoint folder, and both results read them.
    """
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    ensure_checkpoint_dir(notes.sparkSession)
    wanted = [text_col, "cleaned", "iob", "masked", "reject_reason"]
    annotated = annotate_notes(notes, lexicon, id_cols, text_col, strict, columns=wanted).checkpoint()
    labels = label_rows(annotated, id_cols, text_col)
    return labels, reject_rows(notes, annotated, id_cols, text_col)


def counted_labels(
    notes: DataFrame,
    lexicon: Lexicon,
    id_cols: list[str] | str = "doc_id",
    text_col: str = "text",
    strict: bool = False,
) -> tuple[DataFrame, Observation]:
    """``tag_notes``, and the label counts of all notes that go through it, counted on the way to the sink.

    Write the rows, then read the observation: ``code_1``, ``code_2``, ``code_5`` (notes per label code), ``equal`` and
    ``unequal`` (notes with valid labels per outcome of the size check). Notes are counted before rejects and repeats
    go, in one run of the taggers. Take the counts of one action only: a lost executor may make Spark run some tasks
    again, which are then counted twice; ``label_validation_counts`` is exact in that case too.
    """
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    wanted = [text_col, "cleaned", "iob", "masked", "label_code", "sizes", "reject_reason"]
    annotated = annotate_notes(notes, lexicon, id_cols, text_col, strict, columns=wanted)
    code, equal = F.col("label_code"), F.col("sizes.split_equals")
    seen = Observation()
    counted = annotated.observe(
        seen,
        *(F.count_if(code == c).alias(f"code_{c}") for c in (1, 2, 5)),
        F.count_if((code == 1) & (equal == 1)).alias("equal"),
        F.count_if((code == 1) & (equal == 0)).alias("unequal"),
    )
    return label_rows(counted, id_cols, text_col), seen


def spans_of_notes(
    notes: DataFrame,
    lexicon: Lexicon,
    id_cols: list[str] | str = "doc_id",
    text_col: str = "text",
    strict: bool = False,
) -> DataFrame:
    """What the labels of valid notes cover in the original text: ids, start_at, end_at, tag, covered.

    Offsets are code points of the text as it was given. Every valid note counts, also one whose cleaned text
    repeats another's; a note without labels has no rows. Each span is computed in its note's row.
    """
    id_cols = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    wanted = [text_col, "script", "iob", "reject_reason"]
    valid = valid_rows(annotate_notes(notes, lexicon, id_cols, text_col, strict, with_script=True, columns=wanted))
    text = F.col(text_col)

    def covered(span: Column) -> Column:
        length = span["end"] - span["start"]
        return F.struct(
            span["start"].alias("start_at"), span["end"].alias("end_at"), span["tag"].alias("tag"),
            F.substring(text, span["start"] + 1, length).alias("covered"),
        )

    spans = F.transform(label_spans(F.col("script"), F.col("iob")), covered)
    return valid.select(*id_cols, F.explode(spans).alias("span")).select(*id_cols, "span.*")
