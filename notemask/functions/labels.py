"""Labels: from masked tokens to B-/I-/O labels, and the checks on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notemask.constants import TAGS
from notemask.functions.chars import BEYOND, ENDS, SOLID, SPECIAL, STARTS, WHOLE, WIDE_SPACES, any_of, listed
from notemask.functions.spans import let, where
from notemask.functions.tokens import collapse_spaces, space_count

TAG_NAMES = any_of(TAGS)
ALPHABET = f"(?:O|[BI]-{TAG_NAMES})"
OTHER_SPACE = rf"[{listed(chr(9) + chr(13), chr(28) + chr(31))}[{BEYOND}&&[{WIDE_SPACES}]]]"
TAG_STARTS = "".join(sorted({t[0] for t in TAGS}))
UNTAGGED = f"{STARTS}(?!(?=[{TAG_STARTS}]){TAG_NAMES}{ENDS}){WHOLE}|{SPECIAL}"
NOT_O = "(?=[^O ]|O[^ ])"  # a label other than O starts, or any other character; tells most places in one test
SAME = r"\x{fdd0}"  # a noncharacter, used only inside one expression


def iob_raw(masked_tokens: Column) -> Column:
    """One ``O`` or tag per token.

    An apostrophe goes together with the tag or the (up to two) letters after it, so that
    ``Veteran's`` and ``PersonName'PersonName`` are one label each.
    """

    def in_blanks(tokens: Column) -> Column:
        # An O takes the blanks behind it along, so that few are left to collapse; tags get a blank of their own first.
        apart = F.regexp_replace(_joined(tokens), rf"(?=[{TAG_STARTS}]){STARTS}({TAG_NAMES}){ENDS}(?=[^ ])", "$1 ")
        return F.trim(collapse_spaces(F.regexp_replace(apart, f"(?:{UNTAGGED}) *", "O ")))

    return let(masked_tokens, lambda t: F.when(t.rlike(OTHER_SPACE), _per_label(t, " O ")).otherwise(in_blanks(t)))


def label_units(masked_tokens: Column) -> Column:
    """What each label of ``iob_raw`` stands for, in the same order and number: a tag, or the word or character behind an ``O``."""
    return _per_label(masked_tokens, " $0 ")


def _joined(masked_tokens: Column) -> Column:
    joined = F.regexp_replace(masked_tokens, f"'(?:{TAG_NAMES}|[a-zA-Z]{{0,2}})", "")
    return where(masked_tokens.contains("'"), masked_tokens, joined)


def _per_label(masked_tokens: Column, outside: str) -> Column:
    return F.trim(collapse_spaces(F.regexp_replace(_joined(masked_tokens), UNTAGGED, outside)))


def bio_labels(labels: Column) -> Column:
    """Prefix each tag with ``B-``, or with ``I-`` where it repeats the label before it."""

    def prefixed(single: Column) -> Column:
        repeats = F.regexp_replace(single, rf"{NOT_O}(?<![^ ])([^ ]++) (?=\1(?: |\z))", "$1 \ufdd0")
        outside = let(
            repeats, lambda r: where(r.contains("\ufdd0O"), r, F.regexp_replace(r, f"(?<![^ ]){SAME}O(?![^ ])", "O"))
        )
        begun = F.regexp_replace(outside, rf"{NOT_O}(?<![^ ])(?!{SAME})", "B-")
        return F.regexp_replace(begun, f"(?<![^ ]){SAME}", "I-")

    return let(F.trim(collapse_spaces(labels)), prefixed)


def label_code(labels: Column) -> Column:
    """1 valid, 2 a label outside the agreed set, 5 empty or null."""
    stray = f"(?<!{SOLID})(?!{ALPHABET}(?!{SOLID})){SOLID}"
    return F.when(labels.isNull() | (labels == ""), 5).when(labels.rlike(stray), 2).otherwise(1)


def token_count(text: Column) -> Column:
    """Pieces between white space. Where single blanks alone part them, as in cleaned texts, blanks are counted."""
    uneven = text.contains("  ") | text.startswith(" ") | text.endswith(" ") | text.rlike(OTHER_SPACE)
    counted = F.regexp_count(text, F.lit(f"{SOLID}+"))
    return F.when(text == "", 0).when(uneven, counted).otherwise(space_count(text) + 1)


def size_check(text: Column, labels: Column) -> Column:
    """Token counts of text and labels, and whether they agree; (0, 1, 0) if one is null."""
    counts = F.struct(token_count(text).alias("text"), token_count(labels).alias("labels"))
    missing = text.isNull() | labels.isNull()

    def sizes(n: Column) -> Column:
        return F.struct(
            F.when(~missing & (n["text"] == n["labels"]), 1).otherwise(0).alias("split_equals"),
            F.when(missing, 1).otherwise(n["text"]).alias("length_text"),
            F.when(missing, 0).otherwise(n["labels"]).alias("length_labels"),
        )

    return let(counts, sizes)
