"""Lookup results written into the text: a marked word is followed by one reserved character.

The characters are the 32 noncharacters U+FDD0..U+FDEF; a text's own ones are stood in for while it
is marked. The mask's bits are the offset. With them in place every tagging step is a plain ``regexp_replace``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notemask.functions.chars import NOT_WORD, RUN, WHOLE
from notemask.functions.spans import gaps, interleave, let, matches
from notemask.operators.matches import MULTI_MARK, STATE_MARK, dense_bits, repeated_places

FIRST, LAST = 0xFDD0, 0xFDEF
MARK = r"[\x{fdd0}-\x{fdef}]"
MARKED_RUN = f"{RUN}{MARK}?"
PIECE = rf"{NOT_WORD}*+(?:{WHOLE}|\z)"  # a word with the gap before it, or what is left behind the last one


def mark_class(bits: int) -> str:
    """The marks that have at least one of ``bits`` set; other characters fail the range, in one test."""
    chars = [c for c in range(FIRST + 1, LAST + 1) if (c - FIRST) & bits]
    return f"[{MARK}&&[" + "".join(f"\\x{{{c:x}}}" for c in chars) + "]]"


def write_marks(text: Column, marks: Column, places: Column) -> Column:
    """``text`` with a mark behind every word that has bits set, and behind repeats of its places."""
    characters = F.array(F.lit(""), *[F.lit(chr(c)) for c in range(FIRST + 1, LAST + 1)])

    def repeats(words: Column, around: Column, bits: Column, mark: int) -> Column:
        again = F.transform(
            repeated_places(words, around, bits, places, mark),
            lambda p: F.struct(p.alias("pos"), F.lit(mark).alias("bits")),
        )
        return dense_bits(again, F.size(words))

    def with_repeats(words: Column, around: Column, bits: Column) -> Column:
        found = bits
        for mark in (MULTI_MARK, STATE_MARK):
            again = repeats(words, around, bits, mark)
            found = F.zip_with(found, again, lambda b, m: b.bitwiseOR(m))
        return found

    def marked_by(pieces: Column, bits: Column) -> Column:
        return F.zip_with(
            pieces, bits, lambda w, b: F.when(b == 0, w).otherwise(F.concat(w, F.get(characters, b)))
        )

    def written(words: Column) -> Column:
        def marked(around: Column, bits: Column) -> Column:
            return marked_by(words, with_repeats(words, around, bits))

        return let(
            gaps(text, WHOLE),
            lambda around: let(
                dense_bits(marks, F.size(words)), lambda bits: interleave(around, marked(around, bits))
            ),
        )

    def without_places(pieces: Column) -> Column:
        """Marks are few: the pieces up to each are joined in one go, where a test of every word would take one each."""

        def joined(ms: Column) -> Column:
            def up_to(m: Column, k: Column) -> Column:
                before = F.coalesce(F.get(ms, k - 1)["pos"], F.lit(-1))
                words = F.slice(pieces, before + 2, m["pos"] - before)
                return F.concat(F.array_join(words, ""), F.get(characters, m["bits"]))

            last = F.coalesce(F.get(ms, F.size(ms) - 1)["pos"], F.lit(-1))
            rest = F.slice(pieces, last + 2, F.size(pieces) - last - 1)
            return F.concat(F.array_join(F.transform(ms, up_to), ""), F.array_join(rest, ""))

        return let(marks, joined)

    return (
        F.when(marks.isNull(), text)
        .when(F.size(places) > 0, let(matches(text, WHOLE), written))
        .otherwise(let(matches(text, PIECE), without_places))
    )


# Where a text has reserved characters of its own, these stand in for them while it is marked.
STAND_INS = "".join(chr(c) for c in range(0xF8D0, 0xF8F0))
RESERVED = "".join(chr(c) for c in range(FIRST, LAST + 1))


def without_reserved(text: Column) -> Column:
    """The text with stand-ins for reserved characters, one for one."""
    return F.when(has_reserved(text), F.translate(text, RESERVED, STAND_INS)).otherwise(text)


def with_reserved(original: Column, masked: Column) -> Column:
    """Puts a text's own reserved characters back: untouched tokens come from the original."""

    def back(translated: Column) -> Column:
        tokens = F.zip_with(
            F.zip_with(
                F.split(original, " ", -1),
                F.split(translated, " ", -1),
                lambda o, t: F.struct(o.alias("original"), t.alias("translated")),
            ),
            F.split(masked, " ", -1),
            lambda p, m: F.when(p["translated"] == m, p["original"]).otherwise(
                F.translate(m, STAND_INS, RESERVED)
            ),
        )
        return F.array_join(tokens, " ")

    return F.when(has_reserved(original), let(without_reserved(original), back)).otherwise(masked)


def erase_marks(text: Column) -> Column:
    return F.regexp_replace(text, MARK, "")


def has_reserved(text: Column) -> Column:
    """Whether a text has reserved characters; the regex only runs where their first two bytes stand."""
    return F.contains(text.cast("binary"), F.lit(b"\xef\xb7")) & text.rlike(MARK)
