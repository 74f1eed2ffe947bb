"""Spacing and cleaning: from raw and masked text to space-separated tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notemask.constants import LENGTH_ERROR_TEXT
from notemask.functions.chars import BEYOND, SPECIAL, WIDE_SPACES, listed
from notemask.functions.spans import gaps, hold, let, matches, prefix_sums

HELD_SPACE = "\ufdd0"  # a noncharacter, used only inside one expression
DROPPED = r"[\r,\n\t\[\]]"
BLANKS = r"[\r,\n\t\[\] ]"  # those and the blank
RECORDED = r"[\x0b\n\t\r,\[\]] *"


def space_count(text: Column) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" ")))


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, "  +", " ")


def space_own_specials(text: Column) -> Column:
    """Spaces around every special character of the text itself."""
    return collapse_spaces(F.regexp_replace(text, SPECIAL, "  $0  "))


def space_specials(raw: Column, masked: Column) -> Column:
    """Spaces around those special characters of ``raw`` that its masked twin token still shows.

    A masked span keeps its punctuation inside, so it stays one token. Texts whose token counts
    differ become a fixed error text.
    """

    def own(pair: Column, pad_with: str = HELD_SPACE) -> Column:
        shown = F.array_distinct(matches(pair["masked"], SPECIAL))
        pad = F.lit(pad_with)
        return F.aggregate(
            shown, pair["raw"], lambda acc, c: F.replace(acc, c, F.concat(pad, c, pad))
        )

    pairs = F.zip_with(
        F.split(raw, " ", -1),
        F.split(masked, " ", -1),
        lambda r, m: F.struct(r.alias("raw"), m.alias("masked")),
    )
    # The unmasked tokens get their spaces in one pass over the whole text, held back as a reserved
    # character until the tokens are joined again. Most tokens have no special character and no mask.
    spaced = F.split(F.regexp_replace(raw, SPECIAL, f"{HELD_SPACE}$0{HELD_SPACE}"), " ", -1)

    def of_token(s: Column, m: Column) -> Column:
        unspaced = F.replace(s, F.lit(HELD_SPACE))
        pair = F.struct(unspaced.alias("raw"), m.alias("masked"))
        return F.when((s == m) | (unspaced == m), s).otherwise(own(pair))

    tokens = F.zip_with(spaced, F.split(masked, " ", -1), of_token)
    # a blank that stands alone stays as it is
    aligned = F.regexp_replace(
        F.array_join(tokens, " "), f"{HELD_SPACE}[ {HELD_SPACE}]*+| [ {HELD_SPACE}]++", " "
    )
    # a text that has the held-back character itself is spaced token by token
    apart = F.transform(
        pairs,
        lambda p: F.when(p["raw"] == p["masked"], F.regexp_replace(p["raw"], SPECIAL, " $0 ")).otherwise(
            own(p, " ")
        ),
    )
    one_by_one = collapse_spaces(F.array_join(apart, " "))
    return (
        F.when(raw == masked, space_own_specials(raw))
        .when(
            space_count(raw) == space_count(masked),
            F.when(raw.contains(HELD_SPACE), one_by_one).otherwise(aligned),
        )
        .when(raw.isNotNull() & masked.isNotNull(), F.lit(LENGTH_ERROR_TEXT))
    )


def special_locations(text: Column) -> Column:
    """Start, end and text of each line break, tab, comma and square bracket with its spaces."""

    def locate(found: Column) -> Column:
        def with_gaps(around: Column) -> Column:
            lengths = F.zip_with(
                around, found, lambda g, m: F.length(g) + F.coalesce(F.length(m), F.lit(0))
            )
            return F.filter(
                F.zip_with(
                    F.zip_with(prefix_sums(lengths), around, lambda p, g: p + F.length(g)),
                    found,
                    lambda start, m: F.when(
                        m.isNotNull(),
                        F.struct(
                            start.alias("start"),
                            (start + F.length(m)).alias("end"),
                            m.alias("character"),
                        ),
                    ),
                ),
                lambda s: s.isNotNull(),
            )

        return let(gaps(text, RECORDED), with_gaps)

    return let(matches(text, RECORDED), locate)


def drop_separators(text: Column) -> Column:
    """Line breaks, tabs, commas and square brackets become spaces."""
    return F.regexp_replace(text, DROPPED, " ")


def clean_text(text: Column) -> Column:
    """Line breaks, tabs, commas and square brackets become single spaces; ends are trimmed."""
    return F.trim(F.regexp_replace(text, rf"{DROPPED}{BLANKS}*+| {BLANKS}++", " "))


def clean_masked(masked: Column) -> Column:
    """Cleaning of the masked text, then spaces around its own special characters."""
    return space_own_specials(clean_text(masked))


def restore_specials(text: Column, locations: Column, block: int = 64) -> Column:
    """Put recorded characters back at their positions (lossy where a space stood in for one).

    Positions are those in the restored text so far. Where each lies behind the character before it, as
    ``special_locations`` gives them, the text is cut at all of them, in blocks first, so that a cut looks for its place in
    a short piece. Other lists are put back one by one, each time copying the text.
    """

    def one_by_one(given: Column) -> Column:
        return F.aggregate(
            given["locations"],
            given["text"],
            lambda acc, at: F.concat(
                F.substring(acc, F.lit(1), at["start"]),
                at["character"],
                F.substring(acc, at["start"] + 1, F.length(acc)),
            ),
        )

    def in_order(given: Column) -> Column:
        def behind(at: Column, i: Column) -> Column:
            before = F.get(given["locations"], i - 1)
            least = F.when(i == 0, 0).otherwise(before["start"] + F.length(before["character"]))
            return F.coalesce((at["start"] >= least) & at["character"].isNotNull(), F.lit(False))

        return F.forall(F.transform(given["locations"], behind), lambda o: o)

    def at_once(given: Column) -> Column:
        lengths = F.transform(given["locations"], lambda at: F.length(at["character"]))
        cuts = F.zip_with(
            given["locations"],
            prefix_sums(lengths),
            lambda at, put: F.struct((at["start"] - put).alias("at"), at["character"].alias("character")),
        )
        return let(cuts, lambda cs: in_blocks(given["text"], cs))

    def in_blocks(whole: Column, cuts: Column) -> Column:
        """``cuts``: the places in the text as given, and the characters that belong there."""

        def rejoined(b: Column) -> Column:
            first = F.when(b == 0, 0).otherwise(F.get(cuts, b * block)["at"])
            end = F.coalesce(F.get(cuts, (b + 1) * block)["at"], F.length(whole))
            piece = F.struct(
                first.alias("first"),
                F.substring(whole, first + 1, end - first).alias("text"),
                F.slice(cuts, b * block + 1, F.lit(block)).alias("cuts"),
            )
            return let(piece, put_back)

        def put_back(p: Column) -> Column:
            def up_to(cut: Column, j: Column) -> Column:
                last = F.when(j == 0, p["first"]).otherwise(F.get(p["cuts"], j - 1)["at"])
                return F.concat(F.substring(p["text"], last - p["first"] + 1, cut["at"] - last), cut["character"])

            rest = F.substring(p["text"], F.element_at(p["cuts"], -1)["at"] - p["first"] + 1, F.length(p["text"]))
            return F.concat(F.array_join(F.transform(p["cuts"], up_to), ""), rest)

        blocks = F.ceil(F.size(cuts) / F.lit(block)).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), blocks - 1), rejoined), "")

    def restored(given: Column) -> Column:
        return (
            F.when(F.size(given["locations"]) == 0, given["text"])
            .when(given["text"].isNotNull() & in_order(given), at_once(given))
            .otherwise(one_by_one(given))
        )

    return let(F.struct(text.alias("text"), locations.alias("locations")), restored)


# Characters that parting blanks can be held back as; a text is given the first one that it doesn't have.
HELD = [chr(c) for c in range(0xFDD0, 0xFDF0)]
# Solid characters but commas and square brackets; the character that blanks are held back as goes between the two parts.
KEPT_START = (
    f"[{listed(chr(0) + chr(8), chr(14) + chr(27), '!+', '-Z', chr(92) * 2, '^' + chr(127))}[{BEYOND}&&[^{WIDE_SPACES}"
)
KEPT_END = "]]]+"


def edit_script(raw: Column, masked: Column) -> Column:
    """How a text becomes its cleaned form, without loss: one piece for each token of the cleaned text, and a last one.

    A piece has ``before``, the run of the original that stands in front of the token (white space, line breaks, tabs,
    commas and square brackets; empty at a ``parted`` place, where cleaning only puts a blank between two tokens),
    the ``token``, which the original has as it is, and ``start``, its offset there in code points. The last piece has
    what follows the last token, and no token. Null if spacing gives up on the text (token counts differ), or if a
    text has all noncharacters that a blank can be held back as.
    """

    def script(held: Column) -> Column:
        # tokens without a mask get their blanks in one pass over the whole text
        own = F.regexp_replace(raw, F.lit(SPECIAL), F.concat(held, F.lit("$0"), held))

        def spaced(unmasked: Column, mask: Column) -> Column:
            shown = F.filter(F.array_distinct(matches(mask, SPECIAL)), lambda c: c != held)
            plain = F.replace(unmasked, held, F.lit(""))
            part = F.aggregate(shown, plain, lambda acc, c: F.replace(acc, c, F.concat(held, c, held)))
            return F.when((unmasked == mask) | (plain == mask), unmasked).otherwise(part)

        by_token = F.array_join(F.zip_with(F.split(own, " ", -1), F.split(masked, " ", -1), spaced), " ")
        marked = F.when(raw == masked, own).otherwise(by_token)
        # a held blank is no part of a token
        kept = F.concat(F.lit(KEPT_START), held, F.lit(KEPT_END))

        def pieces(tokens: Column, befores: Column) -> Column:
            lengths = F.zip_with(befores, tokens, lambda b, t: F.length(b) + F.coalesce(F.length(t), F.lit(0)))

            def placed(sums: Column) -> Column:
                def piece(before: Column, i: Column) -> Column:
                    token = F.get(tokens, i)
                    return F.struct(
                        before.alias("before"),
                        (before == "").alias("parted"),
                        token.alias("token"),
                        F.when(token.isNotNull(), F.get(sums, i) + F.length(before)).alias("start"),
                    )

                return F.transform(befores, piece)

            return hold(prefix_sums(lengths), placed)

        def around(m: Column) -> Column:
            return F.transform(gaps(m, kept), lambda g: F.replace(g, held, F.lit("")))

        return hold(marked, lambda m: hold(matches(m, kept), lambda t: hold(around(m), lambda g: pieces(t, g))))

    free = F.lit(None).cast("string")
    for character in reversed(HELD):
        free = F.when(~raw.contains(character), character).otherwise(free)
    usable = space_count(raw) == space_count(masked)
    return F.when(usable & free.isNotNull(), hold(free, script))


def restore_text(script: Column) -> Column:
    """The original text of an edit script."""
    return F.array_join(F.transform(script, lambda p: F.concat(p["before"], F.coalesce(p["token"], F.lit("")))), "")


def cleaned_of(script: Column) -> Column:
    """The cleaned text of an edit script."""
    between = lambda p: F.concat(F.when(p["parted"], " ").otherwise(p["before"]), F.coalesce(p["token"], F.lit("")))
    return clean_text(F.array_join(F.transform(script, between), ""))


def label_spans(script: Column, iob: Column) -> Column:
    """Start, end and tag of each labelled stretch of the original text, in code points, from the labels of its tokens.

    A ``B-`` label begins a stretch and the ``I-`` labels behind it belong to it. Null if labels and tokens differ in number.
    """

    def spans(labelled: Column) -> Column:
        begins = F.filter(
            F.transform(labelled, lambda t, i: F.when(t["label"].startswith("B-"), i)), lambda i: i.isNotNull()
        )

        def each(begin: Column) -> Column:
            def span(b: Column, j: Column) -> Column:
                last = F.get(labelled, F.coalesce(F.get(begin, j + 1), F.size(labelled)) - 1)
                return F.struct(
                    F.get(labelled, b)["start"].alias("start"),
                    last["end"].alias("end"),
                    F.substring(F.get(labelled, b)["label"], 3, 1000).alias("tag"),
                )

            return F.transform(begin, span)

        return hold(begins, each)

    def labelled(tokens: Column, labels: Column) -> Column:
        # most labels are O: only the other tokens are looked at
        places = F.filter(F.transform(labels, lambda x, i: F.when(x != "O", i)), lambda i: i.isNotNull())

        def token(i: Column) -> Column:
            start = F.get(tokens, i)["start"]
            end = start + F.length(F.get(tokens, i)["token"])
            return F.struct(start.alias("start"), end.alias("end"), F.get(labels, i).alias("label"))

        found = hold(F.transform(places, token), spans)
        return F.when(F.size(tokens) == F.size(labels), found)

    tokens = F.filter(script, lambda p: p["token"].isNotNull())
    labels = F.when(iob == "", F.array().cast("array<string>")).otherwise(F.split(iob, " ", -1))
    return hold(tokens, lambda ts: hold(labels, lambda ls: labelled(ts, ls)))
