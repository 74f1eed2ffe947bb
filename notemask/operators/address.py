"""Address tagging, step by step, on a text that carries marks (see ``functions.marks``).

Every step keeps the number of space-separated tokens and of word runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notemask.constants import (
    ADDRESS_TAG,
    CLINIC_WORDS,
    DIRECTION_WORDS,
    STATE_ABBREVIATIONS,
    STREET_WORDS,
)
from notemask.functions.chars import (
    ENDS,
    NOT_WORD,
    RUN,
    SOLID,
    SPACE_CHARS,
    STARTS,
    WORD,
    WORD_CHARS,
    any_of,
)
from notemask.functions.marks import MARK, MARKED_RUN, mark_class
from notemask.functions.spans import let, mask_named_spans, mask_spans, matches, where
from notemask.operators.matches import CITY_MARK, MULTI_MARK, PAIR_MARK, STATE_MARK, ZIP_MARK

STREET_TAIL = rf"{any_of(STREET_WORDS, True)}[.,]?{NOT_WORD}?(?=\s|\z)"
STREET_FIRSTS = "".join(sorted({c for w in STREET_WORDS for c in (w[0], w[0].upper())}))
# A street word ends the address, at most 24 characters behind its start: looking for that first saves most numbers the
# many ways to part the characters between.
STREET_AHEAD = f"(?=(?s:.{{2,24}}?)(?=[{STREET_FIRSTS}]){STREET_TAIL})"
STREET_PATTERN = (
    rf"(?=[0-9]){STARTS}{STREET_AHEAD}[0-9]{{1,5}}\s?{WORD}?[^\n]?[{WORD_CHARS}\s]{{1,16}}{STREET_TAIL}"
)
APARTMENT_PATTERN = r"(?<=\s)(?:APT|Apt)\s[a-zA-Z0-9_.-]+"
STREET_END = rf"(?:^| ){NOT_WORD}*{any_of(STREET_WORDS, True)}{NOT_WORD}*\z"
ORDINAL = r"[0-9](?i:st|rd|nd|th)"
NOT_TITLE = r"\p{Lu}\p{Lu}|\p{Ll}\p{Lu}(?!\p{Ll})|(?<!\p{L})\p{Ll}"
TO_NEXT_LETTER = r"[^\p{L}]*+"
FIVE_DIGITS = r"(?=[0-9])(?<![0-9])[0-9]{5}(?![0-9])"
CITY_BEFORE_CONTEXT = (
    f"{STARTS}({RUN}){mark_class(CITY_MARK)}"
    f"(?={TO_NEXT_LETTER}(?:{any_of(CLINIC_WORDS, True)}{ENDS}|{ADDRESS_TAG}))"
)


def is_street(span: Column) -> Column:
    """Title case, all upper case or with an ordinal; and the last word is a street word."""
    text = F.trim(span)
    letters = F.regexp_replace(text, f"[^{SPACE_CHARS}{WORD_CHARS}]", "")
    title = letters.rlike(r"\p{Lu}") & ~letters.rlike(NOT_TITLE)
    upper = text.rlike(r"\p{Lu}") & ~text.rlike(r"\p{Ll}")
    return (title | upper | text.rlike(ORDINAL)) & text.rlike(STREET_END)


def street_spans(text: Column) -> Column:
    """Street addresses of a text as written, and its apartment numbers."""
    streets = F.filter(matches(text, STREET_PATTERN), is_street)
    return F.transform(F.concat(streets, matches(text, APARTMENT_PATTERN)), lambda s: F.trim(s))


def street_key(span: Column) -> Column:
    """What repeats of a street have in common: its words in lower case."""
    return F.trim(F.regexp_replace(F.lower(span), f"{NOT_WORD}+", " "))


def mask_street_spans(text: Column) -> Column:
    """Streets, and their repeats in any case."""
    return mask_named_spans(text, STREET_PATTERN, ADDRESS_TAG, street_key, is_street)


def mask_street(text: Column) -> Column:

    def apartments(masked: Column) -> Column:
        has_one = masked.contains("APT") | masked.contains("Apt")
        return where(has_one, masked, mask_spans(masked, APARTMENT_PATTERN, ADDRESS_TAG))

    return let(mask_street_spans(text), apartments)


def mask_marked(text: Column, bits: int, tag: str) -> Column:
    """Every word with one of ``bits`` becomes the tag."""
    return where(text.rlike(mark_class(bits)), text, F.regexp_replace(text, f"{STARTS}{RUN}{mark_class(bits)}", tag))


def mask_multiword_city(text: Column) -> Column:
    return mask_marked(text, MULTI_MARK, ADDRESS_TAG)


def mask_city_state(text: Column) -> Column:
    """Cities followed by one of their states, with that state."""
    return mask_marked(text, PAIR_MARK, ADDRESS_TAG)


def mask_city_clinic(text: Column) -> Column:
    """Cities followed by a clinic word or an address tag, unless a name or initial precedes."""
    masked = F.regexp_replace(text, CITY_BEFORE_CONTEXT, ADDRESS_TAG)
    return where(text.rlike(mark_class(CITY_MARK)), text, masked)


def mask_state_abbrev(text: Column) -> Column:
    """A state abbreviation that is the next word behind an address tag."""
    pattern = (
        f"{STARTS}{ADDRESS_TAG}{ENDS}({TO_NEXT_LETTER}){STARTS}{any_of(STATE_ABBREVIATIONS)}{ENDS}{MARK}?"
    )
    return where(text.contains(ADDRESS_TAG), text, F.regexp_replace(text, pattern, f"{ADDRESS_TAG}$1{ADDRESS_TAG}"))


def mask_state_full(text: Column) -> Column:
    return mask_marked(text, STATE_MARK, ADDRESS_TAG)


def known_address_words(marked: Column) -> Column:
    """City and state words of the text that get masked somewhere, in lower case."""
    bits = mark_class(MULTI_MARK | PAIR_MARK | STATE_MARK)
    by_mark = matches(marked, f"{STARTS}({RUN}){bits}", 1)
    by_context = matches(mask_marked(marked, MULTI_MARK | PAIR_MARK, ADDRESS_TAG), CITY_BEFORE_CONTEXT, 1)
    return F.transform(F.array_distinct(F.concat(by_mark, by_context)), lambda w: F.lower(w))


def mask_zip(text: Column, known: Column) -> Column:
    """ZIP codes (from the list) and ZIP+4 with an address within the two tokens before them."""
    listed = f"(?=[0-9]){STARTS}[0-9]{{5}}{mark_class(ZIP_MARK)}"
    plus_four = f"(?=[0-9])(?<![0-9])[0-9]{{5}}{MARK}?-[0-9]{{4}}(?![0-9])"
    any_code = f"(?=[0-9])(?:{STARTS}[0-9]{{5}}{mark_class(ZIP_MARK)}|(?<![0-9])[0-9]{{5}}{MARK}?-[0-9]{{4}}(?![0-9]))"

    def rewrite(words: Column, tokens: Column) -> Column:
        def is_address(token: Column) -> Column:
            plain = F.lower(F.trim(F.regexp_replace(token, f"[^{SPACE_CHARS}{WORD_CHARS}]", "")))
            return F.coalesce(
                token.contains(ADDRESS_TAG) | F.array_contains(words, plain), F.lit(False)
            )

        def token(t: Column, i: Column) -> Column:
            one_run = F.size(matches(t, FIVE_DIGITS)) == 1
            code = t.rlike(any_code) & ((t.rlike(listed) & one_run) | t.rlike(plus_four))
            near = is_address(F.get(tokens, i - 1)) | is_address(F.get(tokens, i - 2))
            masked = F.regexp_replace(t, f"[0-9]++{MARK}?", ADDRESS_TAG)
            return F.when(code & near, masked).otherwise(t)

        return F.array_join(F.transform(tokens, token), " ")

    def near_any(words: Column) -> Column:
        rewritten = let(F.split(text, " ", -1), lambda ts: rewrite(words, ts))
        return where(text.contains(ADDRESS_TAG) | (F.size(words) > 0), text, rewritten)

    return where(text.rlike(any_code), text, let(known, near_any))


def erase_zip_marks(text: Column) -> Column:
    """Marks behind ZIP codes have served once the codes are masked; no later step may read them as names."""
    code = f"[0-9]{{5}}{MARK}"
    return where(text.rlike(code), text, F.regexp_replace(text, f"{STARTS}([0-9]{{5}}){MARK}", "$1"))


def widen_tags(text: Column, tag: str, inner: str = MARKED_RUN) -> Column:
    """In every piece between white space that holds the tag, all word runs become the tag."""
    piece = f"(?<!{SOLID}){SOLID}*?{tag}{SOLID}*+"
    other = f"{STARTS}(?!{tag}{ENDS}){WORD}|{tag}{MARK}"  # a run that is not the tag already

    def widen(token: Column) -> Column:
        partial_tag = token.contains(tag) & (token != tag) & token.rlike(other)
        return F.when(partial_tag, mask_spans(token, piece, tag, inner)).otherwise(token)

    tokens = F.transform(F.split(text, " ", -1), widen)
    return F.when(text.contains(tag), F.array_join(tokens, " ")).otherwise(text)


def tag_directions(text: Column) -> Column:
    """A direction word before a bare tag becomes a tag."""
    pattern = (
        rf"(?<![^ ])([{SPACE_CHARS}]*){any_of(DIRECTION_WORDS, True)}{ENDS}{MARK}?"
        rf"([\t-\r]*) (?={ADDRESS_TAG}(?: |\z))"
    )
    return where(text.contains(ADDRESS_TAG), text, F.regexp_replace(text, pattern, f"$1{ADDRESS_TAG}$2 "))


def fill_address_tags(text: Column) -> Column:
    return widen_tags(text, ADDRESS_TAG)


def mask_places(text: Column) -> Column:
    """Multi-word cities, and cities with their states."""
    return mask_marked(text, MULTI_MARK | PAIR_MARK, ADDRESS_TAG)


# Address steps between the lookups and the ZIP codes, and those after the ZIP codes.
PLACE_STEPS = [mask_places, mask_city_clinic, mask_state_abbrev, mask_state_full]
CLEANUP_STEPS = [erase_zip_marks, tag_directions, fill_address_tags]
