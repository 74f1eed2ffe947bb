"""Name tagging, step by step, on a text that carries marks (see ``functions.marks``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notemask.constants import ADDRESS_TAG, CUTOFF_WORDS, NAME_TAG, ROLE_WORDS
from notemask.functions.chars import ENDS, RUN, STARTS, UPPER, WORD, WORD_CHARS, any_of
from notemask.functions.marks import MARK, MARKED_RUN, RESERVED, erase_marks, mark_class
from notemask.functions.spans import let, mask_spans, matches, where
from notemask.operators.address import widen_tags
from notemask.operators.matches import NAME_MARK

TAGGED = f"(?:{NAME_TAG}|{ADDRESS_TAG}){ENDS}"
NO_NAME = sorted({w.upper() for w in [*CUTOFF_WORDS, *ROLE_WORDS]})
CUTOFF = f"{any_of(NO_NAME, True)}{ENDS}"
NO_CLINIC_WORD = "(?![A-Za-z]*(?i:asst|neuro))"
END = f"{ENDS}{MARK}?+"


def title_word(guard: str = "") -> str:
    """Klein, McKinskey."""
    return f"{STARTS}(?!{TAGGED}){guard}[A-Z][a-z]+(?:[A-Z][a-z]+)?{END}"


def upper_word(guard: str = "") -> str:
    """KLEIN."""
    return f"{STARTS}(?!{TAGGED}){guard}[A-Z]{{2,}}{END}"


INITIAL = f"{STARTS}[A-Z]{END}"
SUFFIX_START = rf"[MDR]{MARK}?\.?[DON]"
SUFFIX = rf"(?:M{MARK}?\.?D|D{MARK}?\.?O|R{MARK}?\.?N(?:{MARK}?\.?A)?){ENDS}"


def _clinician() -> str:
    def full(word: str) -> str:
        return rf"{word}\s+(?:(?:{word}|{INITIAL}\.?)\s+)?{word}"

    words = f"(?:{full(title_word(NO_CLINIC_WORD))}|{full(upper_word(NO_CLINIC_WORD))})"
    return rf"(?=[A-Z]){words}\s*,?\s*{STARTS}{SUFFIX}"


def _last_first() -> str:
    """Last, First [Middle]: three words whose case agrees, else the first two of them.

    All forms are a word, a comma and a capital; looking for that first saves other words the guards.
    """
    guard = f"(?!{CUTOFF})"
    title, upper = title_word(guard), upper_word(guard)
    either = f"{STARTS}(?!{TAGGED}){guard}[A-Z][a-zA-Z]+{END}"
    comma, third = r"\s?,\s", rf"(?:[^{WORD_CHARS}\n]\s?|\s)"
    at = f"(?!At{ENDS})"
    return (
        f"(?=[A-Z][a-zA-Z]++{MARK}?+{comma}[A-Z])(?:{upper}{comma}{upper}{third}(?:{upper}|{INITIAL})"
        f"|{title}{comma}{title}{third}{title_word(guard + at)}"
        f"|{either}{comma}{either}{third}{INITIAL}"
        f"|{upper}{comma}{upper}|{title}{comma}{title})"
    )


def _after_role() -> str:
    """First [and] Last behind a role word and a comma; the role word itself is no name."""
    guard = f"(?!{CUTOFF})"
    title, upper = title_word(guard), upper_word(guard)
    between = rf"(?:[^{WORD_CHARS}\n]\s?|\s)"
    role = rf"(?<=(?<!{WORD}){any_of(NO_NAME, True)}\s?,\s)"
    return rf"(?=[A-Z])(?<=,\s){STARTS}{role}(?:{upper}{between}{upper}|{title}{between}{title})"


CLINICIAN_PATTERN = _clinician()
LAST_FIRST_PATTERN = _last_first()
AFTER_ROLE_PATTERN = _after_role()
BEHIND_ROLE = r",\s[A-Z](?<=[A-Za-z]\s?,\s[A-Z])"
TITLED_PATTERN = rf"(?=[DM]){STARTS}(?:Dr|Mrs|Mr|Ms)\.?\s([A-Z][a-zA-Z]*){ENDS}"


def last_first_spans(text: Column) -> Column:
    """``Last, First Middle`` spans that pass the cut-off and case rules, as written."""
    return matches(text, LAST_FIRST_PATTERN)


def has_name(span: Column) -> Column:
    """The dictionary confirms at least one word."""
    return span.rlike(mark_class(NAME_MARK))


def mask_clinician(text: Column) -> Column:
    """Two or three names in front of MD, DO, RN or RNA, with that suffix."""
    return where(text.rlike(SUFFIX_START), text, mask_spans(text, CLINICIAN_PATTERN, NAME_TAG, MARKED_RUN))


def mask_last_first(text: Column) -> Column:
    """Confirmed ``Last, First Middle`` spans, and their repeats in any case."""

    def escaped(span: Column) -> Column:
        quoted = F.regexp_replace(erase_marks(span), rf"[^\s{WORD_CHARS}]", r"\\$0")
        return F.regexp_replace(quoted, RUN, f"$0[{RESERVED[0]}-{RESERVED[-1]}]?")

    def repeats(masked: Column, named: Column) -> Column:
        spans = F.array_distinct(F.transform(named, lambda s: F.lower(escaped(s))))
        longest_first = F.array_sort(spans, lambda a, b: F.length(b) - F.length(a))
        any_span = F.concat(F.lit(f"(?i){STARTS}(?:"), F.array_join(longest_first, "|"), F.lit(f"){ENDS}"))
        return mask_spans(masked, any_span, NAME_TAG, MARKED_RUN)

    def rewrite(named: Column) -> Column:
        masked = mask_spans(text, LAST_FIRST_PATTERN, NAME_TAG, MARKED_RUN, keep=has_name)
        return F.when(F.size(named) > 0, repeats(masked, named)).otherwise(text)

    confirmed = let(F.filter(matches(text, LAST_FIRST_PATTERN), has_name), rewrite)
    return where(text.contains(",") & has_name(text), text, confirmed)


def mask_after_role(text: Column) -> Column:
    """Confirmed two-word names behind a role word and a comma."""
    masked = mask_spans(text, AFTER_ROLE_PATTERN, NAME_TAG, MARKED_RUN, keep=has_name)
    return where(text.rlike(BEHIND_ROLE), text, masked)


def mask_titled(text: Column) -> Column:
    """Capitalised words behind Dr, Mr, Ms or Mrs are masked wherever they stand in the note."""

    def rewrite(titled: Column) -> Column:
        # lower case makes a "k" of the Kelvin sign, too
        words = F.array_join(F.transform(titled, lambda w: F.replace(w, F.lit("k"), F.lit("[k\u212a]"))), "|")
        whole = F.concat(F.lit(f"(?=[A-Za-z\u212a]){STARTS}(?i:"), words, F.lit(f"){ENDS}{MARK}?"))
        return F.when(F.size(titled) > 0, F.regexp_replace(text, whole, F.lit(NAME_TAG))).otherwise(text)

    words = F.transform(matches(text, TITLED_PATTERN, 1), lambda w: F.lower(w))
    tags = [NAME_TAG.lower(), ADDRESS_TAG.lower()]
    titled = F.filter(F.array_distinct(words), lambda w: ~w.isin(tags))
    return F.when(text.rlike(TITLED_PATTERN), let(titled, rewrite)).otherwise(text)


def mask_dictionary_name(text: Column) -> Column:
    """Capitalised words of two or more characters, and names of several runs, in the name list."""
    pattern = rf"(?={UPPER}(?:{WORD}|{MARK}['.-])){STARTS}{RUN}{mark_class(NAME_MARK)}"
    return where(has_name(text), text, F.regexp_replace(text, pattern, NAME_TAG))


def mask_middle(text: Column) -> Column:
    """A capitalised word or initial between two tagged tokens."""
    alone = rf"[\p{{L}}\x{{fdd0}}-\x{{fdef}}]*+(?= [^ ]*{NAME_TAG})"
    dotted = rf"[^ ]*\.[^ ]* [^ ]*{NAME_TAG}"
    not_tag = rf"(?!{TAGGED}(?: |\z))"
    pattern = rf"({NAME_TAG}[^ ]* ){not_tag}(?=\p{{Lu}}(?:{alone}|{dotted})){MARKED_RUN}"
    return where(text.contains(NAME_TAG), text, F.regexp_replace(text, pattern, f"$1{NAME_TAG}"))


def mask_hyphen(text: Column) -> Column:
    """``a-b`` where one half is a name (in any case) or already tagged: both halves."""
    named = f"(?:{NAME_TAG}{ENDS}|{RUN}{mark_class(NAME_MARK)})"
    pattern = f"{STARTS}(?:{named}-{MARKED_RUN}|{MARKED_RUN}-{named})"
    masked = F.regexp_replace(text, pattern, f"{NAME_TAG}-{NAME_TAG}")
    return F.when(text.contains("-"), masked).otherwise(text)


def normalize_name_tags(text: Column) -> Column:
    """Tags fill their whole token; a possessive ``'s`` (up to two letters) stays."""
    inner = f"{STARTS}(?<!'){MARKED_RUN}|(?<='){WORD}{{3,}}+{MARK}?"
    return widen_tags(text, NAME_TAG, inner)


# All name steps in their fixed order; the marks are gone afterwards.
NAME_STEPS = [
    mask_clinician,
    mask_last_first,
    mask_after_role,
    mask_titled,
    mask_dictionary_name,
    mask_middle,
    mask_hyphen,
    normalize_name_tags,
    erase_marks,
]
