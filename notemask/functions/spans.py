"""Span operators: rewrite regex matches in a text while keeping its shape.

Everything here is a column expression. ``let`` binds an expensive expression to a lambda
variable so that it is evaluated once per row however often the body uses it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from notemask.constants import ADDRESS_TAG, ROLE_WORDS
from notemask.functions.chars import ENDS, NOT_WORD, RUN, SOLID, STARTS, any_of


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def hold(value: Column, body: Callable[[Column], Column]) -> Column:
    """``let`` for bodies that make long arrays: ``transform`` copies what it makes, with all strings, at each level.

    A fold over nothing doesn't; it takes somewhat longer to plan.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda bound, _: bound, body)


def where(condition: Column, text: Column, rewritten: Column) -> Column:
    """``rewritten`` if the condition holds, else the text as it is: a plain test that saves most texts a costly pattern."""
    return F.when(condition, rewritten).otherwise(text)


def matches(text: Column, pattern: str | Column, group: int = 0) -> Column:
    """All matches of ``pattern``, left to right and not overlapping."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def gaps(text: Column, pattern: str | Column) -> Column:
    """The pieces of ``text`` around the matches of ``pattern`` (one more than there are matches)."""
    return F.split(text, pattern, -1)


def interleave(gap_array: Column, match_array: Column) -> Column:
    """Put matches back between their gaps."""
    return F.array_join(
        F.zip_with(gap_array, match_array, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), ""
    )


def rewrite_spans(text: Column, pattern: str, rewrite: Callable[[Column], Column]) -> Column:
    """Replace every match of ``pattern`` by ``rewrite(match)``; texts without a match pass through."""

    def put_back(found: Column) -> Column:
        rewritten = interleave(gaps(text, pattern), F.transform(found, rewrite))
        return F.when(F.size(found) > 0, rewritten).otherwise(text)

    return let(matches(text, pattern), put_back)


def mask_spans(
    text: Column,
    pattern: str,
    tag: str,
    inner: str = RUN,
    keep: Callable[[Column], Column] | None = None,
) -> Column:
    """Tag expansion: inside every match each ``inner`` run becomes one tag, punctuation stays.

    ``keep`` may reject single matches, which then stay as they are.
    """

    def expand(match: Column) -> Column:
        tagged = F.regexp_replace(match, inner, tag)
        return tagged if keep is None else F.when(keep(match), tagged).otherwise(match)

    return rewrite_spans(text, pattern, expand)


def mask_named_spans(
    text: Column,
    pattern: str,
    tag: str,
    key: Callable[[Column], Column],
    keep: Callable[[Column], Column],
    inner: str = RUN,
) -> Column:
    """``mask_spans`` for matches that ``keep`` accepts and for all others that have the key of one."""

    def rewrite(found: Column, kept: Column) -> Column:
        def expand(match: Column) -> Column:
            tagged = F.regexp_replace(match, inner, tag)
            return F.when(F.array_contains(kept, key(match)), tagged).otherwise(match)

        rewritten = interleave(gaps(text, pattern), F.transform(found, expand))
        return F.when(F.size(kept) > 0, rewritten).otherwise(text)

    def with_kept(found: Column) -> Column:
        return let(F.transform(F.filter(found, keep), key), lambda kept: rewrite(found, kept))

    return let(matches(text, pattern), with_kept)


def strip_role_word(span: Column) -> Column:
    """Drop role words (title or upper case) with the separators behind them."""
    roles = any_of(ROLE_WORDS + [w.upper() for w in ROLE_WORDS])
    return F.regexp_replace(span, f"{STARTS}{roles}{ENDS}{NOT_WORD}*+", "")


def masked_token_diff(before: Column, after: Column) -> Column:
    """The tokens of ``before`` that a masking step changed, without ``-``, ``,`` and ``+``."""

    def tokens(text: Column) -> Column:
        return matches(text, f"{SOLID}+")

    changed = F.zip_with(
        tokens(before),
        tokens(after),
        lambda b, a: F.when(b != a, F.regexp_replace(b, "[-,+]", "")),
    )
    return F.filter(changed, lambda t: t.isNotNull() & ~t.contains(ADDRESS_TAG))


def prefix_sums(numbers: Column, block: int = 8, levels: int = 2) -> Column:
    """Running totals of an int array, starting at 0 and without the grand total.

    The sums inside a block are written out, so an element costs about half a block's additions; the totals of the blocks
    are summed the same way, ``levels`` times, and only those of the last level one by one, copying the list for each.
    """

    def one_by_one(xs: Column) -> Column:
        return F.aggregate(
            xs,
            F.array(F.lit(0)),
            lambda acc, x: F.concat(acc, F.array((F.element_at(acc, -1) + x).cast("int"))),
            lambda acc: F.slice(acc, 1, F.size(acc) - 1),
        )

    def first(part: Column, n: int, start: Column) -> Column:
        total = start
        for k in range(n):
            total = (total + F.get(part, F.lit(k))).cast("int")
        return total

    def sums(xs: Column, level: int) -> Column:
        if level == 0:
            return one_by_one(xs)
        padded = F.concat(xs, F.array(*[F.lit(0)] * (block - 1)))
        count = F.ceil(F.size(xs) / F.lit(block)).cast("int")

        def blocked(full: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(full, b * block + 1, F.lit(block)))

        def with_totals(parts: Column) -> Column:
            totals = F.transform(parts, lambda p: first(p, block, F.lit(0)))
            within = lambda p, start: F.array(*[first(p, n, start) for n in range(block)])
            whole = hold(totals, lambda ts: F.zip_with(parts, sums(ts, level - 1), within))
            return F.slice(F.flatten(whole), F.lit(1), F.size(xs))

        return F.when(F.size(xs) > 0, hold(hold(padded, blocked), with_totals)).otherwise(F.array().cast("array<int>"))

    return hold(numbers, lambda xs: sums(xs, levels))
