"""Pattern masks: e-mail, SSN, phone, URL, IP address and account number.

Each takes and returns a string column. They keep no state, so they also work on a stream.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from notemask.constants import (
    ACCOUNT_TAG,
    EMAIL_PATTERN,
    EMAIL_TAG,
    IP_PATTERN,
    IP_TAG,
    PHONE_PATTERN,
    PHONE_TAG,
    SSN_DASHED_PATTERN,
    SSN_TAG,
    URL_PATTERN,
    URL_TAG,
)
from notemask.functions.chars import ENDS, STARTS
from notemask.functions.spans import mask_spans, matches, where

SSN_PLAIN_PATTERN = f"(?=[0-9]){STARTS}[0-9]{{9}}{ENDS}"
ACCOUNT_PATTERN = f"(?=[0-9]){STARTS}[0-9]{{8}}{ENDS}"
PERHAPS_SSN = "[0-9]{3}-?[0-9]{2}-?[0-9]{4}"
NO_DIGIT_BEFORE, NO_DIGIT_AFTER = "(?<![0-9])", "(?![0-9])"


def mask_email(text: Column) -> Column:
    """E-mail addresses with the punctuation that touches them.

    A match always begins where white space ends; saying so keeps long strings linear.
    """
    return where(text.contains("@"), text, F.regexp_replace(text, rf"(?<!\S){EMAIL_PATTERN}", EMAIL_TAG))


def extract_ssn(text: Column) -> Column:
    """Social-security numbers in reading order: dashed, or nine digits on their own."""
    found = matches(text, f"{SSN_DASHED_PATTERN}|{SSN_PLAIN_PATTERN}")
    return F.when(text.rlike(PERHAPS_SSN), found).when(text.isNotNull(), F.array().cast("array<string>"))


def mask_ssn(text: Column) -> Column:
    dashed = F.regexp_replace(text, SSN_DASHED_PATTERN, SSN_TAG)
    return where(text.rlike(PERHAPS_SSN), text, F.regexp_replace(dashed, SSN_PLAIN_PATTERN, SSN_TAG))


def mask_phone(text: Column, strict: bool = False) -> Column:
    """One tag per white-space-separated piece of a number; the spacing inside it is kept.

    ``strict`` leaves longer digit strings (card numbers) alone.
    """
    pattern = f"{NO_DIGIT_BEFORE}{PHONE_PATTERN}{NO_DIGIT_AFTER}" if strict else PHONE_PATTERN
    pattern = f"(?=[(+0-9]){pattern}"
    return mask_spans(text, pattern, PHONE_TAG, inner=r"\S+")


def mask_url(text: Column) -> Column:
    return where(text.contains("http") | text.contains("www."), text, F.regexp_replace(text, URL_PATTERN, URL_TAG))


def mask_ip(text: Column, strict: bool = False) -> Column:
    """Dotted quads; ``strict`` also asks that no digit follows."""
    return F.regexp_replace(text, "(?=[0-9])" + IP_PATTERN + (NO_DIGIT_AFTER if strict else ""), IP_TAG)


def mask_account(text: Column) -> Column:
    return F.regexp_replace(text, ACCOUNT_PATTERN, ACCOUNT_TAG)


def pattern_steps(strict: bool = False) -> list[Callable[[Column], Column]]:
    """All pattern masks in their fixed order."""
    return [
        mask_email,
        mask_ssn,
        partial(mask_phone, strict=strict),
        mask_url,
        partial(mask_ip, strict=strict),
        mask_account,
    ]
