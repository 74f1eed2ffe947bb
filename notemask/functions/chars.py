"""Character classes shared by the patterns (explicit, so every regex engine agrees on them).

In classes of hot patterns the ASCII characters are listed one by one, which Java keeps as one table and tests first, and
all others are behind a range from U+0080 on: a character of plain text takes two tests, where ranges would take one each.
"""


def listed(*ranges):
    """All characters of ASCII ranges (first and last), as a class."""
    return "[" + "".join(f"\\x{c:02x}" for first, last in ranges for c in range(ord(first), ord(last) + 1)) + "]"


# Bracket contents: word characters, and Unicode white space.
WORD_CHARS = r"0-9A-Za-z_\p{L}\p{N}"
WIDE_SPACES = r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
SPACE_CHARS = rf"\t-\r\x{{1c}}-\x{{20}}{WIDE_SPACES}"

BEYOND = r"\x{80}-\x{10ffff}"
WORD = f"[\\w[{BEYOND}&&[\\p{{L}}\\p{{N}}]]]"
NOT_WORD = f"[{listed(chr(0) + '/', ':@', '[^', '``', '{' + chr(127))}[{BEYOND}&&[^\\p{{L}}\\p{{N}}]]]"
UPPER = f"[{listed('AZ')}[{BEYOND}&&[\\p{{Lu}}]]]"
RUN = f"{WORD}++"  # one whole run of word characters, once started at its first character
WHOLE = f"{WORD}+"  # the same where nothing in the pattern can fail behind it: Java's fastest repeat
STARTS = f"(?<!{WORD})"
ENDS = f"(?!{WORD})"

# Anything but white space, and anything but white space, word characters and the apostrophe.
SOLID = f"[{listed(chr(0) + chr(8), chr(14) + chr(27), '!' + chr(127))}[{BEYOND}&&[^{WIDE_SPACES}]]]"
SPECIAL = (
    f"[{listed(chr(0) + chr(8), chr(14) + chr(27), '!&', '(/', ':@', '[^', '``', '{' + chr(127))}"
    f"[{BEYOND}&&[^{WIDE_SPACES}\\p{{L}}\\p{{N}}]]]"
)


def any_of(words, ignore_case=False):
    """A non-capturing alternation of plain words, longest first so a prefix never wins."""
    body = "|".join(sorted(words, key=lambda w: (-len(w), w)))
    return f"(?i:{body})" if ignore_case else f"(?:{body})"
