"""Column functions on literal rows."""

import re
import time

from pyspark.sql import functions as F

from notemask.constants import LENGTH_ERROR_TEXT
from notemask.functions import chars, labels, marks, patterns, spans, tokens
from notemask.operators import address, gazetteers, names


def one(spark, expression, **values):
    columns = [F.lit(v).cast("string").alias(k) for k, v in values.items()]
    return spark.range(1).select(*columns).select(expression.alias("x")).first()["x"]


def text_of(spark, rewrite, text):
    return one(spark, rewrite(F.col("t")), t=text)


def test_pattern_masks(spark):
    cases = [
        (patterns.mask_email, "to (a.b@mail.org) now", "to EAddress now"),
        (patterns.mask_ssn, "123-45-6789 and 123456789 not 1234567890", "SSNumber and SSNumber not 1234567890"),
        (patterns.mask_account, "12345678 123456789", "AccountNumber 123456789"),
        (patterns.mask_account, "é12345678é", "é12345678é"),
        (patterns.mask_url, "http://www2.example.com http://wwwx.org https://a.bc www.abc.org/x", "http://www2.example.com http://wwwx.org URLAddress URLAddress"),
        (patterns.mask_ip, "10.0.0.255 1.2.3.4567", "IPAddress IPAddress67"),
        (patterns.mask_phone, "(123)  345-4566 x", "PhoneNumber  PhoneNumber x"),
        (patterns.mask_phone, "1234567890123456", "PhoneNumber3456"),
    ]
    for rewrite, text, expected in cases:
        assert text_of(spark, rewrite, text) == expected


def test_strict_masks_need_a_boundary(spark):
    strict_phone = lambda t: patterns.mask_phone(t, strict=True)
    strict_ip = lambda t: patterns.mask_ip(t, strict=True)
    assert text_of(spark, strict_phone, "1234567890123456") == "1234567890123456"
    assert text_of(spark, strict_ip, "1.2.3.4567") == "1.2.3.4567"


def test_pattern_masks_are_idempotent(spark):
    text = "a@bb.cc 123-45-6789 (123)345-4566 http://www.abc.org 1.2.3.4 12345678 é"
    for rewrite in patterns.pattern_steps():
        once = text_of(spark, rewrite, text)
        assert text_of(spark, rewrite, once) == once


def test_extract_ssn(spark):
    found = text_of(spark, patterns.extract_ssn, "123456789 then 123-45-6789 and 12345678")
    assert found == ["123456789", "123-45-6789"]


def test_spacing_keeps_masked_spans_whole(spark):
    raw = "Norwin's Phone number is (123)345-4566. Hello more-text here"
    masked = text_of(spark, patterns.mask_phone, raw)
    assert masked == "Norwin's Phone number is PhoneNumber. Hello more-text here"
    spaced = one(spark, tokens.space_specials(F.col("r"), F.col("m")), r=raw, m=masked)
    assert spaced == "Norwin's Phone number is (123)345-4566 . Hello more - text here"
    iob = text_of(spark, lambda m: labels.bio_labels(labels.iob_raw(tokens.clean_masked(m))), masked)
    assert iob == "O O O O B-PhoneNumber O O O O O O"


def test_spacing_of_unequal_token_counts(spark):
    assert one(spark, tokens.space_specials(F.col("r"), F.col("m")), r="a b", m="a") == LENGTH_ERROR_TEXT


def test_special_locations_and_restore(spark):
    text = ",a\r\nb, [c]"
    found = [tuple(x) for x in text_of(spark, tokens.special_locations, text)]
    assert found == [(0, 1, ","), (2, 3, "\r"), (3, 4, "\n"), (5, 7, ", "), (7, 8, "["), (9, 10, "]")]
    many = "a, b" * 700
    assert len(text_of(spark, tokens.special_locations, many)) == 700
    assert [x["start"] for x in text_of(spark, tokens.special_locations, many)] == [
        4 * i + 1 for i in range(700)
    ]
    restore = lambda t: tokens.restore_specials(tokens.clean_text(t), tokens.special_locations(t))
    # A comma with its space stands for one space, which the cleaned text keeps.
    assert text_of(spark, restore, "a,b") == "a, b"


def test_prefix_sums_cross_blocks(spark):
    numbers = F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda x: x.cast("int"))
    sums = spark.range(1).select(spans.prefix_sums(numbers).alias("x")).first()["x"]
    assert sums == [i * (i + 1) // 2 for i in range(1000)]


def test_labels(spark):
    bio = lambda t: text_of(spark, labels.bio_labels, t)
    assert (
        bio("O PersonName PersonName O PAddress PersonName")
        == "O B-PersonName I-PersonName O B-PAddress B-PersonName"
    )
    assert bio("  A  A A ") == "B-A I-A I-A"
    code = lambda t: text_of(spark, labels.label_code, t)
    assert [code(t) for t in (None, "", "B-Foo", "O", " ", "O I-PAddress B-SSNumber")] == [5, 5, 2, 1, 1, 1]
    size = lambda a, b: tuple(one(spark, labels.size_check(F.col("a"), F.col("b")), a=a, b=b))
    assert [size("a b", "O O"), size("a b", "O"), size(None, "O")] == [(1, 2, 2), (0, 2, 1), (0, 1, 0)]


def test_apostrophes_make_one_label(spark):
    raw = lambda t: text_of(spark, labels.iob_raw, t)
    assert raw("Veteran's PersonName's PersonName'PersonName") == "O PersonName PersonName"


def test_streets(spark):
    mask = lambda t: text_of(spark, address.mask_street, t)
    assert mask("at 68 Oak St., x") == "at PAddress PAddress PAddress., x"
    assert mask("at 9 walker lane today") == "at 9 walker lane today"
    assert mask("at 45 west 2nd ave today") == "at PAddress PAddress PAddress PAddress today"
    assert mask("in APT 4B now") == "in PAddress PAddress now"
    assert mask("123 Oak Park is closed") == "123 Oak Park is closed"


def test_last_first_spans(spark):
    spans_of = lambda t: text_of(spark, names.last_first_spans, t)
    assert spans_of("Signed CLARK , JULIE APR 5") == ["CLARK , JULIE"]
    assert spans_of("JONES , MYNA At: x") == ["JONES , MYNA"]
    assert spans_of("Jones, Myna At home") == ["Jones, Myna"]
    assert spans_of("by KLEIN , MIRANDA S. today") == ["KLEIN , MIRANDA S"]
    assert spans_of("Clark , SANDY") == []


def test_role_words_and_token_diff(spark):
    assert text_of(spark, spans.strip_role_word, "Intern, Laura S") == "Laura S"
    diff = spans.masked_token_diff(F.col("a"), F.col("b"))
    changed = one(spark, diff, a="in New-York, Ohio x", b="in PAddress-PAddress, PAddress x")
    assert changed == ["NewYork", "Ohio"]


def test_keys_and_title_case(spark):
    assert text_of(spark, gazetteers.title_case, "mary-ann o'BRIEN de la cruz") == "Mary-Ann O'Brien De La Cruz"
    assert text_of(spark, gazetteers.match_key, " O'Brien,  Mary-Ann ") == "obrien maryann"


def test_long_texts_stay_linear(spark):
    """Strings without spaces or with one giant word must not backtrack without end."""
    for text in ("x" * 200_000, "1, " * 60_000, "Ab" * 100_000, "." * 200_000, "a@" * 2_000):
        rows = spark.createDataFrame([(text,)], "t string")
        for rewrite in [*patterns.pattern_steps(), *address.PLACE_STEPS, *names.NAME_STEPS]:
            rows = rows.withColumn("t", rewrite(F.col("t")))
        rows.write.format("noop").mode("overwrite").save()


def test_token_counts_by_blanks_or_by_pattern(spark):
    from notemask.functions.labels import token_count

    texts = ["", " ", "a", "a b", " a b", "a b ", "a  b", "a\tb", "a\u00a0b c", "a\x0bb", "\n", "é 日本 😀", "a\x1cb", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["n"] for r in rows.select(token_count(F.col("t")).alias("n")).collect()]
    assert got == [None if t is None else len(t.split()) for t in texts]


ODD_TEXTS = [
    "", " ", "a", " a  b ", "a,b [c]\td\r\n e", ",", "[]", "x\u00a0y\x0bz", "é 日本,😀! it's", "\ufdd0 a\ufdd1,b \ufdd0",
    "Dr. Klein, MD (x)--y", "PersonName, b", "".join(chr(c) for c in range(0xFDD0, 0xFDEF)) + " a,b", "a.b.c " * 700,
]


def test_edit_scripts_lose_nothing(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_TEXTS)], "i int, text string")
    masked = F.regexp_replace(F.regexp_replace("text", "Klein", "PersonName"), r"\(x\)--y", "PhoneNumber")
    script = tokens.edit_script(F.col("text"), F.col("masked"))
    cleaned = tokens.clean_text(tokens.space_specials(F.col("text"), F.col("masked")))
    rows = rows.withColumn("masked", masked).withColumns({"script": script, "cleaned": cleaned})
    rows = rows.withColumns({"restored": tokens.restore_text(F.col("script")), "again": tokens.cleaned_of(F.col("script"))})
    for r in rows.collect():
        assert r["restored"] == r["text"] and r["again"] == r["cleaned"], repr(r["text"][:40])
        pieces = [p for p in r["script"] if p["token"] is not None]
        assert [p["token"] for p in pieces] == r["cleaned"].split()
        assert all(r["text"][p["start"] :].startswith(p["token"]) for p in pieces)
        assert r["script"][-1]["token"] is None and len(pieces) == len(r["script"]) - 1


def test_edit_scripts_cost_a_few_spacings(spark):
    words = F.concat(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(20000)), lambda i: F.concat(F.lit("Ann, w"), i)), " "), "id")
    rows = spark.range(16, numPartitions=8).select(words.alias("text")).withColumn("masked", F.replace("text", F.lit("w7"), F.lit("PersonName")))
    rows = rows.cache()
    rows.count()

    def seconds(expression):
        took = []
        for _ in range(4):
            start = time.perf_counter()
            rows.select(expression).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - start)
        return min(took)

    spacing = seconds(tokens.space_specials(F.col("text"), F.col("masked")))
    script = seconds(F.size(tokens.edit_script(F.col("text"), F.col("masked"))))
    rows.unpersist()
    assert script < 6 * spacing


def test_prefix_sums_of_any_length(spark):
    for n in (0, 1, 8, 9, 64, 65, 4097):
        numbers = F.array_repeat(F.lit(3), F.lit(n))
        assert spark.range(1).select(spans.prefix_sums(numbers).alias("x")).first()["x"] == [3 * i for i in range(n)]
    unknown = F.array(F.lit(5), F.lit(None).cast("int"), F.lit(1))
    assert spark.range(1).select(spans.prefix_sums(unknown).alias("x")).first()["x"] == [0, 5, None]


def test_no_script_without_alignment(spark):
    every = "".join(chr(c) for c in range(0xFDD0, 0xFDF0))
    for text, masked in [("a b", "a"), (every, every), (None, "a"), ("a", None)]:
        assert one(spark, tokens.edit_script(F.col("t"), F.col("m")), t=text, m=masked) is None


def test_label_spans_of_tokens(spark):
    def spans(text, masked, iob):
        script = tokens.edit_script(F.col("t"), F.col("m"))
        found = one(spark, tokens.label_spans(script, F.col("l")), t=text, m=masked, l=iob)
        return found and [(r["start"], r["end"], r["tag"]) for r in found]

    text, masked = "At\tAnn  Lee, Bo", "At\tPersonName  PersonName, PersonName"
    assert spans(text, masked, "O B-PersonName I-PersonName B-PersonName") == [(3, 11, "PersonName"), (13, 15, "PersonName")]
    assert spans(text, masked, "O O O O") == []
    assert spans(text, masked, "O O O") is None
    assert spans("", "", "") == []


def test_classes_agree_with_their_ranges(spark):
    """For every character: listing the ASCII ones and testing the others behind a range changes nothing."""
    from notemask.functions import chars, marks

    wide, word = chars.WIDE_SPACES, chars.WORD_CHARS
    solid = rf"[[\x00-\x08\x0e-\x1b!-\x7f][\x{{80}}-\x{{10ffff}}&&[^{wide}]]]"
    special = rf"[[\x00-\x08\x0e-\x1b!-&(-/:-@\[-^`{{-\x7f][\x{{80}}-\x{{10ffff}}&&[^{wide}\p{{L}}\p{{N}}]]]"
    pairs = [
        (chars.WORD, r"[[0-9A-Za-z_][\p{L}\p{N}]]"), (chars.NOT_WORD, f"[^{word}]"), (chars.SOLID, solid),
        (chars.SPECIAL, special), (labels.OTHER_SPACE, rf"[\t-\r\x{{1c}}-\x{{1f}}{wide}]"),
    ] + [
        (marks.mark_class(bits), "[" + "".join(chr(c) for c in range(0xFDD1, 0xFDF0) if (c - 0xFDD0) & bits) + "]")
        for bits in range(1, 32)
    ]
    codes = spark.range(0x110000).filter("id not between 55296 and 57343")
    c = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    differ = [F.count_if(F.col("c").rlike(f"^{a}\\z") != F.col("c").rlike(f"^{b}\\z")) for a, b in pairs]
    assert set(codes.select(c.alias("c")).filter("length(c) = 1").agg(F.count("*"), *differ).first()[1:]) == {0}


def test_size_check_counts_tokens_once(spark):
    rows = spark.range(1).select(F.lit("a  b").alias("a"), F.col("id").cast("string").alias("b"))
    plan = rows.select(labels.size_check(F.col("a"), F.col("b")).alias("n"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_count(") == 2  # four before


def test_marks_fail_plain_characters_in_one_test():
    from notemask.functions.marks import MARK, mark_class

    assert all(mark_class(bits).startswith(f"[{MARK}&&") for bits in range(1, 32))


def test_labels_do_not_need_spaced_tokens(spark):
    texts = [
        *ODD_TEXTS, "PersonName.PAddress", ".PersonName's ,Veteran's 'PAddress''x", "PersonNames xPersonName PersonName_1 (PersonName)",
        "ab'[cd", "it's,ok ab'cdef x',", "PersonName  a  .. [PAddress]\tb", "a\x0bPersonName.b", " ", "'", "PAddressPAddress O",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    per_token = F.regexp_replace(labels._per_label(tokens.clean_masked(F.col("t")), " O "), "$", "")
    got = rows.select("t", labels.iob_raw(tokens.drop_separators(F.col("t"))).alias("n"), per_token.alias("o")).collect()
    assert [(r["t"], r["n"]) for r in got] == [(r["t"], r["o"]) for r in got]


def test_outside_labels_are_never_marked_as_repeats(spark):
    bio = lambda t: text_of(spark, labels.bio_labels, t)
    assert bio("O O PAddress PAddress O O OO OO O") == "O O B-PAddress I-PAddress O O B-OO I-OO O"
    assert bio("O ﷐O X") == "O O B-X"


def test_only_blanks_beside_others_collapse(spark):
    spaced = lambda t, m: one(spark, tokens.space_specials(F.col("t"), F.col("m")), t=t, m=m)
    assert spaced(" a,b  (Klein) c.  Klein's!", " a,b  (PersonName) c.  PersonName's!") == " a , b ( Klein ) c . Klein's ! "
    assert spaced("Ann-Lee a", "PersonName a") == "Ann-Lee a"


def test_streets_end_at_most_24_characters_behind_their_start(spark):
    found = lambda t: one(spark, F.array_join(address.street_spans(F.col("t")), "|"), t=t)
    assert found("12345 Ab1234567890123456 Rd x") == ""
    assert found("12345 AAbcdefghijklmnopSt x") == found("12345 AAbcdefghijklmnopSt")
    assert found("at 5 Oak St, 77 Long Meadow Brook Road. 9 stones") == "5 Oak St,|77 Long Meadow Brook Road."


def test_tokens_that_are_the_tag_stay(spark):
    widen = lambda t: text_of(spark, lambda x: address.widen_tags(x, "PAddress"), t)
    assert widen("(PAddress), PAddress-x xPAddress PAddressPAddress PAddress. a") == "(PAddress), PAddress-PAddress PAddress PAddress PAddress. a"


def put_back_one_by_one(text, places):
    for start, character in places:
        text = text[:start] + character + text[start:]
    return text


def restored_of(spark, text, places):
    rows = spark.createDataFrame([(text, places)], "t string, at array<struct<start:int,character:string>>")
    return rows.select(tokens.restore_specials(F.col("t"), F.col("at")).alias("x")).first()["x"]


def test_restore_specials_agrees_with_putting_back_one_by_one(spark):
    ordered = [(3 * i + i % 2, ", "[: 1 + i % 2]) for i in range(200)]
    for text, places in [
        ("a\u00e9\U0001f600b" * 120, ordered),
        ("ends too early", ordered),
        ("", [(0, ","), (1, "["), (9, "]")]),
        ("abc", []),
        ("abcdef", [(4, "]"), (0, "["), (2, ",")]),  # not in order
        ("abcdef", [(1, "\t\t\t"), (2, ",")]),  # within what was put back
    ]:
        assert restored_of(spark, text, places) == put_back_one_by_one(text, places)
    assert restored_of(spark, None, ordered) is None
    assert restored_of(spark, "abc", None) is None
    assert restored_of(spark, "abc", [(1, None)]) is None


def test_restore_specials_of_a_long_text_takes_no_square(spark):
    text = "[word], " * 60000
    start = time.perf_counter()
    assert text_of(spark, lambda t: tokens.restore_specials(tokens.clean_text(t), tokens.special_locations(t)), text)
    assert time.perf_counter() - start < 20


def test_titled_words_are_masked_as_whole_words_in_any_case(spark):
    text = "Dr Kim saw Kim\ufdd1, kIM and \u212aim; Kimble, xKim, Kim_ and \u212bim stay. Mrs PersonName"
    expected = "Dr PersonName saw PersonName, PersonName and PersonName; Kimble, xKim, Kim_ and \u212bim stay. Mrs PersonName"
    assert text_of(spark, names.mask_titled, text) == expected
    assert text_of(spark, names.mask_titled, "Mr PersonName and Mr PAddress") == "Mr PersonName and Mr PAddress"


def test_titled_words_of_a_long_text_are_masked_in_one_pass(spark):
    """No regular expression of its own for each word."""
    plan = spark.range(1).select(names.mask_titled(F.col("id").cast("string")))._jdf.queryExecution().analyzed().toString()
    assert "array_contains" not in plan and "zip_with" not in plan


def test_marks_are_written_behind_their_words(spark):
    rows = spark.createDataFrame(
        [(t, m, []) for t, m in [
            (" a, b. ", [(1, 2)]), ("a b", [(1, 1)]), ("a b", [(0, 4), (1, 1)]), ("\u00e9\U0001f600x y\n", [(2, 8)]), ("a", None),
        ]],
        "t string, m array<struct<pos:int,bits:int>>, p array<struct<key:string,n:int,bits:int>>",
    )
    written = [r["x"] for r in rows.coalesce(1).select(marks.write_marks(F.col("t"), F.col("m"), F.col("p")).alias("x")).collect()]
    assert written == [" a, b\ufdd2. ", "a b\ufdd1", "a\ufdd4 b\ufdd1", "\u00e9\U0001f600x y\ufdd8\n", "a"]


def test_plain_tests_miss_nothing(spark):
    numbers = ["123-45-6789", "123456789", "x 123-45-67890", "é123456789", "1234567890", "12-345-6789", "", None]
    for text in numbers:
        plain = F.regexp_extract_all("t", F.lit(f"{patterns.SSN_DASHED_PATTERN}|{patterns.SSN_PLAIN_PATTERN}"), F.lit(0))
        assert one(spark, patterns.extract_ssn(F.col("t")).eqNullSafe(plain), t=text), text
        assert one(spark, F.coalesce(F.col("t").rlike(patterns.PERHAPS_SSN) | (F.size(plain) < 1), F.lit(True)), t=text), text
    roles = ["Nurse, Ann", "nurse ,\tAnn", "Nurse,Ann", "Nurse  , Ann", "3, Ann", "Nurse, ann", ", Ann", "a,\nB", "é, Ann"]
    for text in roles:
        assert one(spark, F.col("t").rlike(names.BEHIND_ROLE) == F.col("t").rlike(r"[A-Za-z]\s?,\s[A-Z]"), t=text), text


def test_upper_case_class(spark):
    rows = spark.range(1, 0x20000).filter("id not between 55296 and 57343").select(F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')").alias("c"))
    assert rows.filter(F.col("c").rlike(f"^{chars.UPPER}$") != F.col("c").rlike(r"^\p{Lu}$")).count() == 0


def test_labels_of_other_alphabets(spark):
    bio = lambda t: text_of(spark, labels.bio_labels, t)
    assert bio("O O Other Other O OO O") == "O O B-Other I-Other O B-OO O"
    assert bio("O") == "O" and bio("") == "" and bio("A O O A A") == "B-A O O B-A I-A"
    clean = lambda t: text_of(spark, tokens.clean_text, t)
    for text in (",a [b]\t\r\n c  d ,", "a b", " , ", "", "a, b,c  ,  d"):
        assert clean(text) == " ".join(p for p in re.split(r"[\r,\n\t\[\] ]+", text) if p)
