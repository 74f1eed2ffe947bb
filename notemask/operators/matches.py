"""Looking words up: candidate phrases of a text joined with the lexicon.

The position of a word is its index among the runs of word characters of the text. Only matches
are shuffled, never the words or the texts; the lexicon is broadcast when its measured size allows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notemask.functions.chars import SPACE_CHARS, WHOLE
from notemask.functions.spans import gaps, let, matches
from notemask.operators.gazetteers import (
    ANY_NAME,
    CITY,
    HEAD_BITS,
    MULTI_CITY,
    NAME,
    STATE,
    ZIP,
    Lexicon,
    head_bucket,
    key_words,
    perhaps_known,
)

# Marks a word may carry after the lookups.
NAME_MARK, CITY_MARK, PAIR_MARK, MULTI_MARK, STATE_MARK = 1, 2, 4, 8, 16
ZIP_MARK = NAME_MARK  # on a run of five digits only, and erased before any name step (erase_zip_marks)
NO_MARK_ROWS = "array<struct<pos:int,bits:int>>"

ONE_SPACE = rf"^[{SPACE_CHARS}]\z"
BLANK_GAPS = [" ", ". "]  # gaps that are a blank in a key
INNER_GAPS = ["-", "'", "."]  # those that vanish in a key: its words run together there


def gap_key(gap: Column) -> Column:
    """How a gap inside a phrase enters the key; null if the phrase cannot run across it."""
    return F.when(gap.isin(BLANK_GAPS), " ").when(gap.isin(INNER_GAPS), "")


def one_space(gap: Column) -> Column:
    """Whether a gap is one white-space character; the regex only runs where it is no blank."""
    return (gap == " ") | gap.rlike(ONE_SPACE)


# Strings compare by their UTF-8 bytes: one from "a" up to "{" starts with a small ASCII letter. ``ascii`` would make a
# string for each word.
def starts_ascii(word: Column) -> Column:
    """Whether a run of word characters starts with an ASCII letter."""
    return ((word >= "a") & (word < "{")) | ((word >= "A") & (word < "["))


def has_letter(word: Column) -> Column:
    """Whether a run of word characters has a letter; the regex only runs where it must."""
    return starts_ascii(word) | word.rlike(r"\p{L}")


def from_letter(word: Column) -> Column:
    """A run of word characters from its first letter on."""
    return F.when(starts_ascii(word), word).otherwise(F.regexp_replace(word, r"^[^\p{L}]+", ""))


def starts_upper(word: Column) -> Column:
    return ((word >= "A") & (word < "[")) | ((word >= "\x80") & word.rlike(r"^\p{Lu}"))


def head_bits(heads: bytes, key: Column) -> Column:
    """The first-word index at a key."""
    return F.ascii(F.substring(F.lit(heads), head_bucket(key) + 1, F.lit(1)).cast("string"))


def may_be_known(bits: Column, key: Column) -> Column:
    """Whether some key has this many words and, as far as the index tells (``bits``, see ``head_bits``), this first word."""
    last = F.least(F.lit(HEAD_BITS), key_words(key))
    return F.call_function("shiftleft", F.lit(1), last - 1).bitwiseAND(bits) != 0


def candidates(text: Column, lexicon: Lexicon) -> Column:
    """Phrases that may be in the lexicon, with their neighbours.

    A phrase starts at a capitalised word (or one that touches a hyphen). The first-word index says
    which numbers of words the keys have that begin like it; only such phrases are built, so a long key
    costs nothing where its first word does not stand. ``previous`` and ``next`` are the nearest runs with
    letters on either side, ``beyond`` and ``beyond_two`` the words behind ``next``, each behind a blank; ``after``
    is the word directly behind the phrase and one white-space character. All are as written: what a lookup
    needs of them is made from them behind the join, for those matches that need it.
    """
    heads, max_words = lexicon.heads, lexicon.max_words

    def build(words: Column, around: Column, hyphens: Column) -> Column:
        # numbers alone: an array of structs would copy every word
        lettered = F.filter(F.transform(words, lambda w, i: F.when(has_letter(w), i)), lambda i: i.isNotNull())

        def phrases(runs: Column) -> Column:
            def all_from(i: Column, k: Column, first: Column, inner: Column, bits: Column) -> Column:
                """The phrases from a word on (``first`` in lower case); ``inner`` if it runs together with the next one."""
                following = F.get(runs, k + 1)

                def behind_blank(n: int) -> Column:
                    """The n-th word behind the following one, if a blank parts it from the word before."""
                    return F.when(F.get(around, following + n) == " ", F.get(words, following + n))

                def phrase(key: Column, n: Column) -> Column:
                    behind = one_space(F.get(around, i + n))
                    return F.struct(
                        i.alias("pos"),
                        n.alias("n"),
                        key.alias("key"),
                        F.get(words, F.get(runs, k - 1)).alias("previous"),
                        F.get(words, following).alias("next"),
                        F.when(n == 1, behind_blank(1)).alias("beyond"),
                        F.when(n == 1, behind_blank(2)).alias("beyond_two"),
                        following.alias("following_pos"),
                        F.when(behind, F.get(words, i + n)).alias("after"),
                    )

                def longer(most: Column) -> Column:
                    """The keys of 1 to ``most`` words; null from the first gap on that no phrase crosses."""
                    grown = lambda acc, n: F.concat(
                        F.get(acc, n - 2), gap_key(F.get(around, i + n - 1)), F.lower(F.get(words, i + n - 1))
                    )
                    return F.aggregate(
                        F.sequence(F.lit(2), most),
                        F.array(first),
                        lambda acc, n: F.concat(acc, F.array(grown(acc, n))),
                    )

                # words that run together make a phrase longer than its key
                together = F.size(F.filter(F.slice(around, i + 3, F.lit(max_words)), lambda g: g.isin(INNER_GAPS)))
                words_of_key = F.lit(max_words)
                for n in range(HEAD_BITS - 1, 0, -1):
                    words_of_key = F.when(bits < 1 << n, n).otherwise(words_of_key) if n < max_words else words_of_key
                most = F.when(inner, F.lit(max_words)).otherwise(F.least(F.lit(max_words), words_of_key + together))
                one = F.array(phrase(first, F.lit(1)))

                def perhaps(key: Column, n: Column) -> Column:
                    # only a word that runs together with the next one begins longer keys by other first words
                    known = may_be_known(F.when(inner, head_bits(heads, key)).otherwise(bits), key)
                    return F.when(key.isNotNull() & known, phrase(key, n + 1))

                several = F.filter(F.transform(longer(most), perhaps), lambda p: p.isNotNull())
                if max_words == 1:
                    return one
                return F.when(~inner & (bits == 1), one).otherwise(several)

            def start(i: Column, k: Column) -> Column:
                word = F.get(words, i)
                hyphened = hyphens & (F.get(around, i).endswith("-") | F.get(around, i + 1).startswith("-"))
                inner = F.coalesce(F.get(around, i + 1).isin(INNER_GAPS), F.lit(False))

                def known_from(first: Column) -> Column:
                    bits = F.when(inner, F.lit((1 << HEAD_BITS) - 1)).otherwise(head_bits(heads, first))
                    return let(bits, lambda b: F.when(b != 0, all_from(i, k, first, inner, b)))

                return F.when(starts_upper(word) | hyphened, let(F.lower(word), known_from))

            return F.flatten(F.filter(F.transform(runs, start), lambda a: a.isNotNull()))

        def code(w: Column, i: Column) -> Column:
            phrase = F.struct(
                i.alias("pos"),
                F.lit(1).alias("n"),
                w.alias("key"),
                *[
                    F.lit(None).cast("string").alias(c)
                    for c in ("previous", "next", "beyond", "beyond_two")
                ],
                F.lit(None).cast("int").alias("following_pos"),
                F.lit(None).cast("string").alias("after"),
            )
            return F.when((w < ":") & w.rlike("^[0-9]{5}$"), phrase)

        coded = F.when(text.rlike("[0-9]{5}"), words).otherwise(F.array().cast("array<string>"))
        codes = F.filter(F.transform(coded, code), lambda p: p.isNotNull())
        return F.concat(let(lettered, phrases), codes)

    return let(
        text.contains("-"),
        lambda h: let(matches(text, WHOLE), lambda words: let(gaps(text, WHOLE), lambda g: build(words, g, h))),
    )


def phrase_matches(
    notes: DataFrame, lexicon: Lexicon, id_cols: list[str], text_col: str = "text"
) -> DataFrame:
    """Every phrase of the notes that the lexicon knows, with the context that decides on it.

    ``beside_name``: a city behind a name or an initial; a phrase in front of a name.
    ``with_state``: a city whose next words are one of its states; ``state_words`` says how many.
    """
    phrases = notes.select(
        *id_cols, F.explode(candidates(F.col(text_col), lexicon)).alias("p")
    ).select(*id_cols, "p.*")
    if not lexicon.broadcasts:
        phrases = perhaps_known(phrases, lexicon)
    known = phrases.join(lexicon.for_join(), "key")
    is_city = (F.col("flags").bitwiseAND(CITY) != 0) & (F.col("n") == 1)
    is_place = F.col("flags").bitwiseAND(MULTI_CITY + STATE) != 0
    context = F.when(is_city, F.lower("previous")).when(is_place, F.lower("after"))
    named = lexicon.for_join().select(
        F.col("key").alias("context"), F.col("flags").alias("context_flags")
    )
    initial = is_city & F.coalesce(F.col("previous").rlike(r"^\p{Lu}$"), F.lit(False))
    beside = F.coalesce(F.col("context_flags").bitwiseAND(ANY_NAME) != 0, F.lit(False))
    following = F.lower(from_letter(F.col("next")))
    two = F.concat(following, F.lit(" "), F.lower("beyond"))
    three = F.concat(two, F.lit(" "), F.lower("beyond_two"))
    listed = lambda words: F.coalesce(F.array_contains("states", words), F.lit(False))
    state_words = F.when(
        is_city & F.col("states").isNotNull(),
        F.when(listed(three), 3).when(listed(two), 2).when(listed(following), 1),
    )
    # matches without a context find nothing; keys of their own keep them from meeting in one place
    nothing = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(*id_cols, "pos"), F.lit(4096)).cast("string"))
    return (
        known.withColumn("context", F.coalesce(context, nothing))
        .join(named, "context", "left")
        .select(
            *id_cols,
            "pos",
            "n",
            "key",
            "flags",
            (initial | beside).alias("beside_name"),
            state_words.isNotNull().alias("with_state"),
            F.coalesce(state_words, F.lit(0)).alias("state_words"),
            following.alias("following"),
            "following_pos",
        )
    )


def word_marks(found: DataFrame, id_cols: list[str]) -> DataFrame:
    """Per note, from its phrase matches: one array of (pos, bits), and the places that it names.

    A place (a city of several words or a state, as key, number of words and bits) is masked wherever
    it stands in the note, in any case (see ``repeated_places``).
    """

    def has(flag: int) -> Column:
        return F.col("flags").bitwiseAND(flag) != 0

    def bit(condition: Column, mark: int) -> Column:
        return F.when(condition, mark).otherwise(0)

    free = ~F.col("beside_name")
    whole = (
        bit(has(NAME), NAME_MARK)
        .bitwiseOR(bit(has(ZIP), ZIP_MARK))
        .bitwiseOR(bit(has(CITY) & (F.col("n") == 1) & free, CITY_MARK))
        .bitwiseOR(bit(has(MULTI_CITY) & free, MULTI_MARK))
        .bitwiseOR(bit(has(STATE) & free, STATE_MARK))
        .bitwiseOR(bit(F.col("with_state"), PAIR_MARK))
    )
    over_phrase = F.transform(
        F.sequence(F.col("pos"), F.col("pos") + F.col("n") - 1),
        lambda p: F.struct(p.alias("pos"), whole.alias("bits")),
    )
    state = F.transform(
        F.sequence(F.col("following_pos"), F.col("following_pos") + F.col("state_words") - 1),
        lambda p: F.struct(p.alias("pos"), F.lit(PAIR_MARK).alias("bits")),
    )
    state = F.when(F.col("with_state"), state).otherwise(F.array().cast(NO_MARK_ROWS))
    place_bits = whole.bitwiseAND(MULTI_MARK | STATE_MARK)
    place = F.when(place_bits != 0, F.struct("key", "n", place_bits.alias("bits")))
    marks = (
        found.select(*id_cols, place.alias("place"), F.explode(F.concat(over_phrase, state)).alias("m"))
        .select(*id_cols, "place", "m.*")
        .filter("bits <> 0")
    )
    return (
        marks.groupBy(*id_cols, "pos")
        .agg(F.bit_or("bits").alias("bits"), F.collect_set("place").alias("places"))
        .groupBy(*id_cols)
        .agg(
            F.sort_array(F.collect_list(F.struct("pos", "bits"))).alias("marks"),
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        )
    )


def repeated_places(words: Column, around: Column, bits: Column, places: Column, mark: int) -> Column:
    """Positions of words of a note's places that start in lower case, so that no lookup saw them.

    ``words``, ``around`` and ``bits`` are the runs of the note, the gaps around them and their marks.
    An occurrence in front of a word that is marked as a name is none.
    """
    low = F.transform(words, lambda w: F.lower(w))

    def of_place(lower_words: Column, place: Column) -> Column:
        def agrees(i: Column) -> Column:
            tail = F.transform(
                F.sequence(F.lit(1), F.greatest(place["n"] - 1, F.lit(1))),
                lambda j: F.when(
                    j < place["n"],
                    F.concat(gap_key(F.get(around, i + j)), F.get(lower_words, i + j)),
                ).otherwise(""),
            )
            # a gap that a phrase cannot run across makes the whole null
            whole = F.aggregate(tail, F.get(lower_words, i), lambda acc, t: F.concat(acc, t))
            return F.coalesce(whole == place["key"], F.lit(False))

        def starts(i: Column) -> Column:
            hyphened = F.get(around, i).endswith("-") | F.get(around, i + 1).startswith("-")
            marked = F.coalesce(F.get(bits, i + place["n"]), F.lit(0)).bitwiseAND(NAME_MARK) != 0
            code = F.get(words, i + place["n"]).rlike("^[0-9]")  # a ZIP code has the same mark
            named = one_space(F.get(around, i + place["n"])) & marked & ~code
            begins = F.startswith(place["key"], F.get(lower_words, i))
            seen = starts_upper(F.get(words, i)) | hyphened
            return begins & ~seen & agrees(i) & ~F.coalesce(named, F.lit(False))

        last = F.size(words) - place["n"]
        at = F.when(last >= 0, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), starts))
        at = F.coalesce(at, F.array().cast("array<int>"))
        return F.flatten(F.transform(at, lambda i: F.sequence(i, i + place["n"] - 1)))

    mine = F.filter(places, lambda p: p["bits"].bitwiseAND(mark) != 0)
    found = let(low, lambda lower_words: F.flatten(F.transform(mine, lambda p: of_place(lower_words, p))))
    return F.array_sort(F.array_distinct(found))


def dense_bits(marks: Column, n_words: Column) -> Column:
    """Spread sorted (pos, bits) pairs over one int per word."""
    zeros = lambda count: F.array_repeat(F.lit(0), count.cast("int"))

    def spread(ms: Column) -> Column:
        before = lambda k: F.coalesce(F.get(ms, k - 1)["pos"], F.lit(-1))
        filled = F.transform(
            ms, lambda m, k: F.concat(zeros(m["pos"] - before(k) - 1), F.array(m["bits"]))
        )
        last = F.coalesce(F.get(ms, F.size(ms) - 1)["pos"], F.lit(-1))
        return F.flatten(F.concat(filled, F.array(zeros(n_words - last - 1))))

    return let(marks, spread)


def attach_marks(
    notes: DataFrame,
    lexicon: Lexicon,
    id_cols: list[str],
    text_col: str = "text",
    prepare: Callable[[Column], Column] = lambda text: text,
) -> DataFrame:
    """Notes with ``prepared`` (``prepare(text)`` where it differs from the text, else null) and the
    ``marks`` and ``places`` arrays (null if nothing matched) for it.

    Notes and matches meet on the ids and a hash of the text, so repeated ids cannot mix texts.
    The notes are shuffled once, by that key: explode, broadcast lookup, both groupings and the join
    back all keep the partitioning, so the exchange is reused and no other one is needed. ``prepare`` runs
    behind that shuffle, on both sides of the join: the scan has as many tasks as the files have row groups,
    which may be few. The matches are the hashed side of the join: a few integers per matched word, and no sort of texts.
    """
    keys = [*id_cols, "text_hash"]
    changed = let(prepare(F.col(text_col)), lambda p: F.when(p != F.col(text_col), p))
    parts = int(notes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = notes.withColumn("text_hash", F.xxhash64(text_col)).repartition(parts, *keys).withColumn("prepared", changed)
    prepared = keyed.select(*keys, F.coalesce("prepared", text_col).alias(text_col))
    marks = word_marks(phrase_matches(prepared, lexicon, keys, text_col), keys)
    return keyed.join(marks.hint("shuffle_hash"), keys, "left").drop("text_hash")
