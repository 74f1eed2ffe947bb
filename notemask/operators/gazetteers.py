"""Lookup tables: names, states, ZIP codes, cities and counties, and one lexicon over all of them.

All keys have one normal form (``match_key``): lower case, punctuation dropped. The texts are
brought into the same form before they are joined.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notemask.constants import (
    NON_CITY_PHRASES,
    NON_CITY_WORDS,
    NOT_A_CITY_CODE,
    STATE_ABBREVIATIONS,
    US_TERRITORIES,
)
from notemask.functions.chars import RUN, SPACE_CHARS, WORD_CHARS
from notemask.functions.spans import rewrite_spans

# Lexicon flags.
NAME, CITY, MULTI_CITY, STATE, ZIP, ANY_NAME = 1, 2, 4, 8, 16, 32

BROADCAST_LIMIT = 128 * 1024 * 1024
# The first-word index has one byte for each bucket of first words, however large the lexicon is; bit t - 1
# says that some key that begins with such a word has t words, the last bit that many or more.
HEAD_BUCKETS, HEAD_BITS = 1 << 16, 7
# Bitmaps of the hashes of all keys, and bits of each as Spark builds them: 16 MB in all.
BITMAPS, BITMAP_BITS = 1 << 12, 1 << 15
ROW_OVERHEAD = 64


def literal_rows(spark: SparkSession, columns: list[str], values: list[tuple]) -> DataFrame:
    """A short list of string rows as part of the plan (one partition, no Python workers)."""
    rows = ", ".join(f"({', '.join(map(sql_text, row))})" for row in values)
    typed = ", ".join(f"CAST(col{i + 1} AS STRING) AS `{c}`" for i, c in enumerate(columns))
    return spark.sql(f"SELECT {typed} FROM VALUES {rows}")


def sql_text(value: str | None) -> str:
    """A string as a SQL literal."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def match_key(text: Column) -> Column:
    """Lower case, without punctuation and outer white space."""
    kept = F.regexp_replace(F.lower(text), f"[^{SPACE_CHARS}{WORD_CHARS}]", "")
    return F.trim(F.regexp_replace(kept, f"[{SPACE_CHARS}]+", " "))


def title_case(text: Column) -> Column:
    """Every run of letters starts upper case and goes on lower case."""
    return rewrite_spans(
        F.lower(text),
        r"\p{L}+",
        lambda m: F.concat(F.upper(F.left(m, F.lit(1))), F.right(m, F.length(m) - 1)),
    )


def word_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)))


def name_gazetteer(raw_names: DataFrame) -> DataFrame:
    """Distinct names without nulls; one display form per key."""
    written = raw_names.select(F.trim("name").alias("name")).distinct()
    named = written.select("name", match_key(F.col("name")).alias("key"))
    return (
        named.filter("key <> ''")
        .select(title_case(F.col("name")).alias("name"), "key")
        .groupBy("key")
        .agg(F.min("name").alias("name"))
        .select("name", "key")
    )


def state_gazetteer(raw_states: DataFrame) -> DataFrame:
    """Distinct states and territories; abbreviations keep their case, full names get title case."""
    spark = raw_states.sparkSession
    territories = literal_rows(spark, ["state"], [(t,) for t in US_TERRITORIES])
    states = raw_states.select("state").distinct().unionByName(territories)
    states = states.filter("trim(state) <> ''")
    full = F.length("state") > 2
    return states.select(
        F.when(full, title_case(F.col("state"))).otherwise(F.col("state")).alias("state"),
        match_key(F.col("state")).alias("key"),
        (~full).alias("is_abbrev"),
    ).distinct()


def zip_gazetteer(raw_zips: DataFrame) -> DataFrame:
    return raw_zips.select(F.col("ZIP").alias("zipcode")).filter("zipcode is not null").distinct()


def all_cities(raw_cities: DataFrame, raw_extra: DataFrame, states: DataFrame) -> DataFrame:
    """US cities of both files: no state names, and from the second file only unknown cities."""
    us = F.col("State_code").isin(STATE_ABBREVIATIONS)
    state_names = states.select(F.col("state").alias("City")).distinct()
    first = raw_cities.filter(us & (F.col("City") != NOT_A_CITY_CODE)).join(
        state_names, "City", "left_anti"
    )
    extra = (
        raw_extra.filter(us & F.col("City").isNotNull())
        .select("City", "State_code", "State_full")
        .join(state_names, "City", "left_anti")
        .join(first.select("City"), "City", "left_anti")
    )
    return extra.unionByName(first, allowMissingColumns=True).distinct()


def place_states(places: DataFrame, column: str) -> DataFrame:
    """Each place with its distinct (state_full, state_code) pairs."""
    pair = F.struct(F.col("State_full").alias("state_full"), F.col("State_code").alias("state_code"))
    return (
        places.select(column, "State_code", "State_full")
        .na.drop()
        .groupBy(F.col(column).alias(column.lower()))
        .agg(F.array_sort(F.collect_set(pair)).alias("states"))
    )


def city_state_tokens(city_states: DataFrame) -> DataFrame:
    """One row per city key and state word (full name or code) that may follow it."""
    pairs = city_states.select(match_key(F.col("city")).alias("key"), F.explode("states").alias("s"))
    tokens = pairs.select(
        "key", F.explode(F.array("s.state_full", "s.state_code")).alias("token")
    ).select("key", match_key(F.col("token")).alias("state_token"))
    return tokens.filter("key <> '' and state_token <> ''").distinct()


def excluded_keys(spark: SparkSession) -> DataFrame:
    """The fixed list of everyday words that are neither names nor cities."""
    words = literal_rows(spark, ["word"], [(w,) for w in NON_CITY_WORDS])
    return words.select(match_key(F.col("word")).alias("key")).distinct()


def multi_word(city: Column) -> Column:
    """Cities looked up as phrases: hyphenated, or several words and not on the exception list."""
    several = (F.size(F.split(city, " ", -1)) > 1) & (F.length(city) > 3)
    allowed = ~city.contains("Mc") & ~city.contains("State ") & ~city.isin(NON_CITY_PHRASES)
    return city.contains("-") | (several & allowed)


@dataclass
class Gazetteers:
    """The lookup tables as DataFrames."""

    names: DataFrame
    states: DataFrame
    zips: DataFrame
    city_states: DataFrame
    county_states: DataFrame

    def lexicon_rows(self) -> DataFrame:
        """One row per key: what it is (flags), its words, and the states of a city."""
        no_states = F.lit(None).cast("array<string>").alias("states")
        excluded = F.broadcast(excluded_keys(self.names.sparkSession))  # a fixed short list
        names = self.names.join(excluded.withColumn("no", F.lit(1)), "key", "left").select(
            "key",
            F.when(F.col("no").isNull(), NAME + ANY_NAME).otherwise(ANY_NAME).alias("flags"),
            word_count(F.col("name")).alias("n_words"),
            no_states,
        )
        states = self.states.filter("not is_abbrev").select(
            "key", F.lit(STATE).alias("flags"), word_count(F.col("state")).alias("n_words"), no_states
        )
        zips = self.zips.select(
            F.col("zipcode").alias("key"), F.lit(ZIP).alias("flags"), F.lit(1).alias("n_words"), no_states
        )
        tokens = F.flatten(
            F.transform(
                "states", lambda s: F.array(match_key(s["state_full"]), match_key(s["state_code"]))
            )
        )
        cities = (
            self.city_states.select(
                "city", match_key(F.col("city")).alias("key"), tokens.alias("states")
            )
            .join(excluded, "key", "left_anti")
            .select(
                "key",
                F.when(multi_word(F.col("city")), MULTI_CITY)
                .when(word_count(F.col("city")) == 1, CITY)
                .otherwise(0)
                .alias("flags"),
                word_count(F.col("city")).alias("n_words"),
                "states",
            )
        )
        rows = names.unionByName(states).unionByName(zips).unionByName(cities)
        return (
            rows.filter("key <> ''")
            .groupBy("key")
            .agg(
                F.bit_or("flags").alias("flags"),
                F.max("n_words").alias("n_words"),
                F.array_distinct(F.flatten(F.collect_list("states"))).alias("states"),
            )
            .filter("flags <> 0")
        )

    def lexicon(self, broadcast_limit: int = BROADCAST_LIMIT) -> Lexicon:
        """The lexicon, written once to the checkpoint folder and measured there."""
        ensure_checkpoint_dir(self.names.sparkSession)
        rows = self.lexicon_rows().checkpoint()
        state_bytes = F.coalesce(F.length(F.array_join("states", ",")), F.lit(0)) + 8 * F.greatest(
            F.size("states"), F.lit(0)
        )
        measured = rows.agg(
            F.coalesce(F.sum(F.octet_length("key") + state_bytes + ROW_OVERHEAD), F.lit(0)),
            F.coalesce(F.max("n_words"), F.lit(1)),
        ).first()
        return Lexicon(rows, measured[0], measured[1], head_index(rows), broadcast_limit)


def key_words(key: Column) -> Column:
    """Words of a key, as blanks separate them."""
    return F.length(key) - F.length(F.replace(key, F.lit(" "))) + 1


def head_bucket(key: Column) -> Column:
    """The bucket of a key's first word."""
    head = F.substring_index(key, " ", 1)
    return F.pmod(F.xxhash64(head), F.lit(HEAD_BUCKETS)).cast("int")


def head_index(rows: DataFrame) -> bytes:
    """For each bucket of first words, the numbers of words that keys have (see HEAD_BITS)."""
    bit = F.expr(f"shiftleft(1, least({HEAD_BITS}, n) - 1)")
    keyed = rows.select(head_bucket(F.col("key")).alias("bucket"), key_words(F.col("key")).alias("n"))
    found = keyed.groupBy("bucket").agg(F.bit_or(bit).alias("bits"))
    index = bytearray(HEAD_BUCKETS)
    for bucket, bits in found.collect():  # one row for each bucket at most
        index[bucket] = bits
    return bytes(index)


@dataclass
class Lexicon:
    """Lexicon rows with their measured size, the longest phrase in words and the first-word index."""

    rows: DataFrame
    n_bytes: int
    max_words: int
    heads: bytes
    broadcast_limit: int = BROADCAST_LIMIT

    @property
    def broadcasts(self) -> bool:
        """Whether the measured size allows a broadcast."""
        return self.n_bytes <= self.broadcast_limit

    def for_join(self) -> DataFrame:
        """Hinted for broadcast only when the measured size allows it; otherwise Spark shuffles."""
        rows = self.rows.select("key", "flags", "states")
        return F.broadcast(rows) if self.broadcasts else rows

    def bitmaps(self) -> DataFrame:
        """One bit per key, at its hash: at most BITMAPS rows (bitmap, bits) of 4 KB each, whatever the lexicon's size."""
        at = bit_at(F.col("key"))
        return self.rows.groupBy(at["bitmap"].alias("bitmap")).agg(F.bitmap_construct_agg(at["bit"]).alias("bits"))


def bit_at(key: Column) -> Column:
    """The bitmap of a key and its bit there."""
    place = F.pmod(F.xxhash64(key), F.lit(BITMAPS * BITMAP_BITS))
    return F.struct(
        F.floor(place / BITMAP_BITS).cast("int").alias("bitmap"), (place % BITMAP_BITS).alias("bit")
    )


def perhaps_known(phrases: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Phrases (with a ``key``) without those whose bit no key of the lexicon has: what is left may still be unknown.

    The bitmaps have a fixed size and are broadcast, so most unknown phrases go before they are shuffled.
    """
    columns = phrases.columns
    placed = phrases.select(F.struct(*columns).alias("phrase"), bit_at(F.col("key")).alias("at"))
    placed = placed.select("phrase", "at.*").join(F.broadcast(lexicon.bitmaps()), "bitmap")
    eight = F.ascii(F.decode(F.substring("bits", (F.col("bit") / 8).cast("int") + 1, F.lit(1)), "ISO-8859-1"))
    is_set = F.call_function("shiftright", eight, (F.col("bit") % 8).cast("int")).bitwiseAND(F.lit(1)) == 1
    return placed.filter(is_set).select("phrase.*")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of the session; only a local session may fall back to its own."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
    elif context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="notemask-"))


def build_gazetteers(
    raw_names: DataFrame,
    raw_states: DataFrame,
    raw_zips: DataFrame,
    raw_cities: DataFrame,
    raw_extra_cities: DataFrame,
) -> Gazetteers:
    """Build all lookup tables from the raw files' columns."""
    states = state_gazetteer(raw_states)
    cities = all_cities(raw_cities, raw_extra_cities, states)
    return Gazetteers(
        names=name_gazetteer(raw_names),
        states=states,
        zips=zip_gazetteer(raw_zips),
        city_states=place_states(cities, "City"),
        county_states=place_states(cities, "County"),
    )
