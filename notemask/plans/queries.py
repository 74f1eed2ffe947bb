"""The registered queries, each with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notemask.constants import ADDRESS_TAG, NAME_TAG, PHONE_PATTERN, PHONE_TAG
from notemask.functions import labels, patterns, spans, tokens
from notemask.functions.marks import erase_marks
from notemask.operators import address, names, quality
from notemask.operators import gazetteers as gz
from notemask.operators.matches import phrase_matches
from notemask.plans import fixtures as fx
from notemask.plans import oracle as o
from notemask.plans.pipeline import (
    annotate_notes,
    counted_labels,
    diffs_of_rejects,
    mark_notes,
    labels_and_rejects,
    mask_addresses,
    masked_streets,
    rejected_notes,
    run_steps,
    shown,
    spans_of_notes,
    tag_notes,
)
from notemask.sources import readers, runs
from notemask.sources.readers import write_labels
from notemask.streaming import notes as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        ORACLE[name] = sql
        return query

    return add


# --- Lookup tables ------------------------------------------------------------------------
@register("name_gazetteer", o.with_chain(o.BASE, "SELECT name, key FROM g_names"))
def _(spark, sf):
    return gz.name_gazetteer(fx.raw_names(spark, sf))


@register("state_gazetteer", o.with_chain(o.BASE, "SELECT state, key, is_abbrev FROM g_states"))
def _(spark, sf):
    return gz.state_gazetteer(fx.raw_states(spark, sf))


@register("zip_gazetteer", o.with_chain(o.BASE, "SELECT zipcode FROM g_zips"))
def _(spark, sf):
    return gz.zip_gazetteer(fx.raw_zips(spark, sf))


@register(
    "city_states", o.with_chain(o.BASE, "SELECT city, state_full, state_code FROM g_city_states")
)
def _(spark, sf):
    return fx.gazetteers(spark, sf).city_states.select("city", F.inline("states"))


@register(
    "county_states",
    o.with_chain(
        o.BASE,
        "SELECT DISTINCT county, state_full, state_code FROM g_cities"
        " WHERE county IS NOT NULL AND state_full IS NOT NULL",
    ),
)
def _(spark, sf):
    return fx.gazetteers(spark, sf).county_states.select("county", F.inline("states"))


@register("city_state_tokens", o.with_chain(o.BASE, "SELECT key, state_token FROM g_tokens"))
def _(spark, sf):
    return gz.city_state_tokens(fx.gazetteers(spark, sf).city_states)


# --- Lookup files ---------------------------------------------------------------------------
def _file_rows(raw: str, layout: readers.FileFormat, wrong: str) -> Query:
    """Writes a raw lookup table as a file of its layout, some of its rows once more with a wrong number of fields, and
    reads the file back: every good row by its columns, every bad line as it stands, with how often each occurs."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        gz.ensure_checkpoint_dir(spark)
        folder = f"{spark.sparkContext.getCheckpointDir()}/lookup-{uuid.uuid4().hex}"
        rows = getattr(fx, raw)(spark, sf).select(*(F.col(f"`{c}`").cast("string") for c in layout.columns)).na.fill("none")
        readers.write_lookup(rows, f"{folder}/file", layout)
        first = F.col(f"`{layout.columns[0]}`")
        broken = rows.filter(F.length(first) % 5 == 0).distinct()
        broken = broken.select(first, F.lit(wrong), *(F.lit("x") for _ in layout.columns[1:])) if len(layout.columns) < 3 else broken.select(first, F.lit(wrong))
        readers.write_lookup(broken.toDF(*(f"c{i}" for i in range(len(broken.columns)))), f"{folder}/file", layout, "append")
        good, seen = readers.load_checked(spark, f"{folder}/file", layout, f"{folder}/bad")
        bad = spark.read.schema(f"file string, {readers.BAD_LINE} string").json(f"{folder}/bad")
        whole = F.concat_ws(layout.delimiter, *(F.col(f"`{c}`") for c in layout.columns))
        lines = good.select(F.lit("good").alias("kind"), whole.alias("line")).unionByName(
            bad.select(F.lit("bad").alias("kind"), F.col(readers.BAD_LINE).alias("line"))
        )
        total = F.when(F.col("kind") == "bad", seen["bad"]).otherwise(seen["lines"] - seen["bad"])
        return lines.groupBy("kind", "line").agg(F.count("*").alias("n")).withColumn("n_of_kind", total.cast("long"))

    return query


def _file_sql(select: str, layout: readers.FileFormat, wrong: str) -> str:
    fields = [f"c{i}" for i in range(len(layout.columns))]
    filled = ", ".join(f"coalesce({c}, 'none') AS {c}" for c in fields)
    broken = ["c0", o.q(wrong), *(["'x'"] * (len(fields) - 1) if len(fields) < 3 else [])]
    mark = o.q(layout.delimiter)
    return o.with_chain(
        [o.NOTES, o.RAW, f"given AS MATERIALIZED (SELECT {filled} FROM ({select}))"],
        f"""SELECT kind, line, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY kind) AS BIGINT) AS n_of_kind FROM (
  SELECT 'good' AS kind, concat_ws({mark}, {', '.join(fields)}) AS line FROM given
  UNION ALL
  SELECT 'bad', concat_ws({mark}, {', '.join(broken)}) FROM (SELECT DISTINCT * FROM given WHERE length(c0) % 5 = 0))
GROUP BY kind, line""",
    )


_CODE_SQL = f"{o.items(o.CODES)}[page_id % {len(o.CODES)} + 1]"
_PART_CODE_SQL = f"{o.items(o.CODES)}[p_partkey % {len(o.CODES)} + 1]"
_FILE_SOURCES = {
    "names": "SELECT name AS c0 FROM raw_names",
    "states": "SELECT state AS c0 FROM raw_states",
    "zips": "SELECT ZIP AS c0 FROM raw_zips",
    "cities": f"""SELECT CASE WHEN page_id % 5 = 0 THEN {o.HOST} || ' Falls' ELSE {o.HOST} END AS c0, {_CODE_SQL} AS c1,
  'State of ' || {_CODE_SQL} AS c2, 'County ' || CAST(page_id % 40 AS VARCHAR) AS c3, {o.HOST} AS c4 FROM pages
  UNION ALL {o.rows(['a', 'b', 'c', 'd', 'e'], fx.SEED_CITIES)}""",
    "extra_cities": f"""SELECT CAST(p_partkey AS VARCHAR) AS c0, {_PART_CODE_SQL} AS c1, 'State of ' || {_PART_CODE_SQL} AS c2,
  {o.title('p_name')} AS c3, NULL AS c4, CAST(p_partkey AS VARCHAR) AS c5, CAST(p_partkey AS VARCHAR) AS c6 FROM part
  UNION ALL {o.rows(['a', 'b', 'c', 'd', 'e', 'f', 'g'], fx.SEED_EXTRA_CITIES)}""",
}
for _name, _source in _FILE_SOURCES.items():
    _layout = readers.FORMATS[_name]
    register(f"{_name}_file", _file_sql(_source, _layout, "extra"))(_file_rows(f"raw_{_name}", _layout, "extra"))


# --- Lookups ------------------------------------------------------------------------------
def found_in_notes(spark: SparkSession, sf: str, **limits: int) -> DataFrame:
    lexicon = dataclasses.replace(fx.lexicon(spark, sf), **limits)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # the scan has as many tasks as the files have row groups, which may be few
    notes = fx.notes(spark, sf).filter("text is not null").repartition(parts, "doc_id")
    prepared = notes.select("doc_id", masked_streets(F.col("text")).alias("text"))
    return phrase_matches(prepared, lexicon, ["doc_id"])


def flagged(flag: int) -> Column:
    return F.col("flags").bitwiseAND(flag) != 0


def per_key(with_beside: bool = False) -> list[Column]:
    beside = [F.count_if("beside_name").alias("n_beside_name")] if with_beside else []
    return [F.count("*").alias("n_matches"), *beside]


MATCH_CHAIN = [*o.BASE, o.LOOKUP]
BESIDE_SQL = "count(*) FILTER (WHERE beside_name) AS n_beside_name"


def match_sql(condition: str, columns: str = "doc_id, key", more: str = "") -> str:
    select = f"SELECT {columns}, count(*) AS n_matches{more} FROM found WHERE {condition} GROUP BY ALL"
    return o.with_chain(MATCH_CHAIN, select)


@register("token_name_matches", match_sql("f_name"))
def _(spark, sf):
    return found_in_notes(spark, sf).filter(flagged(gz.NAME)).groupBy("doc_id", "key").agg(*per_key())


@register("name_matches_by_shuffle", match_sql("f_name"))
def _(spark, sf):
    """The lookup of a lexicon too large for a broadcast: bitmaps of its keys first, then a shuffle of what is left."""
    found = found_in_notes(spark, sf, broadcast_limit=0).filter(flagged(gz.NAME))
    return found.groupBy("doc_id", "key").agg(*per_key())


@register("token_city_matches", match_sql("city", more=f", {BESIDE_SQL}"))
def _(spark, sf):
    cities = found_in_notes(spark, sf).filter(flagged(gz.CITY) & (F.col("n") == 1))
    return cities.groupBy("doc_id", "key").agg(*per_key(with_beside=True))


@register("city_state_matches", match_sql("with_state", "doc_id, key, following AS state_token"))
def _(spark, sf):
    pairs = found_in_notes(spark, sf).filter("with_state")
    return pairs.groupBy("doc_id", "key", F.col("following").alias("state_token")).agg(*per_key())


@register("multiword_city_matches", match_sql("f_multi", more=f", {BESIDE_SQL}"))
def _(spark, sf):
    cities = found_in_notes(spark, sf).filter(flagged(gz.MULTI_CITY))
    return cities.groupBy("doc_id", "key").agg(*per_key(with_beside=True))


@register("state_matches", match_sql("f_state", more=f", {BESIDE_SQL}"))
def _(spark, sf):
    states = found_in_notes(spark, sf).filter(flagged(gz.STATE))
    return states.groupBy("doc_id", "key").agg(*per_key(with_beside=True))


@register("zip_matches", match_sql("f_zip"))
def _(spark, sf):
    return found_in_notes(spark, sf).filter(flagged(gz.ZIP)).groupBy("doc_id", "key").agg(*per_key())


@register(
    "single_city_candidates",
    o.with_chain(MATCH_CHAIN, "SELECT doc_id, CAST(pos AS INT) AS pos, key FROM found WHERE city"),
)
def _(spark, sf):
    cities = found_in_notes(spark, sf).filter(flagged(gz.CITY) & (F.col("n") == 1))
    return cities.select("doc_id", "pos", "key")


# --- Pattern masks and span helpers ---------------------------------------------------------
def on_notes(rewrite: Callable[[Column], Column], name: str = "masked") -> Query:
    return lambda spark, sf: fx.notes(spark, sf).select("doc_id", rewrite(F.col("text")).alias(name))


def on_notes_sql(expression: str, name: str = "masked") -> str:
    return o.with_chain([o.NOTES], f"SELECT doc_id, {expression} AS {name} FROM notes")


for _name, _rewrite, _sql in [
    ("mask_email", patterns.mask_email, o.email("text")),
    ("mask_ssn", patterns.mask_ssn, o.ssn("text")),
    ("mask_phone", patterns.mask_phone, o.phone("text")),
    ("mask_url", patterns.mask_url, o.sub("text", o.URL, o.C.URL_TAG)),
    ("mask_ip", patterns.mask_ip, o.sub("text", o.C.IP_PATTERN, o.C.IP_TAG)),
    ("mask_account", patterns.mask_account, o.sub("text", o.ACCOUNT, o.C.ACCOUNT_TAG)),
]:
    register(_name, on_notes_sql(_sql))(on_notes(_rewrite))


@register("mask_url_pages", f"SELECT page_id, {o.sub('url', o.URL, o.C.URL_TAG)} AS masked FROM pages")
def _(spark, sf):
    return fx.table(spark, sf, "pages").select(
        "page_id", patterns.mask_url(F.col("url")).alias("masked")
    )


_SSN_SQL = f"regexp_extract_all(text, {o.rx(f'{o.C.SSN_DASHED_PATTERN}|{o.SSN_PLAIN}')})"


@register(
    "extract_ssn",
    o.with_chain(
        [o.NOTES],
        f"SELECT doc_id, array_to_string({_SSN_SQL}, '|') AS ssns,"
        f" CAST(len({_SSN_SQL}) AS INT) AS ssn_count FROM usable",
    ),
)
def _(spark, sf):
    found = patterns.extract_ssn(F.col("text"))
    notes = fx.notes(spark, sf).filter("text is not null")
    return notes.select(
        "doc_id", F.array_join(found, "|").alias("ssns"), F.size(found).alias("ssn_count")
    )


SPAN_PATTERN = "[A-Z][a-z]+ [a-z]+ing"
COMMA_SPAN = "[A-Z][a-zA-Z]+ ?, [A-Z][a-zA-Z]+"
ROLE_SQL = r"\b(?:" + "|".join([*o.C.ROLE_WORDS, *[w.upper() for w in o.C.ROLE_WORDS]]) + rf")\b[^{o.W_}]*"


@register(
    "mask_spans",
    f"SELECT doc_id, {o.masked('text', SPAN_PATTERN, o.W + '+', NAME_TAG)} AS masked FROM documents",
)
def _(spark, sf):
    masked = spans.mask_spans(F.col("text"), SPAN_PATTERN, NAME_TAG)
    return fx.table(spark, sf, "documents").select("doc_id", masked.alias("masked"))


@register(
    "strip_role_word",
    o.with_chain(
        [o.NOTES],
        f"SELECT doc_id, span, regexp_replace(span, {o.rx(ROLE_SQL)}, '', 'g') AS stripped FROM"
        f" (SELECT doc_id, unnest(regexp_extract_all(text, {o.rx(COMMA_SPAN)})) AS span FROM notes)",
    ),
)
def _(spark, sf):
    found = fx.notes(spark, sf).select(
        "doc_id", F.explode(spans.matches(F.col("text"), COMMA_SPAN)).alias("span")
    )
    return found.select("doc_id", "span", spans.strip_role_word(F.col("span")).alias("stripped"))


_DIFF_PAIRS = (
    f"list_zip(regexp_extract_all(text, {o.rx(f'[^{o.S_}]+')}),"
    f" regexp_extract_all(street, {o.rx(f'[^{o.S_}]+')}))"
)


@register(
    "masked_token_diff",
    o.with_chain(
        [o.NOTES],
        f"SELECT doc_id, array_to_string(list_filter(list_transform(list_filter({_DIFF_PAIRS},"
        " lambda p: p[1] <> p[2]), lambda p: regexp_replace(p[1], '[-,+]', '', 'g')),"
        f" lambda t: NOT contains(t, '{ADDRESS_TAG}')), '|') AS changed"
        f" FROM (SELECT doc_id, text, {o.STREET_MASKED} AS street FROM usable)",
    ),
)
def _(spark, sf):
    after = address.mask_street_spans(F.col("text"))
    rows = fx.notes(spark, sf).filter("text is not null").withColumn("street", after)
    changed = spans.masked_token_diff(F.col("text"), F.col("street"))
    return rows.select("doc_id", F.array_join(changed, "|").alias("changed"))


_STREETS_SQL = (
    f"list_concat(list_filter(regexp_extract_all(text, {o.rx(o.STREET)}), lambda m: {o.is_street('m')}),"
    f" regexp_extract_all(text, {o.rx(o.APARTMENT)}))"
)


@register(
    "street_spans",
    o.with_chain(
        [o.NOTES],
        f"SELECT doc_id, regexp_replace(s, '^\\s+|\\s+$', '', 'g') AS span"
        f" FROM (SELECT doc_id, unnest({_STREETS_SQL}) AS s FROM usable)",
    ),
)
def _(spark, sf):
    found = fx.notes(spark, sf).select(
        "doc_id", F.explode(address.street_spans(F.col("text"))).alias("s")
    )
    return found.select("doc_id", F.regexp_replace("s", r"^\s+|\s+$", "").alias("span"))


# --- Taggers: the text after each step, in their fixed order --------------------------------
def marked(spark: SparkSession, sf: str) -> DataFrame:
    lexicon = fx.lexicon(spark, sf)
    return mark_notes(fx.notes(spark, sf), lexicon, ["doc_id"])


def after_places(*steps) -> Query:
    def query(spark, sf):
        rows = run_steps(marked(spark, sf), "marked", steps)
        return rows.select("doc_id", shown(F.col("text"), F.col("marked")).alias("masked"))

    return query


def after_zip(*steps) -> Query:
    def query(spark, sf):
        rows = marked(spark, sf).withColumn("step", F.col("marked"))
        rows = run_steps(rows, "step", address.PLACE_STEPS)
        known = address.known_address_words(F.col("marked"))
        rows = rows.withColumn("step", address.mask_zip(F.col("step"), known))
        rows = run_steps(rows, "step", steps)
        return rows.select("doc_id", shown(F.col("text"), F.col("step")).alias("masked"))

    return query


def after_names(last) -> Query:
    def query(spark, sf):
        steps = names.NAME_STEPS[: names.NAME_STEPS.index(last) + 1]
        rows = run_steps(mask_addresses(marked(spark, sf)), "address_masked", steps)
        return rows.select("doc_id", shown(F.col("text"), F.col("address_masked")).alias("masked"))

    return query


ADDRESS_CHAIN = [*MATCH_CHAIN, o.ADDRESS]
NAME_CHAIN = [*ADDRESS_CHAIN, o.NAMES]


def words_sql(chain: list[str], words: str, source: str) -> str:
    parts = [*chain, o.text_of("step_text", words, source)]
    return o.with_chain(parts, "SELECT doc_id, text AS masked FROM step_text")


def text_sql(chain: list[str], text: str) -> str:
    return o.with_chain(chain, f"SELECT doc_id, text AS masked FROM {text}")


_PLACES = address.PLACE_STEPS
for _name, _steps, _words in [
    ("mask_multiword_city", [address.mask_multiword_city], "s_multi"),
    ("mask_city_state", [address.mask_multiword_city, address.mask_city_state], "s_pair"),
    ("mask_city_clinic", _PLACES[:2], "s_clinic"),
    ("mask_state_abbrev", _PLACES[:3], "s_abbrev"),
    ("mask_state_full", _PLACES[:4], "s_full"),
]:
    register(_name, words_sql(ADDRESS_CHAIN, _words, "street_text"))(after_places(*_steps))

register("mask_street", text_sql(MATCH_CHAIN, "street_text"))(
    lambda spark, sf: fx.notes(spark, sf)
    .filter("text is not null")
    .select("doc_id", address.mask_street(F.col("text")).alias("masked"))
)
register("mask_zip", text_sql(ADDRESS_CHAIN, "zip_text"))(after_zip())
register("normalize_address_tags", text_sql(ADDRESS_CHAIN, "address_text"))(
    after_zip(*address.CLEANUP_STEPS)
)

for _name, _step, _words in [
    ("mask_clinician", names.mask_clinician, "t1"),
    ("mask_last_first", names.mask_after_role, "t3"),
    ("mask_titled", names.mask_titled, "t4"),
    ("mask_dictionary_name", names.mask_dictionary_name, "t5"),
    ("mask_middle", names.mask_middle, "w3"),
    ("mask_hyphen", names.mask_hyphen, "t7"),
    ("normalize_name_tags", names.normalize_name_tags, "t8"),
]:
    register(_name, words_sql(NAME_CHAIN, _words, "address_text"))(after_names(_step))


@register(
    "last_first_spans",
    o.with_chain(
        NAME_CHAIN,
        "SELECT doc_id, span FROM (SELECT p.doc_id, p.pos, string_agg("
        "CASE WHEN t.pos = p.pos THEN '' ELSE t.gb END || t.word, '' ORDER BY t.pos) AS span"
        " FROM lastfirst_pick p JOIN t1 t ON t.doc_id = p.doc_id AND t.pos >= p.pos"
        " AND t.pos < p.pos + p.len GROUP BY ALL)",
    ),
)
def _(spark, sf):
    rows = mask_addresses(marked(spark, sf))
    rows = run_steps(rows, "address_masked", [names.mask_clinician, erase_marks])
    return rows.select(
        "doc_id", F.explode(names.last_first_spans(F.col("address_masked"))).alias("span")
    )


# --- Tokens and labels ----------------------------------------------------------------------
def lightly_masked(spark: SparkSession, sf: str) -> DataFrame:
    """Notes with e-mail addresses and phone numbers masked."""
    rows = fx.notes(spark, sf).filter("text is not null").withColumn("masked", F.col("text"))
    return run_steps(rows, "masked", [patterns.mask_email, patterns.mask_phone])


LIGHT = (
    f"light AS MATERIALIZED (SELECT doc_id, text, {o.masked(o.email('text'), PHONE_PATTERN, chr(92) + 'S+', PHONE_TAG)}"
    " AS masked FROM usable)"
)


def on_light(name: str, expression: Callable[[], Column]) -> Query:
    return lambda spark, sf: lightly_masked(spark, sf).select("doc_id", expression().alias(name))


def light_sql(name: str, expression: str) -> str:
    return o.with_chain([o.NOTES, LIGHT], f"SELECT doc_id, {expression} AS {name} FROM light")


def spaced_text() -> Column:
    return tokens.space_specials(F.col("text"), F.col("masked"))


def raw_labels() -> Column:
    return labels.iob_raw(tokens.clean_masked(F.col("masked")))


_RAW_SQL = o.raw_labels(o.cleaned_mask("masked"))

for _name, _column, _expression, _sql in [
    ("space_specials", "spaced", spaced_text, o.spaced("text", "masked")),
    ("clean_text", "cleaned", lambda: tokens.clean_text(F.col("text")), o.clean("text")),
    ("clean_masked", "cleaned", lambda: tokens.clean_masked(F.col("masked")), o.cleaned_mask("masked")),
    ("iob_raw", "iob_raw", raw_labels, _RAW_SQL),
    ("bio_labels", "iob", lambda: labels.bio_labels(raw_labels()), o.labels(_RAW_SQL)),
]:
    register(_name, light_sql(_column, _sql))(on_light(_column, _expression))


def located_sql(text: str) -> str:
    """Start and text of every recorded character, as structs."""
    pattern = o.rx(tokens.RECORDED)
    gaps, found = f"string_split_regex({text}, {pattern})", f"regexp_extract_all({text}, {pattern})"
    before = f"array_to_string({gaps}[1:i], '')"
    return (
        f"list_transform({found}, lambda m, i: {{'s': length({before})"
        f" + length(array_to_string({found}[1:i - 1], '')), 'c': m, 't': ''}})"
    )


@register(
    "special_locations",
    o.with_chain(
        [o.NOTES],
        "SELECT doc_id, CAST(x.s AS INT) AS start_at, CAST(x.s + length(x.c) AS INT) AS end_at, x.c AS character"
        f" FROM (SELECT doc_id, unnest({located_sql('text')}) AS x FROM usable)",
    ),
)
def _(spark, sf):
    found = fx.notes(spark, sf).select(
        "doc_id", F.explode(tokens.special_locations(F.col("text"))).alias("at")
    )
    return found.select(
        "doc_id", F.col("at.start").alias("start_at"), F.col("at.end").alias("end_at"), "at.character"
    )


@register(
    "restore_specials",
    o.with_chain(
        [o.NOTES, LIGHT],
        f"SELECT doc_id, list_reduce({located_sql('spaced')}, lambda a, x: {{'s': x.s, 'c': x.c,"
        " 't': left(a.t, x.s) || x.c || substr(a.t, x.s + 1)},"
        f" {{'s': 0::BIGINT, 'c': '', 't': {o.clean('spaced')}}}).t AS restored"
        f" FROM (SELECT doc_id, {o.spaced('text', 'masked')} AS spaced FROM light)",
    ),
)
def _(spark, sf):
    rows = lightly_masked(spark, sf).withColumn("spaced", spaced_text())
    spaced = F.col("spaced")
    restored = tokens.restore_specials(tokens.clean_text(spaced), tokens.special_locations(spaced))
    return rows.select("doc_id", restored.alias("restored"))


@register(
    "label_codes",
    o.with_chain(
        [o.NOTES, LIGHT],
        f"SELECT n.doc_id, CAST({o.code('n.text')} AS INT) AS text_code, CAST({o.code('iob')} AS INT) AS iob_code"
        f" FROM notes n LEFT JOIN (SELECT doc_id, {o.labels(_RAW_SQL)} AS iob FROM light) USING (doc_id)",
    ),
)
def _(spark, sf):
    rows = run_steps(
        fx.notes(spark, sf).withColumn("masked", F.col("text")),
        "masked",
        [patterns.mask_email, patterns.mask_phone],
    ).withColumn("iob", labels.bio_labels(raw_labels()))
    return rows.select(
        "doc_id",
        labels.label_code(F.col("text")).alias("text_code"),
        labels.label_code(F.col("iob")).alias("iob_code"),
    )


@register(
    "size_check",
    o.with_chain(
        [o.NOTES, LIGHT],
        f"""SELECT doc_id, CAST(CASE WHEN iob IS NOT NULL AND n_text = n_labels THEN 1 ELSE 0 END AS INT) AS split_equals,
  CAST(CASE WHEN iob IS NULL THEN 1 ELSE n_text END AS INT) AS length_text,
  CAST(CASE WHEN iob IS NULL THEN 0 ELSE n_labels END AS INT) AS length_labels
FROM (SELECT doc_id, iob, {o.count('cleaned')} AS n_text, {o.count('iob')} AS n_labels FROM notes n LEFT JOIN
  (SELECT doc_id, {o.clean(o.spaced('text', 'masked'))} AS cleaned, {o.labels(_RAW_SQL)} AS iob FROM light) USING (doc_id))""",
    ),
)
def _(spark, sf):
    rows = run_steps(
        fx.notes(spark, sf).withColumn("masked", F.col("text")),
        "masked",
        [patterns.mask_email, patterns.mask_phone],
    )
    rows = rows.withColumn("cleaned", tokens.clean_text(spaced_text())).withColumn(
        "iob", labels.bio_labels(raw_labels())
    )
    checked = rows.select("doc_id", labels.size_check(F.col("cleaned"), F.col("iob")).alias("sizes"))
    return checked.select("doc_id", "sizes.*")


# --- Whole pipeline -------------------------------------------------------------------------
def annotated(spark: SparkSession, sf: str, columns: list[str]) -> DataFrame:
    return annotate_notes(fx.notes(spark, sf), fx.lexicon(spark, sf), columns=columns)


def chain_sql(select: str) -> str:
    return o.with_chain(o.CHAIN, select)


@register(
    "label_validation_counts",
    chain_sql("SELECT CAST(label_code AS INT) AS label_code, count(*) AS n_notes FROM annotated GROUP BY 1"),
)
def _(spark, sf):
    return quality.label_validation_counts(annotated(spark, sf, ["label_code"]))


@register(
    "counts_beside_labels",
    chain_sql(
        "SELECT 'code_' || CAST(label_code AS VARCHAR) AS outcome, count(*) AS n_notes FROM annotated GROUP BY label_code"
        " UNION ALL SELECT CASE WHEN equal THEN 'equal' ELSE 'unequal' END, count(*) FROM annotated WHERE label_code = 1 GROUP BY equal"
        " UNION ALL SELECT 'rows', count(DISTINCT cleaned) FROM annotated WHERE label_code = 1 AND equal"
    ),
)
def _(spark, sf):
    """Label counts taken while the label rows are written, and how many rows were."""
    rows, seen = counted_labels(fx.notes(spark, sf), fx.lexicon(spark, sf))
    path = f"{spark.sparkContext.getCheckpointDir()}/labels-{uuid.uuid4().hex}"
    write_labels(rows, path)
    counts = [F.struct(F.lit(k).alias("outcome"), F.lit(n).cast("long").alias("n_notes")) for k, n in seen.get.items() if n]
    rows = spark.read.parquet(path).agg(F.count("*").alias("rows"))
    every = F.array(*counts, F.struct(F.lit("rows").alias("outcome"), F.col("rows").alias("n_notes")))
    return rows.select(F.explode(every).alias("x")).select("x.*")


@register(
    "split_equals_counts",
    chain_sql(
        "SELECT CAST(CASE WHEN equal THEN 1 ELSE 0 END AS INT) AS split_equals, count(*) AS n_notes"
        " FROM annotated WHERE label_code = 1 GROUP BY 1"
    ),
)
def _(spark, sf):
    return quality.split_equals_counts(annotated(spark, sf, ["label_code", "sizes"]))


@register(
    "valid_rows",
    chain_sql(
        "SELECT doc_id, text, masked, cleaned, iob, CAST(length_text AS INT) AS length_text,"
        " CAST(length_labels AS INT) AS length_labels FROM annotated WHERE label_code = 1 AND equal"
    ),
)
def _(spark, sf):
    wanted = ["text", "masked", "cleaned", "iob", "sizes", "reject_reason"]
    return quality.valid_rows(annotated(spark, sf, wanted)).select(
        "doc_id", "text", "masked", "cleaned", "iob", "sizes.length_text", "sizes.length_labels"
    )


_FULL_SPACED = o.spaced("text", "masked")
_SSN_IN_MASKED = f"regexp_extract_all({o.email('n.text')}, {o.rx(f'{o.C.SSN_DASHED_PATTERN}|{o.SSN_PLAIN}')})"


@register(
    "annotated_notes",
    chain_sql(
        f"""SELECT a.doc_id, a.masked, {_FULL_SPACED.replace('text', 'a.text').replace('masked', 'a.masked')} AS spaced, a.cleaned,
  a.iob_raw, a.iob, CAST(label_code AS INT) AS label_code, array_to_string({_SSN_IN_MASKED}, '|') AS ssns,
  CAST(length_text AS INT) AS length_text, CAST(length_labels AS INT) AS length_labels,
  CASE WHEN label_code = 5 THEN 'labels_empty' WHEN label_code = 2 THEN 'labels_unknown'
    WHEN NOT equal THEN 'size_mismatch' END AS reject_reason
FROM annotated a JOIN name_text n USING (doc_id)"""
    ),
)
def _(spark, sf):
    """All token and label columns on the fully masked text."""
    wanted = ["masked", "spaced", "cleaned", "iob_raw", "iob", "label_code", "ssn_matches", "sizes", "reject_reason"]
    return annotated(spark, sf, wanted).select(
        "doc_id", *wanted[:6], F.array_join("ssn_matches", "|").alias("ssns"),
        "sizes.length_text", "sizes.length_labels", "reject_reason",
    )


@register(
    "annotated_locations",
    chain_sql(
        "SELECT doc_id, CAST(x.s AS INT) AS start_at, CAST(x.s + length(x.c) AS INT) AS end_at, x.c AS character"
        f" FROM (SELECT doc_id, unnest({located_sql('spaced')}) AS x"
        f" FROM (SELECT doc_id, {_FULL_SPACED} AS spaced FROM annotated))"
    ),
)
def _(spark, sf):
    """Recorded characters of the fully spaced text."""
    rows = annotate_notes(fx.notes(spark, sf), fx.lexicon(spark, sf), with_locations=True, columns=["locations"])
    return rows.select("doc_id", F.explode("locations").alias("at")).select(
        "doc_id", F.col("at.start").alias("start_at"), F.col("at.end").alias("end_at"), "at.character"
    )


@register(
    "annotated_restored",
    chain_sql(
        f"SELECT doc_id, list_reduce({located_sql('spaced')}, lambda a, x: {{'s': x.s, 'c': x.c,"
        " 't': left(a.t, x.s) || x.c || substr(a.t, x.s + 1)},"
        f" {{'s': 0::BIGINT, 'c': '', 't': {o.clean('spaced')}}}).t AS restored"
        f" FROM (SELECT doc_id, {_FULL_SPACED} AS spaced FROM annotated)"
    ),
)
def _(spark, sf):
    """Recorded characters put back into the cleaned text."""
    rows = annotate_notes(
        fx.notes(spark, sf), fx.lexicon(spark, sf), with_locations=True, columns=["cleaned", "locations"]
    )
    return rows.select("doc_id", tokens.restore_specials(F.col("cleaned"), F.col("locations")).alias("restored"))


# Characters of a text that its cleaned form keeps are those of its tokens, in their order.
_SOLID_SQL = f"regexp_matches(c, {o.rx(f'[^{o.S_}]')}) AND c NOT IN (',', '[', ']')"


_SPANS_SQL = f"""valid AS MATERIALIZED (SELECT * FROM annotated WHERE label_code = 1 AND equal),
kept AS MATERIALIZED (
  SELECT doc_id, place, row_number() OVER (PARTITION BY doc_id ORDER BY place) - 1 AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '(?s).')) AS c, unnest(range(0, length(text))) AS place FROM valid)
  WHERE {_SOLID_SQL}),
pieces AS (
  SELECT doc_id, unnest(string_split(iob, ' ')) AS label, unnest(range(0, length_text)) AS i,
    unnest(list_transform(regexp_extract_all(cleaned, {o.rx(f'[^{o.S_}]+')}), lambda t: length(t))) AS n
  FROM valid),
placed AS (
  SELECT doc_id, i, label, sum(n) OVER w - n AS a, sum(n) OVER w - 1 AS b FROM pieces
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (
  SELECT *, sum(CASE WHEN label LIKE 'B-%' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM placed),
spans AS (
  SELECT t.doc_id, span, min(s.place) AS start_at, max(e.place) + 1 AS end_at, any_value(label[3:]) AS tag
  FROM numbered t
  JOIN kept s ON s.doc_id = t.doc_id AND s.k = t.a
  JOIN kept e ON e.doc_id = t.doc_id AND e.k = t.b
  WHERE label <> 'O' GROUP BY t.doc_id, span)"""


@register(
    "label_spans",
    o.with_chain(
        [*o.CHAIN, _SPANS_SQL],
        "SELECT doc_id, CAST(start_at AS INT) AS start_at, CAST(end_at AS INT) AS end_at, tag,"
        " substr(text, start_at + 1, end_at - start_at) AS covered FROM spans JOIN valid USING (doc_id)",
    ),
)
def _(spark, sf):
    """Labelled stretches of the notes as they were given."""
    return spans_of_notes(fx.notes(spark, sf), fx.lexicon(spark, sf))


@register(
    "edit_scripts",
    chain_sql("SELECT doc_id, text AS restored, cleaned, CAST(length_text AS INT) AS n_tokens FROM annotated"),
)
def _(spark, sf):
    """Original and cleaned text of every usable note, both from its edit script."""
    rows = annotate_notes(fx.notes(spark, sf), fx.lexicon(spark, sf), with_script=True, columns=["script"])
    return rows.select(
        "doc_id", tokens.restore_text(F.col("script")).alias("restored"), tokens.cleaned_of(F.col("script")).alias("cleaned"),
        (F.size("script") - 1).alias("n_tokens"),
    )


@register(
    "tagger_rejects",
    chain_sql(
        "SELECT doc_id, 'null_text' AS reject_reason FROM notes WHERE text IS NULL UNION ALL"
        " SELECT doc_id, CASE WHEN label_code = 5 THEN 'labels_empty' WHEN label_code = 2 THEN 'labels_unknown'"
        " ELSE 'size_mismatch' END FROM annotated WHERE label_code <> 1 OR NOT equal"
    ),
)
def _(spark, sf):
    return rejected_notes(fx.notes(spark, sf), fx.lexicon(spark, sf))


@register(
    "reject_diffs",
    chain_sql(
        "SELECT doc_id, CAST(length_labels - length_text AS INT) AS shift FROM annotated WHERE label_code = 1 AND NOT equal"
    ),
)
def _(spark, sf):
    """By how many tokens rejected notes and their labels differ, summed over the stretches of their diff."""
    found = diffs_of_rejects(fx.notes(spark, sf), fx.lexicon(spark, sf))
    return found.groupBy("doc_id").agg(F.sum("shift").cast("int").alias("shift"))


@register(
    "dedup_cleaned",
    f"SELECT min(doc_id) AS doc_id, cleaned FROM (SELECT doc_id, {o.clean('text')} AS cleaned FROM documents)"
    " GROUP BY cleaned",
)
def _(spark, sf):
    rows = fx.table(spark, sf, "documents").select("doc_id", tokens.clean_text(F.col("text")).alias("cleaned"))
    return quality.keep_first_text(rows, ["doc_id"])


@register(
    "tag_notes",
    chain_sql(
        "SELECT doc_id, text, cleaned, iob, masked FROM annotated WHERE label_code = 1 AND equal"
        " QUALIFY row_number() OVER (PARTITION BY cleaned ORDER BY doc_id) = 1"
    ),
)
def _(spark, sf):
    return tag_notes(fx.notes(spark, sf), fx.lexicon(spark, sf))



@register(
    "labels_and_rejects",
    chain_sql(
        "SELECT doc_id, 'label' AS kind, iob AS outcome FROM annotated WHERE label_code = 1 AND equal"
        " QUALIFY row_number() OVER (PARTITION BY cleaned ORDER BY doc_id) = 1"
        " UNION ALL SELECT doc_id, 'reject', 'null_text' FROM notes WHERE text IS NULL"
        " UNION ALL SELECT doc_id, 'reject', CASE WHEN label_code = 5 THEN 'labels_empty'"
        " WHEN label_code = 2 THEN 'labels_unknown' ELSE 'size_mismatch' END FROM annotated"
        " WHERE label_code <> 1 OR NOT equal"
    ),
)
def _(spark, sf):
    """Labels and rejects of one run, written as parquet by the sink and read back."""
    labels, rejects = labels_and_rejects(fx.notes(spark, sf), fx.lexicon(spark, sf))
    rows = labels.select("doc_id", F.lit("label").alias("kind"), F.col("iob").alias("outcome")).unionByName(
        rejects.select("doc_id", F.lit("reject").alias("kind"), F.col("reject_reason").alias("outcome"))
    )
    path = f"{spark.sparkContext.getCheckpointDir()}/labels-{uuid.uuid4().hex}"
    write_labels(rows, path, partition_by="kind")
    return spark.read.parquet(path)


# --- Runs and streams -----------------------------------------------------------------------
FILES_A_BATCH = 3


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new name in the shared folder."""
    gz.ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def as_stream(spark: SparkSession, rows: DataFrame, folder: str, files: int = 8) -> DataFrame:
    """Rows written as files and read as a stream, a few files in each batch."""
    rows.repartition(files).write.parquet(folder)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", FILES_A_BATCH).parquet(folder)


@register(
    "repeated_runs",
    o.with_chain([o.NOTES], "SELECT doc_id, text, CAST(abs(doc_id) % 3 AS INT) AS part FROM notes"),
)
def _(spark, sf):
    """Notes written in three runs, of which one is repeated and one was left unfinished before."""
    folder = fresh_folder(spark, "runs")
    notes = fx.notes(spark, sf).withColumn("part", (F.abs("doc_id") % 3).cast("int"))
    notes.filter("part = 2").write.parquet(f"{folder}/data/{runs.ATTEMPT}=a-unfinished")
    for part in (0, 1, 1, 2):
        runs.write_run(notes.filter(F.col("part") == part), folder, f"part-{part}")
    return runs.read_runs(spark, folder)


@register(
    "streamed_labels",
    chain_sql(
        "SELECT doc_id, 'label' AS kind, iob AS outcome, masked FROM annotated WHERE label_code = 1 AND equal"
        " QUALIFY row_number() OVER (PARTITION BY cleaned ORDER BY doc_id) = 1"
        " UNION ALL SELECT doc_id, 'reject', 'null_text', NULL FROM notes WHERE text IS NULL"
        " UNION ALL SELECT doc_id, 'reject', CASE WHEN label_code = 5 THEN 'labels_empty'"
        " WHEN label_code = 2 THEN 'labels_unknown' ELSE 'size_mismatch' END, NULL FROM annotated"
        " WHERE label_code <> 1 OR NOT equal"
    ),
)
def _(spark, sf):
    """Labels and rejects of notes that arrive in several batches: the rows of one batch run."""
    folder = fresh_folder(spark, "stream")
    notes = as_stream(spark, fx.notes(spark, sf), f"{folder}/notes")
    query = streams.label_stream(notes, fx.lexicon(spark, sf), f"{folder}/checked", f"{folder}/state")
    query.trigger(availableNow=True).start().awaitTermination()
    labelled = streams.streamed_labels(spark, f"{folder}/checked")
    rejects = streams.streamed_rejects(spark, f"{folder}/checked")
    return labelled.select("doc_id", F.lit("label").alias("kind"), F.col("iob").alias("outcome"), "masked").unionByName(
        rejects.select("doc_id", F.lit("reject").alias("kind"), F.col("reject_reason").alias("outcome")),
        allowMissingColumns=True,
    )


@register(
    "streamed_first_texts",
    f"SELECT min(doc_id) AS doc_id, sha256(cleaned) AS text_key FROM (SELECT doc_id, {o.clean('text')} AS cleaned"
    " FROM documents WHERE text IS NOT NULL) GROUP BY cleaned",
)
def _(spark, sf):
    """Lowest id of each cleaned text of a stream of documents, by keyed state."""
    folder = fresh_folder(spark, "stream")
    documents = fx.table(spark, sf, "documents").filter("text is not null").select("doc_id", "text")
    arriving = as_stream(spark, documents, f"{folder}/documents")
    cleaned = arriving.select("doc_id", tokens.clean_text(F.col("text")).alias("cleaned"))
    query = streams.first_text_stream(cleaned, f"{folder}/firsts", f"{folder}/state")
    query.trigger(availableNow=True).start().awaitTermination()
    return streams.least_ids(spark, f"{folder}/firsts")
