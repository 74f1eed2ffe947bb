"""The same results in DuckDB SQL, for checking the registered queries.

The taggers are written here over a table of words with window functions, not over marked text.
"""

from __future__ import annotations

from notemask import constants as C
from notemask.plans import fixtures as X

W = r"[0-9A-Za-z_\p{L}\p{N}]"
W_ = r"0-9A-Za-z_\p{L}\p{N}"
WIDE = r"\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
S_ = rf"\t-\r\x1c-\x20{WIDE}"
SPECIAL = rf"[^{S_}{W_}']"
LETTERS = r"[\p{L}]+"


def q(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def items(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def member(expr: str, values) -> str:
    return f"list_contains({items(values)}, {expr})"


def rows(names: list[str], values: list[tuple]) -> str:
    body = ", ".join("(" + ", ".join(q(v) for v in row) + ")" for row in values)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(names)})"


def rx(pattern: str) -> str:
    return q(pattern)


def key(x: str) -> str:
    bare = f"regexp_replace(lower({x}), {rx(f'[^{S_}{W_}]')}, '', 'g')"
    return f"trim(regexp_replace({bare}, {rx(f'[{S_}]+')}, ' ', 'g'))"


def title(x: str) -> str:
    parts = (
        f"list_zip(string_split_regex(lower({x}), {rx(LETTERS)}),"
        f" list_append(regexp_extract_all(lower({x}), {rx(LETTERS)}), ''))"
    )
    return (
        f"array_to_string(list_transform({parts},"
        f" lambda p: p[1] || upper(left(p[2], 1)) || substr(p[2], 2)), '')"
    )


def n_words(x: str) -> str:
    return f"len(regexp_extract_all({x}, {rx(W + '+')}))"


def masked(text: str, pattern: str, inner: str, tag: str, keep: str = "true") -> str:
    """Matches of ``pattern`` with every ``inner`` run replaced; ``keep`` tests ``m``."""
    tagged = f"regexp_replace(m, {rx(inner)}, {q(tag)}, 'g')"
    new = (
        f"list_transform(regexp_extract_all({text}, {rx(pattern)}),"
        f" lambda m: CASE WHEN {keep} THEN {tagged} ELSE m END)"
    )
    pairs = f"list_zip(string_split_regex({text}, {rx(pattern)}), list_append({new}, ''))"
    return f"array_to_string(list_transform({pairs}, lambda p: p[1] || p[2]), '')"


# --- Inputs -------------------------------------------------------------------------------
N = len(X.TEMPLATES)
CODES = C.STATE_ABBREVIATIONS + X.FOREIGN_CODES
HOST = title("regexp_extract(url, '^https?://([^./]+)', 1)")

NOTES = f"""notes AS MATERIALIZED (
  SELECT doc_id, concat_ws(' ', text, replace({items(X.TEMPLATES)}[doc_id % {N} + 1], '{{d}}',
         lpad(CAST(doc_id % 10000 AS VARCHAR), 4, '0'))) AS text
  FROM documents
  UNION ALL
  SELECT -doc_id - 1, CASE WHEN doc_id % {N} = {X.EMPTY_SLOT} THEN '' END
  FROM documents WHERE doc_id % {N} IN ({X.NULL_SLOT}, {X.EMPTY_SLOT})),
usable AS MATERIALIZED (SELECT * FROM notes WHERE text IS NOT NULL)"""

RAW = f"""raw_names AS (
  SELECT unnest(list_filter(regexp_extract_all(text, {rx(W + '+')}),
    lambda w: regexp_matches(w, '^\\p{{Lu}}\\p{{L}}+$'))) AS name FROM conversations
  UNION ALL {rows(['name'], [(n,) for n in X.SEED_NAMES])}),
raw_states AS (SELECT {items(X.SEED_STATES)}[c_custkey % {len(X.SEED_STATES)} + 1] AS state FROM customer),
raw_zips AS (
  SELECT lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') AS ZIP FROM customer
  UNION ALL {rows(['ZIP'], [(z,) for z in X.SEED_ZIPS])}),
raw_cities AS (
  SELECT CASE WHEN page_id % 5 = 0 THEN {HOST} || ' Falls' ELSE {HOST} END AS city,
    {items(CODES)}[page_id % {len(CODES)} + 1] AS state_code,
    'State of ' || {items(CODES)}[page_id % {len(CODES)} + 1] AS state_full,
    'County ' || CAST(page_id % 40 AS VARCHAR) AS county
  FROM pages
  UNION ALL {rows(['a', 'b', 'c', 'd'], [r[:4] for r in X.SEED_CITIES])}),
raw_extra AS (
  SELECT {title('p_name')} AS city, {items(CODES)}[p_partkey % {len(CODES)} + 1] AS state_code,
    'State of ' || {items(CODES)}[p_partkey % {len(CODES)} + 1] AS state_full FROM part
  UNION ALL {rows(['a', 'b', 'c'], [(r[3], r[1], r[2]) for r in X.SEED_EXTRA_CITIES])})"""

GAZETTEERS = f"""g_names AS MATERIALIZED (
  SELECT min({title('trim(name)')}) AS name, {key('name')} AS key FROM raw_names
  WHERE name IS NOT NULL AND {key('name')} <> '' GROUP BY ALL),
g_states AS MATERIALIZED (
  SELECT DISTINCT CASE WHEN length(state) > 2 THEN {title('state')} ELSE state END AS state,
    {key('state')} AS key, length(state) <= 2 AS is_abbrev
  FROM (SELECT state FROM raw_states UNION ALL {rows(['state'], [(t,) for t in C.US_TERRITORIES])})),
g_zips AS MATERIALIZED (SELECT DISTINCT ZIP AS zipcode FROM raw_zips WHERE ZIP IS NOT NULL),
first_cities AS (
  SELECT * FROM raw_cities WHERE {member('state_code', C.STATE_ABBREVIATIONS)} AND city <> '88'
    AND city NOT IN (SELECT state FROM g_states)),
g_cities AS MATERIALIZED (
  SELECT DISTINCT city, state_code, state_full, county FROM first_cities
  UNION
  SELECT DISTINCT city, state_code, state_full, NULL FROM raw_extra
  WHERE {member('state_code', C.STATE_ABBREVIATIONS)} AND city NOT IN (SELECT state FROM g_states)
    AND city NOT IN (SELECT city FROM first_cities WHERE city IS NOT NULL)),
g_city_states AS MATERIALIZED (
  SELECT DISTINCT city, state_full, state_code FROM g_cities
  WHERE city IS NOT NULL AND state_full IS NOT NULL),
g_tokens AS MATERIALIZED (
  SELECT DISTINCT {key('city')} AS key, {key('s')} AS state_token
  FROM (SELECT city, unnest([state_full, state_code]) AS s FROM g_city_states)),
excluded AS (SELECT DISTINCT {key('w')} AS key FROM (SELECT unnest({items(C.NON_CITY_WORDS)}) AS w)),
lex_rows AS (
  SELECT key, key NOT IN (SELECT key FROM excluded) AS f_name, true AS f_any, false AS f_city,
    false AS f_multi, false AS f_state, false AS f_zip FROM g_names
  UNION ALL SELECT key, false, false, false, false, true, false FROM g_states WHERE NOT is_abbrev
  UNION ALL SELECT zipcode, false, false, false, false, false, true FROM g_zips
  UNION ALL SELECT key, false, false, NOT multi AND one, multi, false, false FROM (
    SELECT {key('city')} AS key, {n_words('city')} = 1 AS one,
      contains(city, '-') OR (contains(city, ' ') AND length(city) > 3 AND NOT contains(city, 'Mc')
        AND NOT contains(city, 'State ') AND NOT {member('city', C.NON_CITY_PHRASES)}) AS multi
    FROM (SELECT DISTINCT city FROM g_city_states)) WHERE key NOT IN (SELECT key FROM excluded)),
lexicon AS MATERIALIZED (
  SELECT key, bool_or(f_name) AS f_name, bool_or(f_any) AS f_any, bool_or(f_city) AS f_city,
    bool_or(f_multi) AS f_multi, bool_or(f_state) AS f_state, bool_or(f_zip) AS f_zip
  FROM lex_rows WHERE key <> '' GROUP BY key)"""

# --- Words and lookups --------------------------------------------------------------------
STREETS = sorted(C.STREET_WORDS, key=lambda w: (-len(w), w))
STREET_ALT = "(?i:" + "|".join(STREETS) + ")"
STREET = rf"\b[0-9]{{1,5}}\s?{W}?[^\n]?[{W_}\s]{{1,16}}{STREET_ALT}[.,]?[^{W_}]?(?:\s|$)"
APARTMENT = r"\s(?:APT|Apt)\s[a-zA-Z0-9_.-]+"


def is_street(m: str) -> str:
    bare = f"regexp_replace({m}, {rx(f'[^{S_}{W_}]')}, '', 'g')"
    not_title = r"\p{Lu}\p{Lu}|\p{Ll}\p{Lu}([^\p{Ll}]|$)|(^|[^\p{L}])\p{Ll}"
    has_upper = f"regexp_matches({m}, '\\p{{Lu}}')"
    return (
        f"(({has_upper} AND NOT regexp_matches({bare}, {rx(not_title)}))"
        f" OR ({has_upper} AND NOT regexp_matches({m}, '\\p{{Ll}}'))"
        f" OR regexp_matches({m}, '[0-9](?i:st|rd|nd|th)'))"
        f" AND regexp_matches({m}, {rx(f'(?:^| )[^{W_}]*{STREET_ALT}[^{W_}]*$')})"
    )


def street_key(m: str) -> str:
    return f"trim(regexp_replace(lower({m}), {rx(f'[^{W_}]+')}, ' ', 'g'))"


STREET_KEYS = (
    f"list_transform(list_filter(regexp_extract_all(text, {rx(STREET)}), lambda s: {is_street('s')}),"
    f" lambda k: {street_key('k')})"
)
STREET_MASKED = masked("text", STREET, W + "+", C.ADDRESS_TAG, f"list_contains({STREET_KEYS}, {street_key('m')})")
APARTMENT_MASKED = masked("text", APARTMENT, W + "+", C.ADDRESS_TAG)


def words(name: str, source: str) -> str:
    return f"""{name} AS MATERIALIZED (
  SELECT doc_id, unnest(range(len(ws))) AS pos, unnest(ws) AS word,
    unnest(gs[1:len(ws)]) AS gb, unnest(gs[2:len(ws) + 1]) AS ga
  FROM (SELECT doc_id, regexp_extract_all(text, {rx(W + '+')}) AS ws,
          string_split_regex(text, {rx(W + '+')}) AS gs FROM {source}))"""


def text_of(name: str, word_table: str, source: str) -> str:
    """Text from words; ``source`` has the original text, whose last gap is kept."""
    return f"""{name} AS MATERIALIZED (
  SELECT n.doc_id, coalesce(x.t, '') || string_split_regex(n.text, {rx(W + '+')})[-1] AS text
  FROM {source} n LEFT JOIN (SELECT doc_id, string_agg(gb || word, '' ORDER BY pos) AS t
    FROM {word_table} GROUP BY doc_id) x USING (doc_id))"""


def gap_key(g: str) -> str:
    ok = r"^(?: |[-'.]|\. )$"
    return f"CASE WHEN regexp_matches({g}, {rx(ok)}) THEN CASE WHEN contains({g}, ' ') THEN ' ' ELSE '' END END"


def lead(x: str, n: int) -> str:
    return f"lead({x}, {n}) OVER doc" if n else x


def after(n: int) -> str:
    one = rx(f"^[{S_}]$")
    return f"CASE WHEN regexp_matches({lead('ga', n - 1)}, {one}) THEN lower({lead('word', n)}) END"


#: Words of the longest key (a seed city).
LONGEST = 5


def gram(n: int) -> str:
    """Key of the n words from here on."""
    if n == 1:
        return "lower(word)"
    return f"{gram(n - 1)} || {gap_key(lead('ga', n - 2))} || lower({lead('word', n - 1)})"


SIZES = range(1, LONGEST + 1)
GRAMS = ", ".join(f"{gram(n)} AS k{n}" for n in SIZES)
AFTERS = ", ".join(f"{after(n)} AS a{n}" for n in SIZES)
PHRASE_ROWS = ", ".join(f"({n}, k{n}, a{n})" for n in SIZES)
SEEN = "(regexp_matches(word, '^\\p{Lu}') OR gb LIKE '%-' OR ga LIKE '-%')"


def states_behind(n: int) -> str:
    """The next n words from a following word on, in one piece."""
    first = "regexp_replace(word, '^[^\\p{L}]+', '')"
    parts = [f"lower({first})"]
    for k in range(1, n):
        parts.append(f"CASE WHEN {lead('ga', k - 1)} = ' ' THEN ' ' END || lower({lead('word', k)})")
    return " || ".join(parts)


LOOKUP = f"""street_text AS MATERIALIZED (
  SELECT doc_id, {APARTMENT_MASKED} AS text FROM (SELECT doc_id, {STREET_MASKED} AS text FROM usable)),
{words('w1', 'street_text')},
lettered AS MATERIALIZED (
  SELECT doc_id, pos, lag(word) OVER d AS previous, lead(pos) OVER d AS following_pos,
    lower(regexp_replace(lead(word) OVER d, '^[^\\p{{L}}]+', '')) AS following
  FROM w1 WHERE regexp_matches(word, '\\p{{L}}') WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
grams AS MATERIALIZED (
  SELECT doc_id, pos, word, gb, ga, {GRAMS}, {AFTERS}, {states_behind(2)} AS st2, {states_behind(3)} AS st3
  FROM w1 WINDOW doc AS (PARTITION BY doc_id ORDER BY pos)),
phrases AS (
  SELECT g.doc_id, g.pos, u.n, u.k AS key, l.previous, l.following, l.following_pos, u.a AS after, f.st2, f.st3
  FROM grams g JOIN lettered l USING (doc_id, pos)
    LEFT JOIN grams f ON f.doc_id = l.doc_id AND f.pos = l.following_pos,
    LATERAL (VALUES {PHRASE_ROWS.replace("k", "g.k").replace("(", "(").replace(" a", " g.a")}) AS u(n, k, a)
  WHERE {SEEN.replace("word", "g.word").replace("gb", "g.gb").replace("ga ", "g.ga ")} AND u.k IS NOT NULL
  UNION ALL
  SELECT doc_id, pos, 1, word, NULL, NULL, NULL, NULL, NULL, NULL FROM w1 WHERE regexp_matches(word, '^[0-9]{{5}}$')),
found AS MATERIALIZED (
  SELECT p.doc_id, p.pos, p.n, p.key, x.f_name, x.f_zip, x.f_multi, x.f_state,
    x.f_city AND p.n = 1 AS city, p.following, p.following_pos,
    CASE WHEN x.f_city AND p.n = 1 THEN
        coalesce(regexp_matches(p.previous, '^\\p{{Lu}}$'), false) OR lower(p.previous) IN (SELECT key FROM lexicon WHERE f_any)
      WHEN x.f_multi OR x.f_state THEN p.after IN (SELECT key FROM lexicon WHERE f_any)
      ELSE false END AS beside_name,
    CASE WHEN NOT (x.f_city AND p.n = 1) THEN 0 WHEN t3.key IS NOT NULL THEN 3 WHEN t2.key IS NOT NULL THEN 2
      WHEN t.key IS NOT NULL THEN 1 ELSE 0 END AS state_words,
    state_words > 0 AS with_state
  FROM phrases p JOIN lexicon x USING (key)
  LEFT JOIN g_tokens t ON t.key = p.key AND t.state_token = p.following
  LEFT JOIN g_tokens t2 ON t2.key = p.key AND t2.state_token = p.st2
  LEFT JOIN g_tokens t3 ON t3.key = p.key AND t3.state_token = p.st3),
seen_marks AS MATERIALIZED (
  SELECT doc_id, pos, bool_or(name) AS m_name, bool_or(city) AS m_city, bool_or(pair) AS m_pair,
    bool_or(multi) AS m_multi, bool_or(state) AS m_state
  FROM (
    SELECT doc_id, unnest(range(pos, pos + n)) AS pos, f_name AS name,
      city AND NOT coalesce(beside_name, false) AS city, with_state AS pair,
      f_multi AND NOT coalesce(beside_name, false) AS multi,
      f_state AND NOT coalesce(beside_name, false) AS state FROM found
    UNION ALL SELECT doc_id, unnest(range(following_pos, following_pos + state_words)), false, false, true, false, false
    FROM found WHERE with_state)
  GROUP BY doc_id, pos),
places AS MATERIALIZED (
  SELECT DISTINCT doc_id, key, n, f_multi, f_state FROM found
  WHERE (f_multi OR f_state) AND NOT coalesce(beside_name, false)),
again AS MATERIALIZED (
  SELECT g.doc_id, g.pos, u.n, p.f_multi, p.f_state
  FROM (SELECT * FROM grams WHERE NOT {SEEN}) g, LATERAL (VALUES {PHRASE_ROWS.replace("k", "g.k").replace(" a", " g.a")}) AS u(n, k, a)
  JOIN places p ON p.doc_id = g.doc_id AND p.key = u.k AND p.n = u.n
  LEFT JOIN seen_marks m ON m.doc_id = g.doc_id AND m.pos = g.pos + u.n
  WHERE NOT (u.a IS NOT NULL AND coalesce(m.m_name, false))),
marks AS MATERIALIZED (
  SELECT doc_id, pos, bool_or(m_name) AS m_name, bool_or(m_city) AS m_city, bool_or(m_pair) AS m_pair,
    bool_or(m_multi) AS m_multi, bool_or(m_state) AS m_state
  FROM (SELECT * FROM seen_marks UNION ALL
    SELECT doc_id, unnest(range(pos, pos + n)), false, false, false, f_multi, f_state FROM again)
  GROUP BY doc_id, pos)"""

# --- Addresses ----------------------------------------------------------------------------
CLINIC = [w.lower() for w in C.CLINIC_WORDS]
TAG = q(C.ADDRESS_TAG)


def neighbours(source: str) -> str:
    """Each word with the nearest runs with letters before and behind it."""
    return f"""(SELECT s.*, n.next_word, n.previous_word FROM {source} s LEFT JOIN (
      SELECT doc_id, pos, lead(word) OVER d AS next_word, lag(word) OVER d AS previous_word FROM {source}
      WHERE regexp_matches(word, '\\p{{L}}') WINDOW d AS (PARTITION BY doc_id ORDER BY pos)) n USING (doc_id, pos))"""


def step(name: str, source: str, condition: str, tag: str = TAG) -> str:
    """Words that meet the condition become the tag and lose their marks."""
    return f"""{name} AS MATERIALIZED (
  SELECT doc_id, pos, gb, ga, CASE WHEN hit THEN {tag} ELSE word END AS word,
    m_name AND NOT hit AS m_name, m_city AND NOT hit AS m_city, m_pair AND NOT hit AS m_pair,
    m_multi AND NOT hit AS m_multi, m_state AND NOT hit AS m_state
  FROM (SELECT *, coalesce({condition}, false) AS hit FROM {source}))"""


NEXT = "regexp_replace(next_word, '^[^\\p{L}]+', '')"
ADDRESS = f"""s0 AS MATERIALIZED (
  SELECT w.doc_id, w.pos, w.gb, w.ga, w.word, coalesce(m_name, false) AS m_name,
    coalesce(m_city, false) AS m_city, coalesce(m_pair, false) AS m_pair,
    coalesce(m_multi, false) AS m_multi, coalesce(m_state, false) AS m_state
  FROM w1 w LEFT JOIN marks m USING (doc_id, pos)),
{step('s_multi', 's0', 'm_multi')},
{step('s_pair', 's0', 'm_multi OR m_pair')},
{step('s_clinic', neighbours('s_pair'), f"m_city AND ({member(f'lower({NEXT})', CLINIC)} OR starts_with({NEXT}, {TAG}))")},
{step('s_abbrev', neighbours('s_clinic'), f"previous_word = {TAG} AND {member('word', C.STATE_ABBREVIATIONS)}")},
{step('s_full', 's_abbrev', 'm_state')},
known AS MATERIALIZED (
  SELECT DISTINCT s0.doc_id, lower(s0.word) AS word FROM s0 JOIN s_clinic c USING (doc_id, pos)
  WHERE s0.m_multi OR s0.m_pair OR s0.m_state OR (c.word = {TAG} AND s0.word <> {TAG})),
{text_of('full_text', 's_full', 'street_text')},
zip_tokens AS MATERIALIZED (
  SELECT doc_id, unnest(range(len(ts))) AS i, unnest(ts) AS tok
  FROM (SELECT doc_id, string_split(text, ' ') AS ts FROM full_text)),
zip_near AS MATERIALIZED (
  SELECT t.doc_id, t.i, t.tok,
    contains(tok, {TAG}) OR k.word IS NOT NULL AS address,
    len(list_filter(regexp_extract_all(tok, '[0-9]+'), lambda d: length(d) = 5)) = 1 AS one,
    len(list_filter(regexp_extract_all(tok, {rx(W + '+')}), lambda d: regexp_matches(d, '^[0-9]{{5}}$'))) > 0 AS plain,
    regexp_matches(tok, '(^|[^0-9])[0-9]{{5}}-[0-9]{{4}}([^0-9]|$)') AS plus_four
  FROM zip_tokens t LEFT JOIN known k ON k.doc_id = t.doc_id AND k.word =
    lower(trim(regexp_replace(tok, {rx(f'[^{S_}{W_}]')}, '', 'g')))),
zip_listed AS MATERIALIZED (
  SELECT DISTINCT doc_id, i FROM (
    SELECT doc_id, i, unnest(regexp_extract_all(tok, {rx(W + '+')})) AS d FROM zip_near WHERE plain)
  WHERE d IN (SELECT zipcode FROM g_zips)),
zipped AS MATERIALIZED (
  SELECT z.doc_id, z.i, CASE WHEN ((z.one AND l.i IS NOT NULL) OR z.plus_four) AND
      (coalesce(lag(z.address, 1) OVER d, false) OR coalesce(lag(z.address, 2) OVER d, false))
    THEN regexp_replace(z.tok, '[0-9]+', {TAG}, 'g') ELSE z.tok END AS tok
  FROM zip_near z LEFT JOIN zip_listed l USING (doc_id, i) WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
zip_text AS MATERIALIZED (SELECT doc_id, string_agg(tok, ' ' ORDER BY i) AS text FROM zipped GROUP BY doc_id),
directed AS MATERIALIZED (
  SELECT doc_id, i, CASE WHEN {member(f"lower(regexp_replace(tok, {rx(f'[{S_}]')}, '', 'g'))", [d.lower() for d in C.DIRECTION_WORDS])}
      AND lead(tok) OVER d = {TAG} THEN regexp_replace(tok, {rx(W + '+')}, {TAG}) ELSE tok END AS tok
  FROM zipped WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
address_text AS MATERIALIZED (
  SELECT doc_id, string_agg(CASE WHEN contains(tok, {TAG}) THEN {masked('tok', f'[^{S_}]+', W + '+', C.ADDRESS_TAG, f'contains(m, {TAG})')}
    ELSE tok END, ' ' ORDER BY i) AS text FROM directed GROUP BY doc_id)"""

# --- Names --------------------------------------------------------------------------------
NTAG = q(C.NAME_TAG)
TAGS2 = [C.NAME_TAG, C.ADDRESS_TAG]
CUTOFFS = sorted({w.lower() for w in [*C.CUTOFF_WORDS, *C.ROLE_WORDS]})
NOT_TAG = f"NOT {member('word', TAGS2)}"
NO_CLINIC = "NOT regexp_matches(word, '^[A-Za-z]*(?i:asst|neuro)')"
NO_CUT = f"NOT {member('lower(word)', CUTOFFS)}"


def at(column: str, n: int) -> str:
    return f"coalesce(lead({column}, {n}) OVER doc, false)" if n else column


def gap(n: int, pattern: str) -> str:
    """The gap behind the n-th word of a span."""
    return f"coalesce(regexp_matches({lead('ga', n)}, {rx(pattern)}), false)"


def same(n: int, *options: str) -> str:
    return f"{member(lead('word', n), options)}"


def classes(source: str, guard: str) -> str:
    return f"""(SELECT *, {NOT_TAG} AND {guard} AND regexp_matches(word, '^[A-Z][a-z]+(?:[A-Z][a-z]+)?$') AS t,
      {NOT_TAG} AND {guard} AND regexp_matches(word, '^[A-Z]{{2,}}$') AS u,
      {NOT_TAG} AND {guard} AND regexp_matches(word, '^[A-Z][a-zA-Z]+$') AS e,
      regexp_matches(word, '^[A-Z]$') AS i1 FROM {source})"""


def suffix_length(n: int) -> str:
    """Number of word runs of MD, RN or RNA at the n-th word; 0 if there is none."""
    dot = "^[.]$"
    return f"""CASE WHEN {same(n, 'MD', 'DO', 'RNA')} THEN 1
      WHEN {same(n, 'D')} AND {gap(n, dot)} AND {same(n + 1, 'O')} THEN 2
      WHEN {same(n, 'M')} AND {gap(n, dot)} AND {same(n + 1, 'D')} THEN 2
      WHEN {same(n, 'R')} AND {gap(n, dot)} AND {same(n + 1, 'N')} AND {gap(n + 1, dot)} AND {same(n + 2, 'A')} THEN 3
      WHEN {same(n, 'R')} AND {gap(n, dot)} AND {same(n + 1, 'N', 'NA')} THEN 2
      WHEN {same(n, 'RN')} AND {gap(n, dot)} AND {same(n + 1, 'A')} THEN 2
      WHEN {same(n, 'RN')} THEN 1 ELSE 0 END"""


def picked(name: str, candidates: str) -> str:
    """Leftmost spans that do not overlap, and the positions they cover."""
    return f"""{name}_pick AS (
  SELECT doc_id, min(pos) AS pos, arg_min(len, pos) AS len FROM {candidates} GROUP BY doc_id
  UNION ALL
  SELECT c.doc_id, min(c.pos), arg_min(c.len, c.pos) FROM {name}_pick p JOIN {candidates} c
    ON c.doc_id = p.doc_id AND c.pos >= p.pos + p.len GROUP BY c.doc_id),
{name}_cover AS MATERIALIZED (
  SELECT doc_id, pos AS start, unnest(range(pos, pos + len)) AS pos FROM {name}_pick)"""


def three(x: str) -> str:
    return f"{x} AND {gap(0, SP)} AND ({at(x, 1)} AND {gap(1, SP)} OR {at('i1', 1)} AND {gap(1, DOT_SP)}) AND {at(x, 2)} AND {gap(2, COMMA_OPT)}"


def two(x: str) -> str:
    return f"{x} AND {gap(0, SP)} AND {at(x, 1)} AND {gap(1, COMMA_OPT)}"


SP, DOT_SP, COMMA_OPT = r"^\s+$", r"^\.?\s+$", r"^\s*,?\s*$"
COMMA, THIRD = r"^\s?,\s$", rf"^(?:[^{W_}\n]\s?|\s)$"


def lf(a: str, b: str, c: str = "") -> str:
    base = f"{a} AND {gap(0, COMMA)} AND {at(b, 1)}"
    return base + (f" AND {gap(1, THIRD)} AND {c}" if c else "")


NOT_AT = f"coalesce({lead('word', 2)} <> 'At', false)"
NAMES = f"""{words('w2', 'address_text')},
t0 AS MATERIALIZED (
  SELECT w.doc_id, w.pos, w.gb, w.ga, w.word, coalesce(s.m_name AND s.word = w.word, false) AS m_name
  FROM w2 w LEFT JOIN s_full s USING (doc_id, pos)),
clin AS MATERIALIZED (
  SELECT doc_id, pos, len FROM (SELECT doc_id, pos, CASE
      WHEN ({three('t')}) AND {suffix_length(3)} > 0 THEN 3 + {suffix_length(3)}
      WHEN ({two('t')}) AND {suffix_length(2)} > 0 THEN 2 + {suffix_length(2)}
      WHEN ({three('u')}) AND {suffix_length(3)} > 0 THEN 3 + {suffix_length(3)}
      WHEN ({two('u')}) AND {suffix_length(2)} > 0 THEN 2 + {suffix_length(2)} ELSE 0 END AS len
    FROM {classes('t0', NO_CLINIC)} WINDOW doc AS (PARTITION BY doc_id ORDER BY pos)) WHERE len > 0),
{picked('clin', 'clin')},
t1 AS MATERIALIZED (
  SELECT t.doc_id, t.pos, gb, ga, CASE WHEN c.pos IS NULL THEN word ELSE {NTAG} END AS word,
    m_name AND c.pos IS NULL AS m_name FROM t0 t LEFT JOIN clin_cover c USING (doc_id, pos)),
lastfirst AS MATERIALIZED (
  SELECT doc_id, pos, len FROM (SELECT doc_id, pos, CASE
      WHEN {lf('u', 'u', f"({at('u', 2)} OR {at('i1', 2)})")} THEN 3
      WHEN {lf('t', 't', f"{at('t', 2)} AND {NOT_AT}")} THEN 3
      WHEN {lf('e', 'e', at('i1', 2))} THEN 3
      WHEN {lf('u', 'u')} THEN 2 WHEN {lf('t', 't')} THEN 2 ELSE 0 END AS len
    FROM {classes('t1', NO_CUT)} WINDOW doc AS (PARTITION BY doc_id ORDER BY pos)) WHERE len > 0),
{picked('lastfirst', 'lastfirst')},
lf_named AS MATERIALIZED (
  SELECT doc_id, start FROM lastfirst_cover JOIN t1 USING (doc_id, pos) GROUP BY ALL HAVING bool_or(m_name)),
lf_mask AS (SELECT doc_id, pos FROM lastfirst_cover JOIN lf_named USING (doc_id, start)),
lf_spans AS MATERIALIZED (
  SELECT DISTINCT doc_id, s, len FROM (
    SELECT c.doc_id, c.start, count(*) AS len,
      string_agg(CASE WHEN c.pos = c.start THEN '' ELSE gb END || lower(word), '' ORDER BY c.pos) AS s
    FROM lastfirst_cover c JOIN lf_named USING (doc_id, start) JOIN t1 USING (doc_id, pos) GROUP BY c.doc_id, c.start)),
t2_once AS MATERIALIZED (
  SELECT t.doc_id, t.pos, gb, ga, CASE WHEN c.pos IS NULL THEN word ELSE {NTAG} END AS word,
    m_name AND c.pos IS NULL AS m_name FROM t1 t LEFT JOIN lf_mask c USING (doc_id, pos)),
lf_again AS MATERIALIZED (
  SELECT g.doc_id, g.pos, max(s.len) AS len FROM (
    SELECT doc_id, pos, lower(word) || ga || lower({lead('word', 1)}) AS s2,
      lower(word) || ga || lower({lead('word', 1)}) || {lead('ga', 1)} || lower({lead('word', 2)}) AS s3
    FROM t2_once WINDOW doc AS (PARTITION BY doc_id ORDER BY pos)) g
  JOIN lf_spans s ON s.doc_id = g.doc_id AND ((s.len = 2 AND s.s = g.s2) OR (s.len = 3 AND s.s = g.s3))
  GROUP BY g.doc_id, g.pos),
{picked('lf_again', 'lf_again')},
t2 AS MATERIALIZED (
  SELECT t.doc_id, t.pos, gb, ga, CASE WHEN c.pos IS NULL THEN word ELSE {NTAG} END AS word,
    m_name AND c.pos IS NULL AS m_name FROM t2_once t LEFT JOIN lf_again_cover c USING (doc_id, pos)),
role AS MATERIALIZED (
  SELECT doc_id, pos, 2 AS len FROM (SELECT doc_id, pos, gb, lag(word) OVER doc AS before,
      (u AND {gap(0, THIRD)} AND {at('u', 1)}) OR (t AND {gap(0, THIRD)} AND {at('t', 1)}) AS pair
    FROM {classes('t2', NO_CUT)} WINDOW doc AS (PARTITION BY doc_id ORDER BY pos))
  WHERE pair AND regexp_matches(gb, {rx(COMMA)}) AND {member('lower(before)', CUTOFFS)}),
{picked('role', 'role')},
role_named AS MATERIALIZED (
  SELECT doc_id, start FROM role_cover JOIN t2 USING (doc_id, pos) GROUP BY ALL HAVING bool_or(m_name)),
role_mask AS (SELECT doc_id, pos FROM role_cover JOIN role_named USING (doc_id, start)),
t3 AS MATERIALIZED (
  SELECT t.doc_id, t.pos, gb, ga, CASE WHEN c.pos IS NULL THEN word ELSE {NTAG} END AS word,
    m_name AND c.pos IS NULL AS m_name FROM t2 t LEFT JOIN role_mask c USING (doc_id, pos)),
titled AS MATERIALIZED (
  SELECT DISTINCT doc_id, lower(nxt) AS word FROM (
    SELECT doc_id, word, ga, lead(word) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM t3)
  WHERE {member('word', ['Dr', 'Mr', 'Mrs', 'Ms'])} AND regexp_matches(ga, '^\\.?\\s$')
    AND regexp_matches(nxt, '^[A-Z][a-zA-Z]*$') AND NOT {member('nxt', TAGS2)}),
t4 AS MATERIALIZED (
  SELECT t.doc_id, pos, gb, ga, CASE WHEN k.word IS NULL THEN t.word ELSE {NTAG} END AS word,
    m_name AND k.word IS NULL AS m_name
  FROM t3 t LEFT JOIN titled k ON k.doc_id = t.doc_id AND k.word = lower(t.word)),
t5 AS MATERIALIZED (
  SELECT doc_id, pos, gb, ga, CASE WHEN hit THEN {NTAG} ELSE word END AS word, m_name AND NOT hit AS m_name
  FROM (SELECT *, m_name AND regexp_matches(word, '^\\p{{Lu}}') AND
    (length(word) > 1 OR regexp_matches(ga, '^[''.-]')) AS hit FROM t4)),
{text_of('dictionary_text', 't5', 'address_text')},
mid_tokens AS MATERIALIZED (
  SELECT doc_id, i, tok, lag(tok) OVER d AS before, lead(tok) OVER d AS behind FROM (
    SELECT doc_id, unnest(range(len(ts))) AS i, unnest(ts) AS tok
    FROM (SELECT doc_id, string_split(text, ' ') AS ts FROM dictionary_text))
  WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
middle_text AS MATERIALIZED (
  SELECT doc_id, string_agg(CASE WHEN contains(before, {NTAG}) AND contains(behind, {NTAG})
      AND NOT {member('tok', TAGS2)} AND regexp_matches(tok, '^\\p{{Lu}}')
      AND (regexp_matches(tok, '^\\p{{L}}+$') OR contains(tok, '.'))
    THEN regexp_replace(tok, {rx(W + '+')}, {NTAG}) ELSE tok END, ' ' ORDER BY i) AS text
  FROM mid_tokens GROUP BY doc_id),
{words('w3', 'middle_text')},
t6 AS MATERIALIZED (
  SELECT w.doc_id, w.pos, w.gb, w.ga, w.word, m_name AND t.word = w.word AS m_name
  FROM w3 w JOIN t5 t USING (doc_id, pos)),
t7 AS MATERIALIZED (
  SELECT doc_id, pos, gb, ga, CASE WHEN
      (ga = '-' AND (named OR coalesce(lead(named) OVER d, false)) AND lead(pos) OVER d IS NOT NULL)
      OR (gb = '-' AND (named OR coalesce(lag(named) OVER d, false)) AND lag(pos) OVER d IS NOT NULL)
    THEN {NTAG} ELSE word END AS word
  FROM (SELECT *, word = {NTAG} OR m_name AS named FROM t6) WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
{text_of('hyphen_text', 't7', 'address_text')},
t8 AS MATERIALIZED (
  SELECT doc_id, pos, gb, CASE WHEN bool_or(contains(word, {NTAG})) OVER (PARTITION BY doc_id, piece)
      AND NOT (gb LIKE '%''' AND length(word) < 3) THEN {NTAG} ELSE word END AS word
  FROM (SELECT *, sum(CASE WHEN regexp_matches(gb, {rx(f'[{S_}]')}) THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id ORDER BY pos) AS piece FROM t7)),
{text_of('name_text', 't8', 'address_text')}"""

# --- Pattern masks ------------------------------------------------------------------------
NOT_WWW3 = (
    r"(?:[a-vx-zA-Z0-9][a-zA-Z0-9-]+[a-zA-Z0-9]|w[a-vx-zA-Z0-9-][a-zA-Z0-9-]*[a-zA-Z0-9]"
    r"|ww[a-vx-zA-Z0-9-][a-zA-Z0-9-]*[a-zA-Z0-9]|ww[a-vx-zA-Z0-9])"
)
NOT_WWW1 = r"(?:[a-vx-zA-Z0-9][a-zA-Z0-9]*|ww?|ww?[a-vx-zA-Z0-9][a-zA-Z0-9]*)"
HOST3 = r"[a-zA-Z0-9][a-zA-Z0-9-]+[a-zA-Z0-9]"
URL = (
    rf"https?://(?:www\.{HOST3}|{NOT_WWW3})\.\S{{2,}}|www\.{HOST3}\.\S{{2,}}"
    rf"|https?://(?:www\.[a-zA-Z0-9]+|{NOT_WWW1})\.\S{{2,}}|www\.[a-zA-Z0-9]+\.\S{{2,}}"
)
SSN_PLAIN, ACCOUNT = r"\b[0-9]{9}\b", r"\b[0-9]{8}\b"


def sub(x: str, pattern: str, tag: str) -> str:
    return f"regexp_replace({x}, {rx(pattern)}, {q(tag)}, 'g')"


def email(x: str) -> str:
    return sub(x, C.EMAIL_PATTERN, C.EMAIL_TAG)


def ssn(x: str) -> str:
    return sub(sub(x, C.SSN_DASHED_PATTERN, C.SSN_TAG), SSN_PLAIN, C.SSN_TAG)


def phone(x: str) -> str:
    return masked(x, C.PHONE_PATTERN, r"\S+", C.PHONE_TAG)


def late(x: str) -> str:
    return sub(sub(sub(x, URL, C.URL_TAG), C.IP_PATTERN, C.IP_TAG), ACCOUNT, C.ACCOUNT_TAG)


PATTERNS = f"""ssn_text AS MATERIALIZED (SELECT doc_id, {ssn(email('text'))} AS text FROM name_text),
phone_text AS MATERIALIZED (SELECT doc_id, {phone('text')} AS text FROM ssn_text),
masked_text AS MATERIALIZED (SELECT doc_id, {late('text')} AS text FROM phone_text)"""

# --- Tokens and labels --------------------------------------------------------------------
TAG_ALT = "|".join(sorted(C.TAGS, key=lambda t: (-len(t), t)))


def collapse(x: str) -> str:
    return f"regexp_replace({x}, ' +', ' ', 'g')"


def own_spaced(x: str) -> str:
    return f"regexp_replace({x}, {rx(SPECIAL)}, '  \\0  ', 'g')"


def spaced(raw: str, mask: str) -> str:
    held = (
        f"list_reduce(list_sort(list_distinct(regexp_extract_all(p[2], {rx(SPECIAL)}))),"
        f" lambda acc, c: replace(acc, c, '  ' || c || '  '), p[1])"
    )
    token = f"CASE WHEN p[1] = p[2] THEN {own_spaced('p[1]')} ELSE {held} END"
    pairs = f"list_zip(string_split({raw}, ' '), string_split({mask}, ' '))"
    joined = f"array_to_string(list_transform({pairs}, lambda p: {token}), ' ')"
    same_count = f"len(string_split({raw}, ' ')) = len(string_split({mask}, ' '))"
    return f"CASE WHEN {same_count} THEN {collapse(joined)} ELSE {q(C.LENGTH_ERROR_TEXT)} END"


def clean(x: str) -> str:
    pattern = r"[\r,\n\t\[\]]"
    return f"trim({collapse(f'regexp_replace({x}, {rx(pattern)}, chr(32), chr(103))')}, ' ')"


def cleaned_mask(x: str) -> str:
    return collapse(own_spaced(clean(x)))


def raw_labels(x: str) -> str:
    """Per word run or special character: the tag itself, or O."""
    joined = f"regexp_replace({x}, {rx(f'{chr(39)}(?:{TAG_ALT}|[a-zA-Z]{{0,2}})')}, '', 'g')"
    parts = f"regexp_extract_all({joined}, {rx(f'{W}+|{SPECIAL}')})"
    label = f"CASE WHEN {member('t', C.TAGS)} THEN t ELSE 'O' END"
    return f"array_to_string(list_transform({parts}, lambda t: {label}), ' ')"


def labels(x: str) -> str:
    parts = f"list_filter(string_split({x}, ' '), lambda t: t <> '')"
    shifted = f"list_prepend('', {parts})"
    label = "CASE WHEN p[1] = 'O' THEN 'O' WHEN p[1] = p[2] THEN 'I-' || p[1] ELSE 'B-' || p[1] END"
    pairs = f"list_zip({parts}, {shifted}, true)"
    return f"array_to_string(list_transform({pairs}, lambda p: {label}), ' ')"


ALPHABET = ["O"] + [f"{p}-{t}" for t in C.TAGS for p in "BI"]


def code(x: str) -> str:
    parts = f"regexp_extract_all({x}, {rx(f'[^{S_}]+')})"
    bad = f"len(list_filter({parts}, lambda t: NOT {member('t', ALPHABET)})) > 0"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN 5 WHEN {bad} THEN 2 ELSE 1 END"


def count(x: str) -> str:
    return f"len(regexp_extract_all({x}, {rx(f'[^{S_}]+')}))"


TAIL = f"""labelled AS MATERIALIZED (
  SELECT doc_id, text, masked, {clean(spaced('text', 'masked'))} AS cleaned, {cleaned_mask('masked')} AS masked_tokens
  FROM (SELECT u.doc_id, u.text, m.text AS masked FROM usable u JOIN masked_text m USING (doc_id))),
iob_rows AS MATERIALIZED (SELECT *, {raw_labels('masked_tokens')} AS iob_raw FROM labelled),
annotated AS MATERIALIZED (
  SELECT *, {code('iob')} AS label_code, {count('cleaned')} AS length_text, {count('iob')} AS length_labels,
    {count('cleaned')} = {count('iob')} AS equal
  FROM (SELECT *, {labels('iob_raw')} AS iob FROM iob_rows))"""

BASE = [NOTES, RAW, GAZETTEERS]
CHAIN = [*BASE, LOOKUP, ADDRESS, NAMES, PATTERNS, TAIL]


def with_chain(parts: list[str], select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select
