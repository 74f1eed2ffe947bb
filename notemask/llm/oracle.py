"""DuckDB SQL of the corpus queries that SQL can express."""

OP4 = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS i FROM d)),
m AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
gone AS (
  SELECT DISTINCT doc_id, i + k AS b
  FROM (SELECT doc_id, i FROM w JOIN m USING (s) WHERE doc_id > first), (SELECT unnest(range(0, 50)) AS k)),
runs AS (
  SELECT doc_id, count(*) AS n_spans, sum(n)::BIGINT AS n_removed, string_agg(a || ':' || (a + n), ',' ORDER BY a) AS removed
  FROM (
    SELECT doc_id, min(b) AS a, count(*) AS n
    FROM (SELECT doc_id, b, b - row_number() OVER (PARTITION BY doc_id ORDER BY b) AS r FROM gone) GROUP BY doc_id, r)
  GROUP BY doc_id),
bytes AS (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS b FROM d),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * b + 1, 2), '' ORDER BY b) AS k
  FROM bytes ANTI JOIN gone USING (doc_id, b) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(k, ''))) AS kept_sha256, coalesce(removed, '') AS removed
FROM d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP6 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, ((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1)::DOUBLE AS weight,
    (3 * source_size)::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE AS total FROM s),
r AS (
  SELECT *, sum(weight) OVER () AS weights, coalesce(sum(cap) OVER b, 0) AS capped, coalesce(sum(weight) OVER b, 0) AS used
  FROM w
  WINDOW b AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (total - capped) / (weights - used) AS level, cap > (total - capped) / (weights - used) * weight AS free FROM r),
t AS (
  SELECT source, source_size,
    CASE WHEN free THEN (SELECT arg_min(level, (cap / weight, source IS NULL, source)) FROM l WHERE free) * weight ELSE cap END
      AS target FROM l),
k AS (
  SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || size)
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END * size
   + greatest(0, least(size, floor(target)::BIGINT
     - CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END * source_size - before)))::BIGINT AS taken
FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
"""

OP9 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n
  FROM (SELECT doc_id, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 1))) AS i FROM d))),
rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM g, (SELECT unnest(range(0, 3)) AS k) WHERE n > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(regexp_replace(text, '[^A-Za-z\x{C0}-\x{10FFFF}]+', '', 'g')) AS n_letters,
    length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper
  FROM d LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)),
f AS (
  SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > 3 * n_words)::INT
    + 8 * (100 * n_dup_lines > 60 * n_lines)::INT + 16 * (word_chars > 100 * n_words)::INT
    + 32 * (word_chars < 2 * n_words)::INT + 64 * (10 * n_upper > 8 * n_letters AND n_letters > 0)::INT
    + 128 * (10 * n_letters < 5 * word_chars)::INT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, failed_bits = 0 AS kept, failed_bits FROM f
"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b, o, x.n AS na, y.n AS nb FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * o >= 80 * (x.n + y.n - o)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a),
e AS (SELECT a AS doc_id, min(b) AS other FROM links WHERE o = na AND o = nb GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS class_id, component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN e USING (doc_id) JOIN c USING (doc_id)
"""
