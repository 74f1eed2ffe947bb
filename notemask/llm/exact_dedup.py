"""Exact duplicates by deterministic block naming.

A text without blanks is cut into blocks of fixed size. Equal blocks get one integer name, then pairs of neighbouring
names are named again and again, until each document has a single name. Names are never hashes: a name is the place
(first document and block) where that content occurs first, found by grouping on the content itself, so two documents
have one name if and only if they have one content.

A 64-bit hash only says where there is nothing to name: a block whose hash occurs once in the corpus is the first and
only one of its content, and so is its document. All steps are aggregations and joins of Spark; groups are reduced
before every shuffle, and a name that a third of all rows share is one row to join them with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BLANKS, table, written

#: Code points of a block.
BLOCK = 4096


def normalised(text: Column) -> Column:
    """The text without blanks; null counts as empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), BLANKS + "+", "")


def blocks(text: Column, size: int = BLOCK) -> Column:
    """The blocks of a text; an empty text has one empty block."""
    n = F.greatest(F.lit(1), F.ceil(F.char_length(text) / size)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(text, i * size + 1, F.lit(size)))


def _same(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Join on columns of one name in which null equals null; the right side's are dropped."""
    renamed = right.select(*(F.col(c).alias(f"_{c}") if c in on else F.col(c) for c in right.columns))
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_{c}"))
    joined = left.join(renamed, condition, how)
    return joined if how == "left_semi" else joined.drop(*(f"_{c}" for c in on))


def rows_of(docs: DataFrame) -> DataFrame:
    """key (of the row), doc_id, n_points, norm. The key tells apart rows that share a doc_id but not the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select("doc_id", text.alias("text")).withColumn("norm", normalised(F.col("text")))
    return base.select(
        F.xxhash64("doc_id", "text").alias("key"), "doc_id", F.char_length("text").alias("n_points"), "norm"
    )


def named(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """doc_id, key, first_id, first_key: each distinct (doc_id, key) with the name of its content.

    A document's name is the least (doc_id, key) that has its content, null ids first."""
    rows = rows_of(docs)
    mark = ["doc_id", "key"]
    hashed = rows.select(*mark, F.transform(blocks(F.col("norm"), size), lambda b: F.xxhash64(b)).alias("hashes"))
    # repeated rows of one id are one here
    hashed = written(hashed.groupBy(*mark).agg(F.first("hashes").alias("hashes")), "block-hashes")
    parts = hashed.select(*mark, F.posexplode("hashes").alias("i", "h"))
    often = parts.groupBy("h").count().filter("count > 1").select("h")
    # documents all of whose blocks occur again somewhere; each of the others is the only one of its content
    again = _same(parts, often, ["h"], "left_semi").groupBy(*mark).agg(F.count("*").alias("n"))
    again = _same(hashed.select(*mark, F.size("hashes").alias("n_blocks")), again, mark, "inner")
    again = written(again.filter("n = n_blocks").select(*mark, "n_blocks"), "to-name")
    places = _block_names(rows, again, size)
    most = again.agg(F.max("n_blocks")).first()[0] or 0
    while most > 1:
        places, most = _pair_names(places), (most + 1) // 2
    name = places.select(*mark, F.col("name.doc_id").alias("first_id"), F.col("name.key").alias("first_key"))
    single = _without(hashed.select(*mark), again)
    return single.select(*mark, F.col("doc_id").alias("first_id"), F.col("key").alias("first_key")).unionByName(name)


def _without(rows: DataFrame, other: DataFrame) -> DataFrame:
    """Rows whose doc_id and key don't occur in the other table."""
    renamed = other.select(F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key"))
    return rows.join(renamed, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("key") == F.col("_key")), "left_anti")


def _block_names(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """doc_id, key, i, name of the blocks of the wanted documents; a name is the first place of the block's content."""
    mark = ["doc_id", "key"]
    # texts are moved to the ids that want them at every size of the table, so the plan doesn't change as it grows
    texts = _same(rows.select(*mark, "norm"), wanted.select(*mark).hint("merge"), mark, "left_semi")
    texts = texts.select(*mark, F.posexplode(blocks(F.col("norm"), size)).alias("i", "block"))
    parts = written(texts.select(*mark, "i", F.xxhash64("block").alias("h"), "block"), "blocks").dropDuplicates([*mark, "i"])
    place = F.struct(*mark, "i")
    # h goes first, so that the sort and the comparison of blocks seldom look at the texts
    names = parts.groupBy("h", "block").agg(F.min(place).alias("name"))
    return written(_same(parts, names, ["h", "block"], "inner").select(*mark, "i", "name"), "names")


def _pair_names(places: DataFrame) -> DataFrame:
    """The next round: places 2i and 2i + 1 of a document become place i, named by the first place of that pair."""
    mark = ["doc_id", "key"]
    half = F.shiftright("i", 1)
    side = lambda s: F.max(F.when(F.col("i").bitwiseAND(F.lit(1)) == s, F.col("name")))
    pairs = places.groupBy(*mark, half.alias("i")).agg(side(0).alias("a"), side(1).alias("b"))
    names = pairs.groupBy("a", "b").agg(F.min(F.struct(*mark, "i")).alias("name"))
    return written(_same(pairs, names, ["a", "b"], "inner").select(*mark, "i", "name"), "names")


def duplicates(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Of rows with equal texts (blanks apart) the one with the most code points stays, then the one with the least
    doc_id, null first; of repeated rows of that id and text one stays. Null texts count as empty and equal each
    other. group_size counts rows. Other columns don't matter; an empty table gives an empty result.
    """
    mark = ["doc_id", "key"]
    rows = rows_of(docs).select(*mark, "n_points", F.sha2("norm", 256).alias("text_sha256"))
    rows = rows.groupBy(*mark, "n_points", "text_sha256").agg(F.count("*").alias("copies"))
    rows = written(_same(rows, named(docs, size), mark, "inner"), "named")
    best = F.min(F.struct((-F.col("n_points")).alias("shorter"), "doc_id", "key")).alias("best")
    groups = rows.groupBy("first_id", "first_key").agg(F.sum("copies").alias("group_size"), best)
    found = _same(rows, groups, ["first_id", "first_key"], "inner")
    stays = F.col("best.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("best.key") == F.col("key"))
    found = found.withColumn("place", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return found.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (stays & (F.col("place") == 1)).alias("kept"),
        "text_sha256", "key", "copies",
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with all its columns, whatever their names."""
    kept = duplicates(docs).filter("kept").select(F.col("doc_id").alias("kept_id"), F.col("key").alias("kept_key"), "copies")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    rows = rows.select("row", F.col("row.doc_id").alias("doc_id"), F.xxhash64("row.doc_id", text).alias("key"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    found = rows.join(kept.hint("merge"), same)
    # repeated rows of one id and text are rare; only they are grouped once more
    repeated = found.filter("copies > 1").dropDuplicates(["doc_id", "key"])
    return found.filter("copies = 1").unionByName(repeated).select("row.*")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of equal texts of every document."""
    return duplicates(table(spark, sf_dir, "documents")).drop("key", "copies")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[ \x09-\x0D]+', '', 'g') AS norm FROM documents),
g AS (
  SELECT norm, count(*) AS group_size, arg_min(doc_id, struct_pack(a := -n, b := doc_id)) AS keep_id FROM d GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM d JOIN g USING (norm)
"""
