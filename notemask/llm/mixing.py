"""Mixing sources to target weights with exact budgets.

Every document gets a hash-random key. Within a source, documents are ordered by that key in ranges of the key space,
so that the words before a document are the words of the earlier ranges (one small table) plus those before it in its
own range. No task sees a whole source. A source whose budget exceeds its size is taken in whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANKS, WORD, table, written

#: Ranges of the key space within each source: hexadecimal digits of the key.
RANGE_DIGITS = 3

#: Weights that the sources get in turn, and how many times its own size a source may be taken.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3


def n_words(text: Column) -> Column:
    """Words of a text; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, target.

    `sizes` has source and source_size, one row per source. Weights go round the sources in code-point order, null
    last. A source at its cap (`most` times its size) gives its excess to the others by weight. The caps that bind are
    those of the sources with the least cap per weight: with the sources in that order, prefix sums give the level of
    the rest after each, and the first level that no remaining cap is below is the answer. Only this table of one
    short row per source is ordered as a whole. Sources without words have target 0.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "UTF-8"))
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % n + 1).cast("int")).cast("double")
    rows = sizes.withColumn("weight", weight).withColumn("cap", (most * F.col("source_size")).cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = (
        rows.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("used", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("capped")) / (F.col("weights") - F.col("used")))
        .withColumn("free_level", F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level")))
    )
    level = F.first("free_level", ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return rows.withColumn("at", level).select(
        "source",
        "source_size",
        F.when(F.col("free_level").isNull() | F.col("at").isNull(), F.col("cap"))
        .otherwise(F.col("at") * F.col("weight"))
        .alias("target"),
    )


def mix(sized: DataFrame, seed: str = "mix", digits: int = RANGE_DIGITS, tie: str | None = None) -> DataFrame:
    """Words taken of every document: columns of `sized` (doc_id, source, size, ...) plus source_size, target, taken.

    Keys are MD5 of seed, doc_id and size, so that reruns agree and equal rows lie next to each other. The budget of a
    source is its target, rounded down: whole epochs of everything, then one more pass in key order that stops at the
    budget exactly, inside a document if need be. Documents without words take nothing. Null sources are a source of
    their own; repeated rows are documents of their own; of rows with equal keys the one with the least `tie` comes
    first, any without it: they have equal sizes. An empty table gives an empty result.
    """
    key = F.md5(F.encode(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "size"), "UTF-8"))
    keyed = sized.withColumn("key", key).withColumn("range", F.substring("key", 1, digits))
    ranges = keyed.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    goal = targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("source", "range", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source", "range").orderBy("key", *([tie] if tie else [])).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = _join(placed, offsets, ["source", "range"])
    placed = _join(placed, goal, ["source"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor("target") - epochs * F.col("source_size") - F.col("offset") - F.col("inside")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return placed.withColumn("taken", taken.cast("long")).drop("key", "range", "offset", "inside")


def _join(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join in which null equals null; the keys appear once."""
    renamed = right.select(*(F.col(x).alias(f"_{x}") if x in on else F.col(x) for x in right.columns))
    condition = F.lit(True)
    for x in on:
        condition = condition & F.col(x).eqNullSafe(F.col(f"_{x}"))
    return left.join(renamed, condition).drop(*(f"_{x}" for x in on))


def sized_documents(docs: DataFrame) -> DataFrame:
    """doc_id, source, size of every document, written once: counting words is the only step that reads texts."""
    sizes = docs.select("doc_id", F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"))
    return written(sizes, "sizes")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word."""
    words = F.regexp_extract_all(text, F.lit(f"({BLANKS}*{WORD})"))
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself, with the columns of `docs`: one row for each time that a document is taken; the copy in which
    a source's budget ends is cut after its last taken word. Documents of which nothing is taken don't appear.

    Rows of one doc_id, source and text are one unit of the mix; what is taken of a unit goes to its rows in turn, so
    that each source's words are its budget exactly, whatever rows repeat and whatever ids are null. Columns may have
    any names.
    """
    source = F.col("row.source").cast("string")
    text = F.col("row.text").cast("string")
    # length prefixes keep units of different rows apart
    shown = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))
    unit = F.md5(F.encode(F.concat(shown(F.col("row.doc_id").cast("string")), shown(source), shown(text)), "UTF-8"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    number = F.col("row.doc_id").cast("string").alias("id")
    rows = rows.select("row", unit.alias("unit"), number, source.alias("source"), n_words(text).alias("size"))
    units = rows.groupBy("unit", "id", "source", "size").agg(F.count("*").alias("n"))
    named = F.coalesce(F.col("id"), F.col("unit")).alias("doc_id")  # rows without id have keys of their own too
    sized = written(units.select("unit", named, "source", (F.col("n") * F.col("size")).alias("size")), "sizes")
    whole = F.greatest(F.col("size"), F.lit(1))  # Spark may divide before it filters
    plan = mix(sized, seed, tie="unit").filter("taken > 0").select(
        F.col("unit").alias("of"), F.floor(F.col("taken") / whole).alias("epochs"), (F.col("taken") % whole).alias("rest")
    )
    place = F.row_number().over(Window.partitionBy("unit").orderBy("unit")) - 1
    found = rows.withColumn("place", place).join(plan.hint("merge"), F.col("unit") == F.col("of"))
    own = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - F.col("place") * F.col("size")))
    found = found.withColumn("taken", F.col("epochs") * F.col("size") + own).filter("taken > 0")
    times = F.sequence(F.lit(1), F.ceil(F.col("taken") / whole).cast("int"))
    copies = found.withColumn("time", F.explode(times))
    left = F.col("taken") - (F.col("time") - 1) * F.col("size")
    cut = F.when(left >= F.col("size"), F.col("row.text")).otherwise(first_words(F.col("row.text"), left))
    return copies.withColumn("cut", cut).select(
        *(F.col("cut").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns)
    )


def op6(spark, sf_dir: str) -> DataFrame:
    """The mix of all documents by weights 1, 2, 3 in turn."""
    mixed = mix(sized_documents(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
