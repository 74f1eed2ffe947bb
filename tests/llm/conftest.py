import pytest
from pyspark.sql import types as T

DOC = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    ]
)

#: Null and empty texts, a null id, one letter, blanks only, a repeated row, characters of several bytes.
ODD = [
    (1, None), (2, ""), (3, "a"), (4, " \t\n"), (5, "x y z w v"), (5, "x y z w v"), (None, "null id " * 30), (6, "ÄÖÜ ß 日本 😀 é"),
    (7, "﷐ ▁ \x00   end"), (8, None),
]


@pytest.fixture(scope="session")
def documents(spark):
    def build(rows, source="s", lang="en", **extra):
        full = [(i, t, lang, source[i] if isinstance(source, dict) else source, None if t is None else len(t)) for i, t in rows]
        frame = spark.createDataFrame(full, DOC)
        for name, value in extra.items():
            frame = frame.selectExpr("*", f"{value} AS `{name}`")
        return frame

    return build


@pytest.fixture(scope="session")
def odd(documents):
    """Odd rows, with further columns whose names the operators use themselves."""
    return documents(ODD, key="1", score="2", size="3", chunk="4", name="'n'", n="5", label="6")


@pytest.fixture(scope="session")
def table(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
