"""Reading lookup files and notes, writing label rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CITY_COLUMNS = ["City", "State_code", "State_full", "County", "City alias"]
EXTRA_CITY_COLUMNS = ["Id", "State_code", "State_full", "City", "County", "LATITUDE", "LONGITUDE"]


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """Names: comma-separated, with a header and a ``name`` column."""
    return spark.read.option("header", True).csv(path).select("name")


def read_states(spark: SparkSession, path: str) -> DataFrame:
    """States: one column, no header."""
    schema = StructType([StructField("state", StringType(), True)])
    return spark.read.schema(schema).option("header", False).csv(path)


def read_zips(spark: SparkSession, path: str) -> DataFrame:
    """ZIP codes, kept as strings so that leading zeros survive."""
    return spark.read.option("header", True).csv(path).select("ZIP")


def read_cities(spark: SparkSession, path: str) -> DataFrame:
    """Cities with state and county: pipe-delimited, columns named by position."""
    return (
        spark.read.option("header", True).option("delimiter", "|").csv(path).toDF(*CITY_COLUMNS)
    )


def read_extra_cities(spark: SparkSession, path: str) -> DataFrame:
    """Further cities: comma-separated, latin1, columns named by position."""
    reader = spark.read.option("header", True).option("encoding", "ISO-8859-1")
    return reader.csv(path).toDF(*EXTRA_CITY_COLUMNS)


@dataclass(frozen=True)
class FileFormat:
    """How a lookup file is laid out: columns by position, separator, header, encoding."""

    columns: tuple[str, ...]
    delimiter: str = ","
    header: bool = True
    encoding: str = "UTF-8"

    def options(self) -> dict[str, str]:
        return {"sep": self.delimiter, "header": str(self.header).lower(), "encoding": self.encoding}


#: Lookup files as they are on disk. Those of names and ZIP codes may have further columns: give their names.
FORMATS = {
    "names": FileFormat(("name",)),
    "states": FileFormat(("state",), header=False),
    "zips": FileFormat(("ZIP",)),
    "cities": FileFormat(tuple(CITY_COLUMNS), delimiter="|"),
    "extra_cities": FileFormat(tuple(EXTRA_CITY_COLUMNS), encoding="ISO-8859-1"),
}
BAD_LINE = "bad_line"


def read_checked(spark: SparkSession, path: str, layout: FileFormat) -> DataFrame:
    """All lines of a lookup file: its columns as strings, and ``bad_line`` with the line itself where it has more or
    fewer fields than the layout (null for good lines). No line is lost and none stops the reader; empty lines are none.
    """
    fields = [StructField(c, StringType(), True) for c in (*layout.columns, BAD_LINE)]
    reader = spark.read.schema(StructType(fields)).options(**layout.options(), mode="PERMISSIVE")
    lines = reader.option("columnNameOfCorruptRecord", BAD_LINE).csv(path)
    # Spark counts the fields of a line only if all columns are read, so no characters of all of them are added
    none = F.substring(F.concat_ws("", *(F.col(f"`{c}`") for c in layout.columns)), 1, 0)
    return lines.withColumn(BAD_LINE, F.concat(BAD_LINE, none))


def good_lines(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def quarantined(lines: DataFrame) -> DataFrame:
    """The bad lines of a file, with the file that each came from."""
    return lines.filter(F.col(BAD_LINE).isNotNull()).select(F.input_file_name().alias("file"), BAD_LINE)


def load_checked(spark: SparkSession, path: str, layout: FileFormat, quarantine: str) -> tuple[DataFrame, dict[str, int]]:
    """The good lines of a lookup file, its bad ones written to ``quarantine`` as text, and how many there are of each.

    One scan writes the bad lines and counts all of them on the way.
    """
    lines = read_checked(spark, path, layout)
    seen = Observation()
    bad = F.count_if(F.col(BAD_LINE).isNotNull())
    counted = lines.observe(seen, F.count("*").alias("lines"), bad.alias("bad"))
    quarantined(counted).write.mode("overwrite").json(quarantine)
    return good_lines(lines), dict(seen.get)


def write_lookup(rows: DataFrame, path: str, layout: FileFormat, mode: str = "errorifexists") -> None:
    """Rows as a lookup file of that layout; the number of columns is that of the rows."""
    rows.write.mode(mode).options(**layout.options()).csv(path)


def read_notes(spark: SparkSession, path: str, id_col: str, text_col: str) -> DataFrame:
    """Notes from parquet; only the id and the text are read."""
    return spark.read.parquet(path).select(id_col, text_col)


def write_labels(
    labelled: DataFrame, path: str, mode: str = "errorifexists", partition_by: str | None = None
) -> None:
    """Write label rows as parquet, optionally one folder per value of a column."""
    writer = labelled.write.mode(mode)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def sample_rows(rows: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows for a look at the data."""
    return rows.limit(n)
