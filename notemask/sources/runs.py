"""Tables written in runs: a run that is killed and repeated counts once.

A folder holds ``data``, with a folder per attempt, and ``runs``, with a line per finished attempt. The line is written
last, by one task into one file, so an attempt counts as a whole or not at all; if several attempts of a run finished,
the last one counts. Nothing is renamed or deleted, so the folder may lie in an object store, and readers that started
before a run was repeated keep their files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ATTEMPT = "run_attempt"
FINISHED = f"run string, {ATTEMPT} string, n_rows long, finished_at timestamp"
ROWS_PER_FILE = 1_000_000


def write_run(rows: DataFrame, folder: str, run: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write one run and give its number of rows; the same run written again takes the place of the first.

    No file has more than ``rows_per_file`` rows. A run without rows is a run too. ``run_attempt`` is no name for a column.
    """
    if ATTEMPT in rows.columns:
        raise ValueError(f"the column {ATTEMPT} is taken by the folders of attempts")
    attempt = f"a-{uuid.uuid4().hex}"
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    counted.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{folder}/data/{ATTEMPT}={attempt}")
    written = int(seen.get["n"])
    finish(rows.sparkSession, folder, run, attempt, written)
    return written


def finish(spark: SparkSession, folder: str, run: str, attempt: str, n_rows: int) -> None:
    """Note that an attempt is complete."""
    line = spark.range(1, numPartitions=1).select(
        F.lit(run).alias("run"), F.lit(attempt).alias(ATTEMPT), F.lit(n_rows).cast("long").alias("n_rows"),
        F.current_timestamp().alias("finished_at"),
    )
    line.write.mode("append").json(f"{folder}/runs")


def finished_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The attempt that counts of every run: run, run_attempt, n_rows, finished_at."""
    lines = spark.read.schema(FINISHED).json(f"{folder}/runs")
    last = F.max_by(F.struct(*lines.columns), F.struct("finished_at", ATTEMPT))
    return lines.groupBy("run").agg(last.alias("last")).select("last.*")


def read_runs(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of all finished runs. Folders of other attempts are pruned before they are read, if the list of runs is
    small enough for Spark to broadcast; otherwise their rows are joined away."""
    # a condition on the list is what makes Spark prune by it
    counted = finished_runs(spark, folder).filter("n_rows > 0").select(ATTEMPT)
    every = spark.read.parquet(f"{folder}/data")
    return every.join(counted, ATTEMPT, "left_semi").drop(ATTEMPT)
