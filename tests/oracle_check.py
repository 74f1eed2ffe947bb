"""Run registered queries and their DuckDB SQL side by side: ``python tests/oracle_check.py SF_DIR [name...]``."""

from __future__ import annotations

import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(row[i] for i in order) for row in rows]
    return sorted(shown, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, connection, sf_dir: str, name: str, query, sql: str) -> str | None:
    """None if both sides agree, else a description of the difference."""
    frame = query(spark, sf_dir)
    ours = sorted_rows(frame.columns, frame.collect())
    relation = connection.sql(sql)
    theirs = sorted_rows(relation.columns, relation.fetchall())
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} != {sorted(relation.columns)}"
    if ours == theirs:
        return None
    only_ours = [r for r in ours if r not in set(theirs)]
    only_theirs = [r for r in theirs if r not in set(ours)]
    show = lambda rows: [tuple(str(v)[-160:] for v in r) for r in rows[:3]]
    return (
        f"rows {len(ours)} != {len(theirs)}; spark only {len(only_ours)} {show(only_ours)};"
        f" duckdb only {len(only_theirs)} {show(only_theirs)}"
    )


def main() -> None:
    from pyspark.sql import SparkSession

    from notemask.plans.queries import ORACLE, QUERIES

    sf_dir, chosen = sys.argv[1], sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    for name in chosen:
        start = time.time()
        try:
            result = compare(spark, connection, sf_dir, name, QUERIES[name], ORACLE[name])
        except Exception as error:
            result = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name}: {'ok' if result is None else result} ({time.time() - start:.1f}s)", flush=True)


if __name__ == "__main__":
    main()
