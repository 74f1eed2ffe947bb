"""Time the headline queries: prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from notemask.plans import fixtures
from notemask.plans.queries import QUERIES

HEADLINE = [
    "mask_email", "mask_phone", "mask_url", "mask_ip", "special_locations", "space_specials",
    "bio_labels", "size_check", "city_states", "token_name_matches", "multiword_city_matches",
    "normalize_address_tags", "normalize_name_tags", "label_validation_counts", "dedup_cleaned",
    "tag_notes",
]


def in_files(spark: SparkSession, sf_dir: str, files: int) -> str:
    """The tables with ``documents`` in several files, as a large table has them.

    The given file is one row group, which Spark reads with one core however many there are.
    """
    folder = tempfile.mkdtemp(prefix="notemask-bench-")
    for name in os.listdir(sf_dir):
        if name != "documents.parquet":
            os.symlink(os.path.join(sf_dir, name), os.path.join(folder, name))
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    documents.repartition(files).write.parquet(f"{folder}/documents.parquet")
    return folder


def main() -> None:
    given = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("notemask-bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus) if cpus.isdigit() else 16))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = in_files(spark, given, 2 * int(cpus) if cpus.isdigit() else 16)
    documents = fixtures.table(spark, sf_dir, "documents")
    notes, text_bytes = documents.select(F.count("*"), F.sum(F.octet_length("text"))).first()
    start = time.perf_counter()
    fixtures.lexicon(spark, sf_dir)
    lexicon_seconds = round(time.perf_counter() - start, 3)
    print("lexicon", lexicon_seconds, file=sys.stderr, flush=True)
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(given)).removeprefix("sf"),
                "notes": notes,
                "lexicon_seconds": lexicon_seconds,
                "tag_notes_per_second": round(notes / seconds["tag_notes"], 1),
                "tag_notes_mb_per_core_second": round(
                    text_bytes / 1e6 / seconds["tag_notes"] / (int(cpus) if cpus.isdigit() else os.cpu_count()), 3
                ),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
