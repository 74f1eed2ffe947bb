"""Runs that are killed and repeated, and notes that arrive as a stream."""

import glob

import pytest
from pyspark.sql import functions as F

from notemask import rejected_notes, tag_notes
from notemask.sources import runs
from notemask.streaming import notes as streams

NOTES = [
    (5, "Sarah Klein called"), (2, "Lincoln, NE is flat"), (9, "Sarah Klein called"), (1, "plain words"), (None, "lost"),
    (7, None), (8, ""), (3, "plain words"), (4, "Patient left ' early"), (6, "Dr. Norwin met Julie"),
]
SCHEMA = "note_id long, body string"


def in_files(spark, rows, folder, schema=SCHEMA):
    """A file for each row, in the order of the rows."""
    for row in rows:
        spark.createDataFrame([row], schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 5).parquet(folder)


def finish(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def same(left, right):
    return sorted(map(tuple, left.collect()), key=str) == sorted(map(tuple, right.collect()), key=str)


def test_killed_and_repeated_run_counts_once(spark, tmp_path):
    folder = str(tmp_path / "runs")
    rows = spark.range(1000).withColumn("word", F.lit("x"))
    runs.write_run(rows.filter("id < 400"), folder, "first")
    breaks = F.when(F.col("id") == 999, F.raise_error(F.lit("lost"))).otherwise("x")
    with pytest.raises(Exception, match="lost"):
        runs.write_run(rows.filter("id >= 400").withColumn("word", breaks), folder, "second")
    assert runs.read_runs(spark, folder).count() == 400
    assert runs.write_run(rows.filter("id >= 400"), folder, "second") == 600
    assert same(runs.read_runs(spark, folder), rows)
    runs.write_run(rows.filter("id < 10"), folder, "first")  # repeated with other rows: the last one counts
    assert runs.read_runs(spark, folder).count() == 610
    counts = {r["run"]: r["n_rows"] for r in runs.finished_runs(spark, folder).collect()}
    assert counts == {"first": 10, "second": 600}


def test_attempt_without_its_line_is_not_read(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "runs")
    runs.write_run(spark.range(5), folder, "007")

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(runs, "finish", killed)
        with pytest.raises(KeyboardInterrupt):
            runs.write_run(spark.range(7), folder, "8")
    assert len(glob.glob(f"{folder}/data/*")) == 2
    assert runs.read_runs(spark, folder).count() == 5


def test_folders_of_other_attempts_are_pruned(spark, tmp_path):
    folder = str(tmp_path / "runs")
    for _ in range(2):
        runs.write_run(spark.range(5), folder, "a")
    plan = runs.read_runs(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_files_are_bounded_and_empty_runs_count(spark, tmp_path):
    folder = str(tmp_path / "runs")
    runs.write_run(spark.range(0, 1000, numPartitions=1), folder, "big", rows_per_file=300)
    files = glob.glob(f"{folder}/data/*/*.parquet")
    assert len(files) == 4 and max(spark.read.parquet(f).count() for f in files) == 300
    assert runs.write_run(spark.range(0), folder, "big") == 0
    assert runs.read_runs(spark, folder).count() == 0
    with pytest.raises(ValueError, match=runs.ATTEMPT):
        runs.write_run(spark.range(1).withColumn(runs.ATTEMPT, F.lit(1)), folder, "clash")


def test_stream_gives_the_rows_of_the_batch_run(spark, seed_lexicon, tmp_path):
    notes = in_files(spark, NOTES, str(tmp_path / "notes"))
    folder, state = str(tmp_path / "checked"), str(tmp_path / "state")
    finish(streams.label_stream(notes, seed_lexicon, folder, state, "note_id", "body"))
    assert runs.finished_runs(spark, folder).count() == 2
    whole = spark.createDataFrame(NOTES, SCHEMA)
    assert same(streams.streamed_labels(spark, folder, "note_id", "body"), tag_notes(whole, seed_lexicon, "note_id", "body"))
    rejects = rejected_notes(whole, seed_lexicon, "note_id", "body")
    assert same(streams.streamed_rejects(spark, folder, "note_id"), rejects) and rejects.count() == 4


def test_repeated_batch_counts_once(spark, seed_lexicon, tmp_path, monkeypatch):
    notes = in_files(spark, NOTES[:6], str(tmp_path / "notes"))
    folder, state = str(tmp_path / "checked"), str(tmp_path / "state")
    stream = streams.label_stream(notes, seed_lexicon, folder, state, "note_id", "body")
    write = streams.write_run

    def killed(rows, where, run):
        write(rows, where, run)
        if run == "batch-1":
            raise RuntimeError("killed behind the write, before Spark notes the batch")

    monkeypatch.setattr(streams, "write_run", killed)
    with pytest.raises(Exception, match="killed"):
        finish(stream)
    monkeypatch.setattr(streams, "write_run", write)
    finish(streams.label_stream(notes, seed_lexicon, folder, state, "note_id", "body"))
    assert len(glob.glob(f"{folder}/data/*")) == 3 and runs.finished_runs(spark, folder).count() == 2
    assert sorted(r["note_id"] or 0 for r in runs.read_runs(spark, folder).collect()) == [0, 1, 2, 5, 7, 9]


@pytest.mark.parametrize("seen_at", [None, "seen_at"])
def test_lowest_ids_of_a_stream(spark, tmp_path, seen_at):
    rows = [(9, "a", 0), (4, "b", 1), (7, "a", 2), (8, "b", 30), (2, "a", 61), (6, "c", 130), (1, "b", 131), (3, "c", 200), (5, "", 201)]
    schema = "doc_id long, cleaned string, minute int"
    stream = in_files(spark, rows, str(tmp_path / "in"), schema)
    stream = stream.withColumn("seen_at", F.timestamp_seconds(F.col("minute") * 60))
    folder = str(tmp_path / "firsts")
    finish(streams.first_text_stream(stream, folder, str(tmp_path / "state"), seen_at=seen_at, keep_for="1 hour"))
    got = {r["text_key"]: r["doc_id"] for r in streams.least_ids(spark, folder).collect()}
    texts = spark.createDataFrame([("a", 2), ("b", 1), ("c", 3), ("", 5)], "cleaned string, doc_id long")
    assert got == {r[0]: r[1] for r in texts.select(F.sha2("cleaned", 256), "doc_id").collect()}
