"""The taggers and the whole pipeline."""

import dataclasses
import re

import pytest
from pyspark.sql import functions as F

from notemask import annotate_notes, rejected_notes, tag_notes
from notemask.functions.labels import ALPHABET
from notemask.functions.marks import with_reserved
from notemask.operators.gazetteers import BITMAP_BITS, BITMAPS, HEAD_BUCKETS, perhaps_known
from notemask.functions.chars import RUN
from notemask.functions.spans import matches
from notemask.operators.matches import candidates, has_letter, starts_upper
from notemask.operators.quality import keep_first_text, label_validation_counts, split_equals_counts
from notemask.plans import fixtures as fx
from notemask.plans.pipeline import labels_and_rejects, mark_notes, mask_addresses, mask_names
from notemask.plans.queries import QUERIES

GOLDEN = [
    ("The patient lives in New Jersey; and the Dr is from North Dakota", "The patient lives in PAddress PAddress; and the Dr is from PAddress PAddress"),
    ("Patient lives at 123 Oak Terrace , West Orange, NJ, 07052", "Patient lives at PAddress PAddress PAddress , PAddress PAddress, PAddress, PAddress"),
    ("Dallas Memorial Hospital and Lincoln , NE", "PAddress Memorial Hospital and PAddress , PAddress"),
    ("Virginia Wilson", "Virginia PersonName"),
    ("Seen by KLEIN , MIRANDA S. today", "Seen by PersonName , PersonName PersonName. today"),
    ("CLARK , JULIE APR", "PersonName , PersonName APR"),
    ("JONES , MYNA At:", "PersonName , PersonName At:"),
    ("Intern, Laura S", "Intern, Laura S"),
    ("NURSE , LAURA CLARK", "NURSE , PersonName PersonName"),
    ("Calvin McKinskey , RN", "PersonName PersonName , PersonName"),
    ("PATRICIA S. WAKEFIELD , M.D.", "PersonName PersonName. PersonName , PersonName.PersonName."),
    ("Michael Henry Butler\nPAddress", "PersonName PersonName PersonName\nPAddress"),
    ("Dr. Norwin met Mrs. Li; later norwin, Life and LI", "Dr. PersonName met Mrs. PersonName; later PersonName, Life and PersonName"),
    ("with Sarah M. Klein here", "with PersonName PersonName. PersonName here"),
    ("Mary-Ann, Sarah-Louise, klein-type, O'Brien's", "PersonName-PersonName, PersonName-PersonName, PersonName-PersonName, PersonName'PersonName's"),
    ("PAddress , AL and New PAddress 07052 68501 or 99999", "PAddress , PAddress and PAddress PAddress PAddress PAddress or 99999"),
    ("Code 07052 here. Lincoln , Nebraska, then Lincoln 68501-1234", "Code 07052 here. PAddress , PAddress, then Lincoln PAddress-PAddress"),
    ("07052 is first in PAddress", "07052 is first in PAddress"),
    ("Asst Sarah Klein MD", "Asst PersonName PersonName PersonName"),
    ("McAllen, TX and DEER ISLAND and Deer\nIsland", "PAddress, PAddress and PAddress PAddress and Deer\nIsland"),
    ("May Green at Home", "May Green at Home"),
    ("Code 07052-1234 was used", "Code 07052-1234 was used"),
    ("Part 11111-22 fits", "Part 11111-22 fits"),
    ("Physician, Sarah Klein took notes", "Physician, PersonName PersonName took notes"),
    ("PHYSICIAN, SARAH CLARK left", "PHYSICIAN, PersonName PersonName left"),
    ("Surgeon , Julie Clark left", "Surgeon , PersonName PersonName left"),
    ("Intern, Julie Clark left", "Intern, PersonName PersonName left"),
    ("Deer Island first, later deer island again", "PAddress PAddress first, later PAddress PAddress again"),
    ("Deer Island first, later deer island Wilson", "PAddress PAddress first, later deer island PersonName"),
    ("Winston-Salem or winston-salem", "PAddress-PAddress or PAddress-PAddress"),
    ("Virginia is nice, then virginia again", "PAddress is nice, then PAddress again"),
    ("only virginia in lower case", "only virginia in lower case"),
    ("He lives in Newark, New Jersey now", "He lives in PAddress, PAddress PAddress now"),
    ("Newark, North Dakota is none of its states", "Newark, PAddress PAddress is none of its states"),
    ("At 68 Oak St., then 68 oak st. again", "At PAddress PAddress PAddress., then PAddress PAddress PAddress. again"),
    ("At 68 oak st. only", "At 68 oak st. only"),
    ("KLEIN , MIRANDA and klein , miranda", "PersonName , PersonName and PersonName , PersonName"),
    ("klein , miranda alone", "klein , miranda alone"),
    ("Calvin Clark DO and PATRICIA JONES, D.O. agreed", "PersonName PersonName PersonName and PersonName PersonName, PersonName.PersonName. agreed"),
    ("Dr. and Mrs. Klein and more", "Dr. and Mrs. PersonName and more"),
    ("Lake Of The Pines, then lake of the pines", "PAddress PAddress PAddress PAddress, then PAddress PAddress PAddress PAddress"),
    ("Bay Of The Four Winds here", "PAddress PAddress PAddress PAddress PAddress here"),
    ("Sarah ﷐ met ﷓Klein﷑ at Deer Island﷒ there", "PersonName ﷐ met ﷓PersonName﷑ at PAddress PAddress﷒ there"),
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_golden_rows(spark, seed_lexicon):
    rows = frame(spark, [t for t, _ in GOLDEN])
    tagged = mask_names(mask_addresses(mark_notes(rows, seed_lexicon, ["doc_id"])))
    tagged = tagged.withColumn("name_masked", with_reserved(F.col("text"), F.col("name_masked")))
    got = {r["text"]: r["name_masked"] for r in tagged.collect()}
    for text, expected in GOLDEN:
        assert got[text] == expected


def test_lookup_without_broadcast_gives_the_same(spark, seed_lexicon):
    rows = frame(spark, [t for t, _ in GOLDEN])
    shuffled = dataclasses.replace(seed_lexicon, broadcast_limit=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tagged = annotate_notes(rows, shuffled).select("doc_id", "masked", "iob")
        plan = tagged._jdf.queryExecution().executedPlan().toString()
        broadcast = re.findall(r"BroadcastHashJoin \[(\w+)#", plan)
        assert set(broadcast) == {"bitmap"}  # of fixed size; the lexicon itself is shuffled
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
        apart = sorted(map(tuple, tagged.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    together = annotate_notes(rows, seed_lexicon).select("doc_id", "masked", "iob")
    assert apart == sorted(map(tuple, together.collect()))


def test_bitmaps_keep_unknown_phrases_from_the_shuffle(spark, seed_lexicon):
    words = spark.range(20000).select(F.concat(F.lit("word "), "id").alias("key"), F.col("id").alias("other"))
    keys = seed_lexicon.rows.select("key", F.lit(-1).cast("long").alias("other"))
    left = perhaps_known(words.unionByName(keys), seed_lexicon)
    assert left.columns == ["key", "other"]
    kept = [r["key"] for r in left.collect()]
    known = {r["key"] for r in keys.collect()}
    assert known <= set(kept) and len(kept) <= len(known) + 20
    sizes = seed_lexicon.bitmaps().select(F.octet_length("bits").alias("n"), "bitmap").collect()
    assert {r["n"] for r in sizes} == {BITMAP_BITS // 8} and all(0 <= r["bitmap"] < BITMAPS for r in sizes)


@pytest.mark.parametrize("name", ["tag_notes", "mask_hyphen", "name_matches_by_shuffle", "token_name_matches"])
def test_patterns_run_behind_the_shuffle(spark, sf_dir, name):
    """Not in the scan, which has one task if the file has one row group."""
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    scans = [part.split("Relation", 1)[0] for part in plan.split("RepartitionByExpression")[1:]]
    assert scans and "regexp_extract_all" in plan
    assert not any("regexp" in part for part in scans)


@pytest.mark.parametrize("text", [
    "caf\u00e9 \u00c9cole and 12345 _Sarah \u00e9cole-Klein 9Klein \U0001d400bc {x} [Sarah] `Sarah ~ @Sarah \x7fSarah", "Sarah", "-Sarah", "sarah-",
])
def test_plain_tests_of_words_agree_with_their_patterns(spark, text):
    words = frame(spark, [text]).select(F.explode(matches(F.col("text"), RUN)).alias("w"))
    told = words.select("w", has_letter(F.col("w")), starts_upper(F.col("w"))).collect()
    assert [tuple(r) for r in told] == [
        (w, any(c.isalpha() for c in w), w[0].isupper() and w[0].isalpha()) for w in (r["w"] for r in told)
    ]


def phrases(spark, texts, lexicon):
    found = frame(spark, texts).select("doc_id", F.explode(candidates(F.col("text"), lexicon)).alias("p"))
    return sorted((r["doc_id"], r["pos"], r["n"], r["key"]) for r in found.select("doc_id", "p.*").collect())


def test_context_of_phrases_is_kept_as_written(spark, seed_lexicon):
    """What a lookup needs of the neighbours is made behind the join, for the matches that need it only."""
    texts = ["The 12 Lincoln , 7North Dakota East", "In Lincoln  New Jersey", "Lincoln West\tVirginia", "to Deer Island Wilson 5"]
    found = frame(spark, texts).select(F.explode(candidates(F.col("text"), seed_lexicon)).alias("p")).select("p.*")
    context = ["key", "previous", "next", "beyond", "beyond_two", "following_pos", "after"]
    rows = {tuple(r) for r in found.filter("key in ('lincoln', 'deer island')").select(*context).collect()}
    assert rows == {
        ("lincoln", "The", "7North", "Dakota", "East", 3, None),
        ("lincoln", "In", "New", "Jersey", None, 2, None),
        ("lincoln", None, "West", None, None, 1, "West"),
        ("deer island", "to", "Island", None, None, 2, "Wilson"),
    }


def test_a_long_key_builds_no_phrases_elsewhere(spark, seed_gazetteers, seed_lexicon):
    """The first-word index: phrases begin like a key and have as many words as one of those that begin so."""
    junk = "Zzjunk " + " ".join(f"Word{i}" for i in range(40))
    named = seed_gazetteers.names.unionByName(
        spark.createDataFrame([(junk.lower(), junk)], "key string, name string").select("name", "key")
    )
    longer = dataclasses.replace(seed_gazetteers, names=named).lexicon()
    assert longer.max_words == 41 and len(longer.heads) == len(seed_lexicon.heads) == HEAD_BUCKETS
    texts = [t for t, _ in GOLDEN] + ["The Quick Brown Fox Jumps Over The Lazy Dog And Runs Far Away From Here Again"]
    assert phrases(spark, texts, longer) == phrases(spark, texts, seed_lexicon)
    found = phrases(spark, [junk, junk + " More"], longer)
    assert {(0, 0, 41, junk.lower()), (1, 0, 41, junk.lower())} <= set(found)
    known = {r["key"] for r in seed_lexicon.rows.collect()}
    every = {(d, p, n, k) for d, p, n, k in phrases(spark, texts, dataclasses.replace(seed_lexicon, heads=b"\x7f" * HEAD_BUCKETS)) if k in known}
    assert {x for x in phrases(spark, texts, seed_lexicon) if x[3] in known} == every and len(every) > 50


def test_words_that_run_together_are_longer_than_their_key(spark, seed_lexicon):
    found = phrases(spark, ["O'Brien and Mary-Ann, Deer Island-based, Winston-Salem. De La Cruz-Jones"], seed_lexicon)
    keys = {k for *_, k in found}
    assert {"obrien", "maryann", "deer island", "winstonsalem", "de la cruz"} <= keys


def test_rejects_and_counts(spark, seed_lexicon):
    texts = ["fine", None, "", "left ' early", "bad ﷐ text", "I 'am here"]
    rows = frame(spark, texts).union(spark.sql("SELECT CAST(NULL AS BIGINT), 'no id'"))
    reasons = {r["doc_id"]: r["reject_reason"] for r in rejected_notes(rows, seed_lexicon).collect()}
    assert reasons == {
        1: "null_text",
        2: "labels_empty",
        3: "size_mismatch",
        5: "size_mismatch",
        None: "null_id",
    }
    annotated = annotate_notes(rows, seed_lexicon)
    assert {tuple(r) for r in label_validation_counts(annotated).collect()} == {(1, 4), (5, 1)}
    assert [tuple(r) for r in split_equals_counts(annotated).collect()] == [(1, 2), (0, 2)]
    labels = {r["doc_id"]: (r["cleaned"], r["iob"]) for r in tag_notes(rows, seed_lexicon).collect()}
    assert labels == {0: ("fine", "O"), 4: ("bad ﷐ text", "O O O")}
    once, rejects = labels_and_rejects(rows, seed_lexicon)
    assert {r["doc_id"]: (r["cleaned"], r["iob"]) for r in once.collect()} == labels
    assert {r["doc_id"]: r["reject_reason"] for r in rejects.collect()} == reasons


def test_repeated_ids_do_not_mix_texts(spark, seed_lexicon):
    rows = spark.createDataFrame(
        [(7, "Sarah was here"), (7, "was Sarah here"), (7, "Sarah was here")], "doc_id long, text string"
    )
    masked = sorted(r["masked"] for r in annotate_notes(rows, seed_lexicon).collect())
    assert masked == ["PersonName was here", "PersonName was here", "was PersonName here"]


def test_composite_ids(spark, seed_lexicon, sf_dir):
    turns = fx.table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    out = tag_notes(turns, seed_lexicon, ["conv_id", "turn"])
    assert out.columns == ["conv_id", "turn", "text", "cleaned", "iob", "masked"]
    assert out.count() > 0


def test_first_of_many_copies(spark):
    copies = spark.range(1000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("cleaned")
    )
    kept = keep_first_text(copies.repartition(8), ["doc_id"])
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == {0} | {i for i in range(1000) if i % 3}


@pytest.fixture(scope="module")
def annotated(spark, sf_dir, seed_lexicon):
    rows = annotate_notes(fx.notes(spark, sf_dir), seed_lexicon, with_locations=True)
    return rows.persist()


def test_token_counts_survive_masking(annotated):
    space_tokens = lambda c: F.size(F.split(c, " ", -1))
    changed = annotated.filter(space_tokens(F.col("text")) != space_tokens(F.col("masked")))
    assert changed.count() == 0
    assert annotated.filter("reject_reason like '%misaligned'").count() == 0


def test_labels_match_tokens(annotated):
    good = annotated.filter("reject_reason is null")
    assert good.count() > 100
    assert good.filter("sizes.length_text <> sizes.length_labels or label_code <> 1").count() == 0
    assert good.filter(~F.col("iob").rlike(f"^{ALPHABET}")).count() == 0


@pytest.mark.parametrize("pipeline", [annotate_notes, tag_notes])
def test_executed_plan_scans_and_shuffles_the_notes_once(spark, sf_dir, tmp_path, seed_lexicon, pipeline):
    fx.notes(spark, sf_dir).write.parquet(str(tmp_path / "notes"))
    rows = pipeline(spark.read.parquet(str(tmp_path / "notes")), seed_lexicon)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in plan
    assert not any(word in plan for word in ("Python", "NestedLoop", "Cartesian"))
    assert final.count("FileScan parquet") == 1
    assert final.count("ReusedExchange") == 1
    # by id and text hash; the label rows move once more, by the hash of the cleaned text
    moved = [line for line in final.splitlines() if " Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert len(moved) == (1 if pipeline is annotate_notes else 2)
    assert sum("ENSURE_REQUIREMENTS" in line for line in moved) == len(moved) - 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_only_wanted_columns_are_computed(spark, sf_dir, seed_lexicon):
    plan = lambda c: annotate_notes(fx.notes(spark, sf_dir), seed_lexicon, columns=c)._jdf.queryExecution().optimizedPlan().toString()
    assert "ssn_matches" in plan(["ssn_matches"]) and "ssn_matches" not in plan(["masked"])
    assert "spaced" not in plan(["label_code"]) and "cleaned" not in plan(["label_code"])


def test_filters_stay_above_the_steps(spark, sf_dir, seed_lexicon):
    rows = annotate_notes(fx.notes(spark, sf_dir), seed_lexicon)
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString())
    assert size(rows.filter("label_code = 1 and masked like 'a%'")) < 1.2 * size(rows)


def test_stateless_steps_accept_a_stream(spark, sf_dir, tmp_path):
    from notemask.functions.patterns import mask_email

    fx.table(spark, sf_dir, "documents").write.parquet(str(tmp_path / "in"))
    schema = fx.table(spark, sf_dir, "documents").schema
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    masked = stream.select("doc_id", mask_email(F.col("text")).alias("masked"))
    query = masked.writeStream.format("memory").queryName("masked_stream").start()
    query.processAllAvailable()
    query.stop()
    assert spark.table("masked_stream").count() == fx.table(spark, sf_dir, "documents").count()


def test_lexicon_follows_its_files(spark, sf_dir, tmp_path):
    for name in fx.LOOKUP_TABLES:
        fx.table(spark, sf_dir, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    first = fx.lexicon(spark, str(tmp_path))
    assert fx.lexicon(spark, str(tmp_path)) is first
    more = fx.table(spark, sf_dir, "conversations").limit(1).withColumn("text", F.lit("Zyxwvut came"))
    more.write.mode("append").parquet(str(tmp_path / "conversations.parquet"))
    second = fx.lexicon(spark, str(tmp_path))
    assert second is not first and fx.lexicon(spark, str(tmp_path)) is second
    assert fx.lexicon(spark, sf_dir) is fx.lexicon(spark, sf_dir)
    known = second.rows.select("key").exceptAll(first.rows.select("key"))
    assert [r.key for r in known.collect()] == ["zyxwvut"]


def test_listing_reads_no_contents(spark, sf_dir):
    found = fx.files_of(spark, sf_dir)
    assert found[0] == len(fx.LOOKUP_TABLES) and found[1] > 0
