"""The stages, each held against a brute-force version on its own input."""

import re
from collections import Counter, defaultdict

import pytest
import sentencepiece as library

import corpus_pipeline
from notemask.llm import sentencepiece, toxicity
from notemask.llm.common import written


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], sf_dir), name))
    return [[r.asDict() for r in f.collect()] for f in frames], [f.columns for f in frames], docs


def test_columns(stages):
    columns = stages[1]
    assert all(c == ["doc_id", "text", "lang", "source", "n_chars"] for c in columns[:-1])
    assert columns[-1] == ["doc_id", "lang", "source", "ids", "n_tokens"]


def test_toxic_documents_go_and_clean_ones_stay(spark, sf_dir, stages):
    (before, after, *_), _, docs = stages
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    reject = {r.doc_id for r in toxicity.toxicity_scores(docs, model).collect() if r.score >= 0.5}
    assert reject and Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before if r["doc_id"] not in reject)


def test_one_of_each_copy_stays(stages):
    _, before, after, *_ = stages[0]
    groups = defaultdict(list)
    for r in before:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r["text"] or "")].append((-len(r["text"] or ""), r["doc_id"]))
    assert sorted(min(g)[1] for g in groups.values()) == sorted(r["doc_id"] for r in after)


def test_one_of_each_component_stays(stages):
    from test_dedup import brute_near

    _, _, before, after, *_ = stages[0]
    want = sorted({c for _, _, c in brute_near([(r["doc_id"], r["text"]) for r in before])})
    assert want == sorted(r["doc_id"] for r in after)


def test_mix_takes_its_budgets(stages):
    from test_mixing import water

    _, _, _, before, after, _ = stages[0]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, taken = Counter(), Counter()
    texts = {r["doc_id"]: r["text"] for r in before}
    for r in before:
        sizes[r["source"]] += words(r["text"])
    for r in after:
        taken[r["source"]] += words(r["text"])
        assert texts[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
    assert taken == Counter({s: int(t + 1e-6) for s, t in water(sizes).items()})


def test_ids_equal_the_library(stages):
    *_, before, after = stages[0]
    processor = library.SentencePieceProcessor(model_file=sentencepiece.MODEL_PATH)
    want = Counter((r["doc_id"], tuple(processor.encode(r["text"]))) for r in before)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in after) == want


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((r["doc_id"], tuple(r["ids"])) for r in stages[0][-1])


def test_odd_rows_pass_every_stage(spark, sf_dir, odd):
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = written(stage(spark, docs, sf_dir), name)
            assert after.columns == odd.columns
            docs = after
        encoded = corpus_pipeline.encode(spark, docs, sf_dir)
        assert encoded.count() == docs.count()


def test_stages_take_odd_rows_on_their_own(spark, sf_dir, odd):
    kept = {name: stage(spark, odd, sf_dir).collect() for name, stage in corpus_pipeline.STAGES}
    assert len(kept["toxicity"]) == len(kept["sentencepiece"]) == odd.count()
    # blanks outweigh null and empty texts; the repeated row comes once
    assert Counter(r.doc_id for r in kept["exact_dedup"]) == Counter([None, 3, 4, 5, 6, 7])
    assert Counter(r.doc_id for r in kept["ngram_jaccard_join"]) == Counter(r.doc_id for r in odd.collect())
    assert all(r.text.strip(" \t\n") for r in kept["source_mixing"])
