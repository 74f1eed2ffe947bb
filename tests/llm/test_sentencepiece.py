import random

import numpy as np
import pytest
import sentencepiece as library

from notemask.llm import sentencepiece as sp


@pytest.fixture(scope="module")
def vocabulary():
    return sp.load()


def random_texts():
    random.seed(5)
    letters = " ab\nthe.,#éß日😀\t12▁"
    return ["".join(random.choice(letters) for _ in range(random.randint(0, 60))) for _ in range(500)]


TEXTS = ["", " ", "   ", "a  b\n\tc   ", "x" * 3000, "ab" * 500, "日本語 😀😀", "\r\n\x0b\x00", " " * 40 + "z" + " " * 17, "▁▁x▁"]


def test_ids_equal_the_library(spark, table, vocabulary):
    texts = TEXTS + random_texts() + [r.text for r in table("documents").select("text").collect()]
    want = library.SentencePieceProcessor(model_file=sp.MODEL_PATH).encode(texts)
    got = sp.Encoder(vocabulary).encode(texts)
    assert [x.tolist() for x in got] == want


def test_unigram_search_equals_the_library(vocabulary):
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(open(sp.MODEL_PATH, "rb").read())
    proto.trainer_spec.model_type = 1
    random.seed(1)
    for p in proto.pieces:  # scores of a unigram model, without ties
        if p.type == 1:
            p.score = -random.uniform(5, 15)
    v = sp.Vocabulary(vocabulary.pieces, np.array([p.score for p in proto.pieces]), vocabulary.kinds, True, True)
    texts = [t for t in TEXTS + random_texts() if "\x00" not in t]
    want = library.SentencePieceProcessor(model_proto=proto.SerializeToString()).encode(texts)
    got = sp.Encoder(v).encode(texts)
    score = lambda ids: sum(v.scores[i] for i in ids)
    for text, mine, theirs in zip(texts, got, want, strict=True):
        if mine.tolist() != theirs:  # equal up to the order of equal sums
            assert abs(score(mine) - score(theirs)) < 1e-3, text


def test_round_trip(odd, documents, vocabulary):
    rows = documents([(i, t) for i, t in enumerate(TEXTS)])
    encoded = sp.encode_documents(rows, vocabulary)
    back = {r.doc_id: r.text for r in sp.decode_documents(encoded, vocabulary).collect()}
    assert back == {i: t.replace("▁", " ") for i, t in enumerate(TEXTS)}
    found = sp.digests(odd, vocabulary).collect()
    assert len(found) == odd.count()
    assert {r.doc_id: r.n_tokens for r in found}[1] == 0
    assert [r.round_trip for r in found if r.doc_id == 7] == [False]  # U+2581 comes back as a space
    assert all(r.round_trip for r in found if r.doc_id != 7)
    assert sp.digests(odd.limit(0), vocabulary).count() == 0


def test_cache_limits_change_nothing(monkeypatch, table, vocabulary):
    texts = [r.text for r in table("documents").limit(60).collect()]
    want = [x.tolist() for x in sp.Encoder(vocabulary).encode(texts)]
    monkeypatch.setattr(sp, "KNOWN_SEGMENTS", 10)
    monkeypatch.setattr(sp, "CELLS", 64)
    encoder = sp.Encoder(vocabulary)
    assert [encoder.encode([t])[0].tolist() for t in texts] == want


def test_a_long_run_of_blanks(vocabulary):
    processor = library.SentencePieceProcessor(model_file=sp.MODEL_PATH)
    for n in [*range(70), 1000, 60_001]:
        text = "a" + " " * n + "b"
        assert sp.Encoder(vocabulary).encode([text])[0].tolist() == processor.encode(text)
