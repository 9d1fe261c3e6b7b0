"""SentencePiece encoding and decoding against the public library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from spotshare.llm import pieces, queries

PATH = public_tokenizers.path(queries.PIECE_MODEL)
ODD = ["", "a", " ", "  a  b ", "\n\tx", "é漢字😀", "<s></s><unk> <0x0A>", "a\0b", "▁a", " " * 1000 + "x", "ha" * 3000, "漢字" * 1000, "a" * 777,
       "thethththehe" * 200, "▁" * 9, "services" * 50, " " * 5000, "\ufffd ﬁ Ａ", "x" * 20_000, "correctreectcor" * 40]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(13)
    drawn = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200)))
             for alphabet in ("abcdefgh ▁▁ \n\té漢字の😀ﬁАб0123the ing   in er", "thein ", "▁ a") for _ in range(400)]
    return ODD + drawn


@pytest.mark.parametrize("chars", [pieces.CHUNK_CHARS, 40])
def test_ids_equal_the_library(library, texts, monkeypatch, chars):
    monkeypatch.setattr(pieces, "CHUNK_CHARS", chars)
    some = texts if chars > 100 else texts[20:500]
    got = [x.tolist() for x in pieces.vocabulary(PATH).encode_texts(iter(some))]
    assert got == library.encode(some, add_eos=True)


def test_long_words_by_the_queue_equal_the_rounds(library, texts, monkeypatch):
    monkeypatch.setattr(pieces, "ROUNDS", 2)
    assert [x.tolist() for x in pieces.vocabulary(PATH).encode_texts(iter(texts[:300]))] == library.encode(texts[:300], add_eos=True)


def test_decoding_equals_the_library(library):
    rng = random.Random(14)
    for _ in range(2000):
        ids = [rng.randrange(600 if rng.random() < 0.5 else 32_000) for _ in range(rng.randrange(30))]
        assert pieces.vocabulary(PATH).decode(np.array(ids, dtype=np.int32)) == library.decode(ids)
    with pytest.raises(ValueError):
        pieces.vocabulary(PATH).decode(np.array([32_000], dtype=np.int32))


def test_tables_of_texts(spark, library, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[:60])] + [(90, None), (None, "same"), (None, "same")], "doc_id long, text string")
    docs = docs.withColumn("ids", F.lit("clash")).withColumn("Decoded", F.lit("clash")).withColumn("extra", F.lit(1))
    done = pieces.encode(docs, PATH)
    assert done.columns == ["doc_id", "text", "Decoded", "extra", "ids"]
    rows = pieces.decode(done, PATH).collect()
    assert len(rows) == 63 and rows[0].asDict().keys() == {"doc_id", "text", "extra", "ids", "decoded"}
    for r in rows:
        assert r["ids"] == library.encode(r["text"] or "", add_eos=True) and r["decoded"] == library.decode(r["ids"])
    got = sorted(map(tuple, pieces.digests(docs, PATH).collect()), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted(((r["doc_id"], len(r["ids"]), sha(" ".join(map(str, r["ids"]))), sha(r["decoded"])) for r in rows), key=str)
    assert pieces.digests(docs.where("1 = 0"), PATH).count() == 0
    none = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in pieces.decode(none, PATH).collect()] == ["", ""]


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "m").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.Vocabulary(str(tmp_path / "m"))
