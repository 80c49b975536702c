import numpy as np
import pytest
import sentencepiece

from strataframe.llm import sentencepiece_codec as codec


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=codec.MODEL)


def test_equals_the_library(spark, prose, library):
    rng = np.random.default_rng(1)
    odd = ["  two  spaces\n\nß \t x ▁a  日本語  é ﬁ Ａ", "", " ", "   ", "a" * 400, "ababab" * 40, " " * 90 + "x" + " " * 30, "<s> </s> <unk> <0x0A>", "\x00\x01", "😀 👩‍👩‍👧", "aaaa    bbbb     ", "1,234.56", None, "=========", "é"]
    odd += ["".join(rng.choice(list("ab  ▁\nthe._-=*0"), 150)) for _ in range(60)]
    rows = list(enumerate([*odd, *(t for _, t in prose)]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for r in codec.decode(codec.encode(docs)).collect():
        if r.text is None:
            assert r.ids is None and r.decoded is None
        else:
            assert r.ids == (library.encode(r.text) if r.text else []) and r.n_tokens == len(r.ids)
            assert r.decoded == r.text.replace("▁", " ")
    for r in codec.round_trip(docs).collect():
        assert r.round_trip == ("▁" not in (r.text or "")), r.text


def test_memory_bounds_change_nothing(library, prose, monkeypatch):
    monkeypatch.setattr(codec, "WORDS", 40)
    monkeypatch.setattr(codec, "PAIRS", 30)
    monkeypatch.setattr(codec, "BLOCK", 50)
    own = codec.Codec(codec.load(codec.MODEL))
    for _, t in prose[:15]:
        if t:
            assert own.encode([t])[0].tolist() == library.encode(t)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, ids string")
    assert codec.encode(docs, keep=["doc_id"]).count() == 0


def test_clashing_columns_and_other_models(spark):
    docs = spark.createDataFrame([(1, "some text", 9, "x", "y")], "doc_id long, text string, ids int, __text string, Decoded string")
    for found, columns in ((codec.encode(docs), ["doc_id", "text", "__text", "Decoded", "ids", "n_tokens"]), (codec.round_trip(docs), ["doc_id", "text", "__text", "ids", "n_tokens", "decoded", "round_trip"])):
        r = found.first()
        assert found.columns == columns and r["__text"] == "x" and r.n_tokens == len(r.ids) > 0
    message = lambda *fields: b"".join(fields)
    unigram, bpe = message(b"\x12\x02\x18\x01"), message(b"\x12\x02\x18\x02")
    keeps, folds = message(b"\x1a\x06\x12\x00\x18\x01\x20\x00"), message(b"\x1a\x07\x12\x01a\x18\x01\x20\x00")
    codec._check(bpe + keeps)
    for proto in (unigram + keeps, keeps, bpe + folds, bpe):
        with pytest.raises(ValueError):
            codec._check(proto)


def test_pieces_stay_apart_as_merges_say():
    model = codec.Codec(codec.load(codec.MODEL))
    rng = np.random.default_rng(8)
    pieces = [model.pieces[i] for i in rng.choice(model.usable, 4000)]
    for a, b in zip(pieces[::2], pieces[1::2], strict=True):
        assert model.apart(a, b) == (model.merged(a + b) == [a, b]), (a, b)
