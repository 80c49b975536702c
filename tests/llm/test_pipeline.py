"""The pipeline's stages against plain versions, each on what the one before kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strataframe.llm import queries
from tests.llm import brute

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    import sentencepiece

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        stage(spark, docs, DATA).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count()
        if name != "tokens":
            assert docs.columns == columns
        if name == "quality":
            score = {r.doc_id: r.score for r in queries.op3_quality(spark, DATA).collect()}
            assert set(after) == {i for i in before if score[i] >= 0.3} and len(after) < len(before)
        elif name == "lines":
            wanted = brute.dedup_maximal(list(before.items()))
            assert {i: r.text for i, r in after.items()} == {i: t for (i, was), t in wanted.items() if t or not was}
            assert all(r.n_chars == len(r.text) for r in after.values() if r.text != before[r.doc_id])
        elif name == "near":
            rows = list(before.items())
            assert set(after) == {i for (i, _), (n, c) in zip(rows, brute.components(rows), strict=True) if i == c}
        elif name == "benchmark":
            leaks = {i for i, t in before.items() if any(brute.folded(x) in brute.folded(t) for x in items)}
            assert leaks and not leaks & set(after) and len(after) >= len(before) - 2 * len(leaks)
        else:
            library = sentencepiece.SentencePieceProcessor(model_file="/opt/tokenizers/piece_bpe_32k.model")
            assert all(r.ids == library.encode(before[i]) and r.decoded == before[i] and r.round_trip for i, r in after.items())


def test_run(spark):
    found = corpus_pipeline.run(spark, DATA)
    assert found.columns == ["doc_id", "ids", "n_tokens", "decoded", "round_trip"] and found.count() > 100


CLASHES = ["removed", "units", "score", "ids", "n_tokens", "decoded", "__text", "__starts", "__key", "__score", "key", "row", "ord", "lines", "cls", "component", "item", "Start"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_cases_of_each_stage(spark, name, stage):
    """Nulls in every column, empty and very long texts, ties and repeated rows, clashing names, an empty table."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = [f"{c} {t}" for c, t in docs.dtypes]
    good = max((r.text for r in docs.limit(60).collect() if r.text), key=len)
    texts = [(1, good), (1, good), (2, good), (None, good), (None, None), (3, None), (4, ""), (5, " \n "), (6, (good + "\n") * (400_000 // len(good) + 1)), (7, "short")]
    rows = [tuple({"doc_id": i, "text": t}.get(c) for c in docs.columns) for i, t in texts]
    frame = spark.createDataFrame(rows, ", ".join(columns)).withColumns({c: F.lit("own") for c in CLASHES})
    found = stage(spark, frame, DATA)
    kept = found.collect()
    assert stage(spark, frame.limit(0), DATA).collect() == []
    if name == "tokens":
        assert len(kept) == len(rows) and all(r.round_trip for r in kept) and [r.n_tokens for r in kept if r.doc_id == 3] == [None] and [r.ids for r in kept if r.doc_id == 4] == [[]]
        return
    assert found.columns == frame.columns and all(r["__text"] == "own" for r in kept)
    ids = sorted((r.doc_id for r in kept), key=str)
    if name == "quality":
        assert ids.count(1) in (0, 2) and (3 in ids) == (4 in ids)
    elif name == "lines":
        text = {r.doc_id: r.text for r in kept if r.doc_id is not None}
        assert ids.count(1) == 2 and text[1] == good and 2 not in ids and text[3] is None and text[4] == "" and text[7] == "short" and len(text.get(6, "")) < len(good)
    elif name == "near":
        assert ids.count(1) == 1 and 2 not in ids and {3, 4, 5, 7} <= set(ids) and ids.count(None) == 1
    else:
        assert len(kept) == len(rows)
