"""A corpus pipeline of five stages, each on all rows that the one before kept.

1. quality: documents that the classifier rejects go;
2. lines: later copies of repeated runs of lines are deleted, and documents of which nothing is left go;
3. near: one document of each group of near duplicates stays;
4. benchmark: documents that hold a passage of a benchmark item go;
5. tokens: every document is encoded, and decoded to prove it.

Every stage but the last returns the columns of its documents, whatever their
names and number; an empty table gives an empty one; texts are taken whole,
however long.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataframe.llm import decontaminate, jaccard_join, line_dedup, quality, sentencepiece_codec
from strataframe.llm._shared import stored
from strataframe.llm.queries import quality_weights

#: The least score of a document that stays, and the least bytes of a benchmark item that deletes documents.
LEAST_SCORE = 0.3
LEAST_ITEM = 12


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a good score. A null or empty text has the score of the bias alone; repeated rows stay or go alike."""
    weights = quality_weights(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, weights, LEAST_SCORE)


def _lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeated runs of lines, and n_chars to match; null and empty texts stay; of ties the least id's lines stay."""
    return line_dedup.without_repeats(docs)


def _near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that of the least id, nulls last. Texts without words link with nothing; rows equal in id and text are one."""
    return jaccard_join.representatives(docs)


def _benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of an item (single words and numbers are none); null and empty texts hold none, repeated rows stay or go alike."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least_bytes=LEAST_ITEM)


def _tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, decoded and round_trip; a null text has null ids, an empty one none."""
    return sentencepiece_codec.round_trip(docs, keep=["doc_id"])


STAGES = [("quality", _quality), ("lines", _lines), ("near", _near), ("benchmark", _benchmark), ("tokens", _tokens)]
#: SQL can't express the classifier, the alignment or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = stored(docs)
    return docs
