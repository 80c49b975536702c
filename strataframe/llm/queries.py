"""The query of each operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontaminate, fill_in_middle, jaccard_join, language_id, line_dedup, neighbours, quality, sentencepiece_codec, sharding, simhash_join, span_dedup, sql, surrogates, target_resampling


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    prototypes = language_id.train(docs.where(_remainder(4) != 2))
    return language_id.predict(docs, prototypes, extra={"held_out": F.coalesce(_remainder(4) == 2, F.lit(False))})


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(_table(spark, sf_dir, "documents"), 24)
    return placed.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def quality_weights(docs: DataFrame, labels: DataFrame):
    """Weights learned from labelled rows whose crc32(doc_id) mod 5 is not 0."""
    labels = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return quality.train(docs.select("doc_id", "text").where(_remainder(5) != 0), labels=labels.where(_remainder(5) != 0))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    weights = quality_weights(docs, _table(spark, sf_dir, "labels"))
    scored = quality.score(docs, weights, extra={"held_out": F.coalesce(_remainder(5) == 0, F.lit(False))})
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(_table(spark, sf_dir, "documents"), secret="a key that a user sets")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))


def op9_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.dedup_spans(_table(spark, sf_dir, "documents"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return sentencepiece_codec.round_trip(docs, keep=["doc_id"])


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(_table(spark, sf_dir, "documents"))
    back = fill_in_middle.restored(F.col("form"), F.col("output"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"))


def op12_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = target_resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_join.linked(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_language_id, op2_sharding, op3_quality, op4_decontaminate, op5_neighbours, op6_pii_surrogates, op7_jaccard_join, op8_line_dedup, op9_span_dedup, op10_sentencepiece, op11_fill_in_middle, op12_target_resampling, op13_simhash)}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLE)
