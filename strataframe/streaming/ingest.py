"""Incremental ingestion of frames: each micro-batch replaces the frames that it holds, so a replay changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def ingest_frames(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append frames that arrive as Parquet files to a table with a folder a position, time and channel."""

    def write(batch: DataFrame, _: int) -> None:
        batch.dropDuplicates(["fov", "t", "c"]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("fov", "t", "c").parquet(target)

    frames = spark.readStream.schema(schema).parquet(source)
    return frames.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
