"""Sharding by bytes: contiguous shards of near-equal size, in the order of the ids.

Rows are dealt to ranges of ids; each range's total bytes and rows give, by a
prefix sum over the few ranges, where the range begins in the whole table; a
running sum in the range gives each row's own place.  Shard k holds the rows
whose middle byte lies in the k-th of ``shards`` equal parts, so a shard's
bytes differ from the target by less than its largest row.

Only thin rows (id, size, checksum) are shuffled, never texts.  Rows that equal
each other stay apart by a row number that is written before it is used, so a
recomputed task deals the same rows.

Cases: a null text has no bytes and no checksum; null ids come first; rows of
equal ids, or wholly equal rows, take neighbouring places; an empty table
gives an empty result; a table with fewer rows than shards leaves shards empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ._shared import checkpointed, partitions

#: Bytes that each row counts besides its text.
ROW_BYTES = 8


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (from 0, in the order of the ids) of every row."""
    data = F.col(text_col).cast("binary")
    thin = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )
    thin = checkpointed(thin.withColumn("row", F.monotonically_increasing_id()))
    ranges = 4 * partitions(docs.sparkSession)
    dealt = checkpointed(thin.repartitionByRange(ranges, "doc_id", "row").withColumn("part", F.spark_partition_id()))

    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    totals = dealt.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    all_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    begins = totals.select("part", F.coalesce(F.sum("bytes").over(order), F.lit(0)).alias("byte0"), F.coalesce(F.sum("rows").over(order), F.lit(0)).alias("row0"), F.sum("bytes").over(all_parts).alias("whole"))

    within = Window.partitionBy("part").orderBy("doc_id", "row")
    placed = dealt.join(F.broadcast(begins), "part").select(
        "doc_id", "size", "text_crc32",
        (F.col("byte0") + F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("before"),
        (F.col("row0") + F.row_number().over(within) - 1).alias("place"),
        "whole",
    )
    middle = F.col("before") + F.col("size") / 2.0
    placed = placed.withColumn("shard", F.least(F.lit(shards - 1), F.floor(middle * shards / F.col("whole"))).cast("int"))
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows with a folder for each shard; ids must be distinct."""
    placed = assign_shards(docs, shards, id_col, text_col).select(F.col("doc_id").alias(id_col), F.col("shard").alias("__shard"))
    docs.join(placed, id_col).write.partitionBy("__shard").parquet(path)
