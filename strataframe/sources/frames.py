"""Frame tables: one row per (fov, t, c) with its pixels as a row-major array.

``from_embeddings`` reads the driver's ``embeddings`` table as a stack of small
images: the label is the position, the rank of ``vec_id`` in its label is the
time, and the 64 floats are 8 x 8 pixels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

SIDE = 8
#: Ids are ranked in blocks of so many, so no task sorts the frames of a whole position.
BLOCK = 1 << 16


def _ranked(raw: DataFrame, block: int) -> DataFrame:
    """The rows with ``rank``, from 0, of their vec_id in their label (nulls first).

    A block of ids is ranked by itself; what the blocks before it hold is a sum over one thin row a block.
    """
    rows = raw.withColumn("__block", F.coalesce(F.expr(f"vec_id div {block}"), F.lit(-(1 << 63))))
    before = Window.partitionBy("label").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("label", "__block").agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.select("label", "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    own = F.row_number().over(Window.partitionBy("label", "__block").orderBy("vec_id")) - 1
    return rows.withColumn("__own", own).join(sizes, ["label", "__block"]).withColumn("rank", F.col("__before") + F.col("__own"))


def from_embeddings(spark: SparkSession, sf_dir: str, block: int = BLOCK) -> DataFrame:
    """fov, p_index, t, t_ms, c, h, w and pixels (doubles) of every frame."""
    raw = _ranked(spark.read.parquet(f"{sf_dir}/embeddings.parquet").where("label is not null"), block)
    t = F.col("rank").cast("int")
    return raw.select(
        F.concat(F.lit("XYPos:"), F.col("label").cast("string")).alias("fov"),
        F.col("label").cast("int").alias("p_index"),
        t.alias("t"),
        (t * 30000.0).alias("t_ms"),
        F.lit("single").alias("c"),
        F.lit(SIDE).alias("h"),
        F.lit(SIDE).alias("w"),
        F.transform("embedding", lambda v: v.cast("double")).alias("pixels"),
    )


def pixels(frames: DataFrame) -> DataFrame:
    """One row per pixel: y and x from the place in the row-major array."""
    kept = [c for c in frames.columns if c != "pixels"]
    out = frames.select(*kept, F.posexplode("pixels").alias("i", "v"))
    return out.withColumns({"y": F.floor(F.col("i") / F.col("w")).cast("int"), "x": (F.col("i") % F.col("w")).cast("int")}).drop("i")
