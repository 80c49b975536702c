"""Temporal and spatial means of frames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Pixels of a mean image that are merged together, and bytes of sums that a task holds.
PIECE, HELD = 1 << 16, 256 << 20


def edge_frames(frames: DataFrame, n: int, side: str = "end") -> DataFrame:
    """The frames of the first or last ``n`` times that each position still has (all, if there are fewer).

    Only positions and times are ranked; pixels are not sorted.
    """
    if side not in ("start", "end"):
        raise ValueError(f"side must be 'start' or 'end', not {side!r}")
    if n < 1:
        raise ValueError("n must be positive")
    order = Window.partitionBy("fov").orderBy("t" if side == "start" else F.desc("t"))
    times = frames.select("fov", "t").distinct().withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= n)
    return frames.join(times.drop("__rank"), ["fov", "t"], "left_semi")


def _pieces(frames: DataFrame, keys: list[str]) -> DataFrame:
    """keys, h, w, piece and pixels: the mean image of each key in pieces of ``PIECE`` pixels.

    Each task adds up whole images, and gives its sums away when they take too much memory or at its end; so
    what is shuffled is an image a task and key, however many frames there are, and pieces of one image are merged by different tasks.
    """
    groups = [*keys, "h", "w"]
    rows = frames.where("pixels is not null and h is not null and w is not null").select(*groups, F.col("pixels").cast("array<double>").alias("pixels"))
    fields = [rows.schema[k] for k in groups]
    sums = T.StructType(list(fields)).add("piece", "integer").add("n", "long").add("nulls", T.ArrayType(T.LongType())).add("total", T.ArrayType(T.DoubleType()))
    means = T.StructType(list(fields)).add("piece", "integer").add("pixels", T.ArrayType(T.DoubleType()))

    def batch(columns: list, schema: T.StructType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, to_arrow_schema(schema).types, strict=True)], names=schema.names)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}
        size = 0

        def out() -> Iterator[pa.RecordBatch]:
            for key, (n, total, nulls) in held.items():
                for at in range(0, len(total), PIECE):
                    part = slice(at, at + PIECE)
                    yield batch([*([k] for k in key), [at // PIECE], [n], [None if nulls is None else nulls[part]], [total[part]]], sums)

        for b in batches:
            pixels = b.column("pixels")
            flat, bounds = pixels.values.to_numpy(zero_copy_only=False), pixels.offsets.to_numpy()
            missing = pixels.values.is_null().to_numpy(zero_copy_only=False) if pixels.values.null_count else None
            for k, key in enumerate(zip(*(b.column(g).to_pylist() for g in groups), strict=True)):
                part = slice(bounds[k], bounds[k + 1])
                image = flat[part]
                if key not in held:
                    held[key] = [0, np.zeros(len(image)), None]
                    size += image.nbytes
                own = held[key]
                own[0] += 1
                if missing is not None and missing[part].any():
                    own[2] = missing[part] + (0 if own[2] is None else own[2])
                    image = np.where(missing[part], 0, image)
                own[1] += image
            if size > HELD:
                yield from out()
                held.clear()
                size = 0
        yield from out()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, total, nulls = None, 0, None, None

        def out() -> pa.RecordBatch:
            count = n - (0 if nulls is None else nulls)
            mean = pa.array(total / np.maximum(count, 1), mask=np.broadcast_to(np.asarray(count) == 0, total.shape))
            return batch([*([k] for k in now), [mean.to_pylist() if mean.null_count else mean.to_numpy()]], means)

        for b in batches:
            places = zip(*(b.column(g).to_pylist() for g in (*groups, "piece", "n")), strict=True)
            for k, (*key, own) in enumerate(places):
                values = b.column("total")[k].values.to_numpy()
                gaps = b.column("nulls")[k]
                gaps = gaps.values.to_numpy().astype(np.int64) if gaps.is_valid else None
                if key != now:
                    if now is not None:
                        yield out()
                    now, n, total, nulls = key, 0, np.zeros(len(values)), None
                n, total = n + own, total + values
                if gaps is not None:
                    nulls = gaps + (0 if nulls is None else nulls)
        if now is not None:
            yield out()

    spread = rows.mapInArrow(add, sums).repartition(*groups, "piece").sortWithinPartitions(*groups, "piece")
    return spread.mapInArrow(merge, means)


def mean_frames(frames: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """fov, c (or other keys), h, w and pixels: the mean of all frames of a key; a pixel that is null in all of them is null.

    Images never become rows of pixels on the way.
    """
    keys = keys or ["fov", "c"]
    own = F.array_sort(F.collect_list(F.struct("piece", "pixels")))  # as large as an image
    return _pieces(frames, keys).groupBy(*keys, "h", "w").agg(F.flatten(F.transform(own, lambda p: p["pixels"])).alias("pixels"))


def mean_image(frames: DataFrame, n: int = 10, side: str = "end") -> DataFrame:
    """fov, c, y, x and the mean ``v`` over the first or last ``n`` frames."""
    pieces = _pieces(edge_frames(frames, n, side), ["fov", "c"]).select("fov", "c", "w", "piece", F.posexplode("pixels").alias("i", "v"))
    at = F.col("piece") * PIECE + F.col("i")
    return pieces.select("fov", "c", F.floor(at / F.col("w")).cast("int").alias("y"), (at % F.col("w")).cast("int").alias("x"), "v")


def row_profile(image: DataFrame) -> DataFrame:
    """Mean over x of every row of an image: fov, y, profile."""
    return image.groupBy("fov", "y").agg(F.avg("v").alias("profile"))


def band_profile(image: DataFrame, lanes: DataFrame, length: int, least: int = 100) -> DataFrame:
    """Mean over the rows near each lane of every column: fov, lane_index, x, profile.

    The band reaches max(length, least) rows to both sides of ``y_center``.
    """
    reach = max(length, least)
    near = (F.col("y") >= F.col("y_center") - reach) & (F.col("y") < F.col("y_center") + reach)
    return image.join(lanes.select("fov", "lane_index", "y_center"), "fov").where(near).groupBy("fov", "lane_index", "x").agg(F.avg("v").alias("profile"))


def downsample(image: DataFrame, factor: int) -> DataFrame:
    """Block means; rows and columns beyond the last whole block are left out."""
    if factor < 1:
        raise ValueError("factor must be positive")
    whole = image.where((F.col("y") < F.floor(F.col("h") / factor) * factor) & (F.col("x") < F.floor(F.col("w") / factor) * factor))
    block = {"y": F.floor(F.col("y") / factor).cast("int"), "x": F.floor(F.col("x") / factor).cast("int")}
    return whole.withColumns(block).groupBy("fov", "t", "c", "y", "x").agg(F.avg("v").alias("v"))


def block_means(frames: DataFrame, factor: int) -> DataFrame:
    """Frames of block means, with h and w to match; rows and columns beyond the last whole block are left out."""
    if factor < 1:
        raise ValueError("factor must be positive")
    if factor == 1:
        return frames

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            small = []
            for k in range(batch.num_rows):
                h, w = (batch.column(c)[k].as_py() for c in ("h", "w"))
                image = batch.column("pixels")[k].values.to_numpy(zero_copy_only=False).reshape(h, w)
                image = image[: h // factor * factor, : w // factor * factor]
                small.append(image.reshape(h // factor, factor, w // factor, factor).mean(axis=(1, 3)).ravel())
            yield batch.set_column(batch.schema.get_field_index("pixels"), "pixels", pa.array(small, pa.list_(pa.float64())))

    wide = frames.withColumn("pixels", F.col("pixels").cast("array<double>"))
    return wide.mapInArrow(run, wide.schema).withColumns({k: F.floor(F.col(k) / factor).cast("int") for k in ("h", "w")})


def reference(frames: DataFrame, mode: str | int = "mean") -> DataFrame:
    """The image that frames of a position are registered to: fov and reference."""
    if mode == "mean":
        return mean_frames(frames, ["fov"]).select("fov", F.col("pixels").alias("reference"))
    if mode in ("first", "last"):
        pick = F.min if mode == "first" else F.max
        times = frames.groupBy("fov").agg(pick("t").alias("t"))  # pixels are not compared
        return frames.join(times, ["fov", "t"]).select("fov", F.col("pixels").alias("reference"))
    if isinstance(mode, int):
        return frames.where(F.col("t") == mode).select("fov", F.col("pixels").alias("reference"))
    raise ValueError(f"unknown mode {mode!r}")
