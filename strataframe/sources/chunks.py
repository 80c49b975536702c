"""Stacks of crops as chunks: some times of one trench and channel a row, packed to bytes that compress well.

A chunk's pixels are written as integers of the source's width, by planes of bytes: all
low bytes of the chunk, then all high ones.  Neighbouring values share their high bytes, so the
codec finds long runs.  Rows of a file are in order of trench, channel and time, in small row groups, whose
statistics let a reader skip those that it doesn't need.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The types of pixels that can be packed.
DTYPES = ("uint8", "uint16", "uint32", "int16", "int32", "float32", "float64")
#: Trenches whose chunks are written by one task, and bytes of a row group.
TRENCHES, ROW_GROUP = 16, 8 << 20


def plane_bytes(values: np.ndarray, dtype: str, byte_shuffle: bool) -> bytes:
    """The values as little-endian items, byte plane by byte plane if wanted."""
    items = values.astype(np.dtype(dtype).newbyteorder("<"))
    raw = items.view(np.uint8).reshape(-1, items.itemsize)
    return (raw.T if byte_shuffle else raw).tobytes()


def plane_values(data: bytes, dtype: str, byte_shuffle: bool) -> np.ndarray:
    kind = np.dtype(dtype).newbyteorder("<")
    raw = np.frombuffer(data, np.uint8)
    raw = np.ascontiguousarray(raw.reshape(kind.itemsize, -1).T) if byte_shuffle else raw
    return raw.ravel().view(kind)


def _packed(stack: Column, dtype: str, byte_shuffle: bool) -> Column:
    @F.arrow_udf("binary")
    def pack(stack: pa.Array) -> pa.Array:
        frames = stack.values
        flat = frames.values.to_numpy(zero_copy_only=False)
        bounds, inner = stack.offsets.to_numpy(), frames.offsets.to_numpy()
        return pa.array([plane_bytes(flat[inner[a] : inner[b]], dtype, byte_shuffle) for a, b in zip(bounds[:-1], bounds[1:])], pa.binary())

    return pack(stack)


def _unpacked(data: Column, n: Column, dtype: Column, byte_shuffle: Column) -> Column:
    @F.arrow_udf("array<array<double>>")
    def unpack(data: pa.Array, n: pa.Array, dtype: pa.Array, byte_shuffle: pa.Array) -> pa.Array:
        values, sizes, counts = [], [], n.to_pylist()
        for one, frames, kind, shuffled in zip(data, counts, dtype.to_pylist(), byte_shuffle.to_pylist(), strict=True):
            found = plane_values(one.as_buffer().to_pybytes(), kind, shuffled)
            values.append(found.astype(float))
            sizes += [len(found) // frames] * frames
        inner = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(np.concatenate(values) if values else np.zeros(0)))
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)).astype(np.int32)), inner)

    return unpack(data, n, dtype, byte_shuffle)


def pack(crops: DataFrame, time_chunk: int | None = None, dtype: str = "uint16", byte_shuffle: bool = True, trenches: int = TRENCHES) -> DataFrame:
    """fov, trench_id, c, chunk, t_first, t_last, times, n, h, w, dtype, byte_shuffle and data of every chunk of ``time_chunk`` times (None: all times).

    Crops are shuffled once, to tasks of ``trenches`` trenches each, and are in order of trench, channel and chunk there. Values
    are cut to the type as numpy casts them.
    """
    if dtype not in DTYPES:
        raise ValueError(f"unknown type {dtype!r}; there are {list(DTYPES)}")
    if time_chunk is not None and (int(time_chunk) != time_chunk or time_chunk < 1):
        raise ValueError("time_chunk must be a positive integer or None")
    chunk = F.lit(0) if time_chunk is None else F.floor(F.col("t") / int(time_chunk))
    rows = crops.select("fov", "trench_id", "c", "h", "w", chunk.cast("int").alias("chunk"), F.floor(F.col("trench_id") / trenches).alias("__part"), F.struct("t", "pixels").alias("__frame"))
    frames = F.array_sort(F.collect_list("__frame"))  # as large as a chunk
    # the grouping reuses the dealing by parts, so parts are also the files
    stacks = rows.repartition("fov", "__part").groupBy("fov", "__part", "trench_id", "c", "chunk", "h", "w").agg(frames.alias("__frames"))
    times = F.transform("__frames", lambda f: f["t"])
    packed = stacks.select(
        "fov", "trench_id", "c", "chunk", F.array_min(times).alias("t_first"), F.array_max(times).alias("t_last"), times.alias("times"), F.size(times).alias("n"), "h", "w",
        F.lit(dtype).alias("dtype"), F.lit(byte_shuffle).alias("byte_shuffle"), _packed(F.transform("__frames", lambda f: f["pixels"].cast("array<double>")), dtype, byte_shuffle).alias("data"),
    )
    return packed.sortWithinPartitions("fov", "trench_id", "c", "chunk")


def write_options(compression: str, level: int) -> dict[str, str]:
    """The options of a Parquet writer for a codec and its level."""
    options = {"compression": "zstd" if compression == "zstd" else "uncompressed", "parquet.block.size": str(ROW_GROUP), "parquet.page.size": str(1 << 20)}
    return options | ({"parquet.compression.codec.zstd.level": str(level)} if compression == "zstd" else {})


def unpack(chunks: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """trench_id, fov, t, c, h, w and pixels of the frames of chunks, of times from ``start`` to before ``end``.

    Chunks that hold none of the times are skipped by their row groups' statistics.
    """
    if start is not None:
        chunks = chunks.where(F.col("t_last") >= start)
    if end is not None:
        chunks = chunks.where(F.col("t_first") < end)
    frames = F.arrays_zip(F.col("times").alias("t"), _unpacked(F.col("data"), F.col("n"), F.col("dtype"), F.col("byte_shuffle")).alias("pixels"))
    rows = chunks.select("trench_id", "fov", "c", "h", "w", F.explode(frames).alias("f"))
    t = F.col("f.t")
    if start is not None:
        rows = rows.where(t >= start)
    if end is not None:
        rows = rows.where(t < end)
    return rows.select("trench_id", "fov", t.alias("t"), "c", "h", "w", F.col("f.pixels").alias("pixels"))


def read(spark: SparkSession, path: str, trench_ids: list[int] | None = None, fovs: list[str] | None = None, channels: list[str] | None = None, start: int | None = None, end: int | None = None) -> DataFrame:
    """The frames of a store of chunks; positions prune folders, trenches, channels and times prune row groups."""
    chunks = spark.read.parquet(f"{path.rstrip('/')}/crops")
    for column, wanted in (("fov", fovs), ("trench_id", trench_ids), ("c", channels)):
        if wanted is not None:
            chunks = chunks.where(F.col(column).isin(wanted))
    return unpack(chunks, start, end)
