"""Affine transforms of frames.

A transform maps places of the output to places of the input, as columns m00
m01 m02 m10 m11 m12.  Pixels are warped by the Arrow functions of ``kernels``; matrices
are columns, and products of many of them are built block by block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import kernels

NAMES = ("m00", "m01", "m02", "m10", "m11", "m12")
#: Steps of a position that are multiplied in one task.
BLOCK = 4096

Matrix = tuple[Column, Column, Column, Column, Column, Column]


def translation(tx: Column, ty: Column) -> Matrix:
    one, zero = F.lit(1.0), F.lit(0.0)
    return one, zero, tx, zero, one, ty


def rotation(degrees: float, h: Column, w: Column) -> Matrix:
    """Rotation about the centre of an image."""
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    cx, cy = w / 2.0 - 0.5, h / 2.0 - 0.5
    return F.lit(c), F.lit(-s), cx - c * cx + s * cy, F.lit(s), F.lit(c), cy - s * cx - c * cy


def compose(a: Matrix, b: Matrix) -> Matrix:
    """a times b: b is applied to the place first."""
    return (
        a[0] * b[0] + a[1] * b[3], a[0] * b[1] + a[1] * b[4], a[0] * b[2] + a[1] * b[5] + a[2],
        a[3] * b[0] + a[4] * b[3], a[3] * b[1] + a[4] * b[4], a[3] * b[2] + a[4] * b[5] + a[5],
    )


def scaled(transforms: DataFrame, factor: int) -> DataFrame:
    """Translations found on frames downsampled by ``factor`` in raw pixels."""
    return transforms.withColumns({"tx": F.col("tx") * factor, "ty": F.col("ty") * factor})


def cumulated(steps: DataFrame) -> DataFrame:
    """Translations to the first frame from those to the frame before (none for the first)."""
    order = Window.partitionBy("fov").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    return steps.withColumns({k: F.sum(F.coalesce(k, F.lit(0.0))).over(order) for k in ("tx", "ty")})


def _products(steps: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The running products of 3 x 3 matrices, from a matrix before them on, by doubling: every round joins what lies twice as far apart."""
    out, reach = steps.copy(), 1
    while reach < len(out):
        out[reach:] = out[:-reach] @ out[reach:]
        reach *= 2
    return before @ out


def cumulated_matrices(steps: DataFrame, block: int = BLOCK) -> DataFrame:
    """fov, t and m00 to m12: the product of a position's steps up to each time, the first being the identity.

    steps: matrices (or translations) to the frame before; those of the first frame don't count, and a null one stands for the identity.
    The product is associative: blocks of times are multiplied by themselves, the blocks' products (a
    row a block) are multiplied in order, and each block goes on from the product of those before it.
    """
    identity = dict(zip(NAMES, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)))
    first = F.col("t") == F.min("t").over(Window.partitionBy("fov"))
    rows = steps.select("fov", "t", *(c.cast("double").alias(n) for c, n in zip(matrix_of(steps), NAMES))).withColumn("__first", first)
    known = F.lit(True)
    for n in NAMES:
        known = known & F.col(n).isNotNull()
    rows = rows.withColumn("__known", known & ~F.col("__first")).select("fov", "t", F.floor(F.col("t") / block).alias("block"), *(F.when(F.col("__known"), F.col(n)).otherwise(F.lit(v)).alias(n) for n, v in identity.items()))

    def square(table: pa.Table) -> np.ndarray:
        out = np.zeros((table.num_rows, 3, 3))
        out[:, :2] = np.stack([table.column(n).to_numpy() for n in NAMES], axis=1).reshape(-1, 2, 3)
        out[:, 2, 2] = 1
        return out

    def matrices(found: np.ndarray) -> dict[str, np.ndarray]:
        return {n: found[:, k // 3, k % 3] for k, n in enumerate(NAMES)}

    def total(table: pa.Table) -> pa.Table:
        table = table.sort_by("t")
        found = _products(square(table), np.eye(3))[-1:]
        return pa.table({"fov": table.column("fov")[:1], "block": table.column("block")[:1], **matrices(found)})

    def begins(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        found = np.concatenate((np.eye(3)[None], _products(square(table), np.eye(3))[:-1]))
        return pa.table({"fov": table.column("fov"), "block": table.column("block"), **matrices(found)})

    def products(table: pa.Table) -> pa.Table:
        table = table.sort_by([("first", "descending"), ("t", "ascending")])
        found = square(table)
        found = _products(found[1:], found[0])
        return pa.table({"fov": table.column("fov")[1:], "t": table.column("t")[1:], **matrices(found)})

    six = ", ".join(f"{n} double" for n in NAMES)
    kind = rows.schema["t"].dataType.simpleString()
    totals = rows.groupBy("fov", "block").applyInArrow(total, f"fov string, block long, {six}")
    before = totals.groupBy("fov").applyInArrow(begins, f"fov string, block long, {six}")
    both = rows.withColumn("first", F.lit(False)).unionByName(before.withColumns({"t": F.lit(None).cast(kind), "first": F.lit(True)}))
    return both.groupBy("fov", "block").applyInArrow(products, f"fov string, t {kind}, {six}")


def matrix_of(transforms: DataFrame) -> Matrix:
    """The matrix of each transform: its columns m00 to m12 if it has them, else the translation tx, ty."""
    if "m00" in transforms.columns:
        return tuple(F.col(name) for name in NAMES)
    return translation(F.col("tx"), F.col("ty"))


def placed(frames: DataFrame, transforms: DataFrame, degrees: float = 0.0) -> tuple[DataFrame, Matrix]:
    """The frames with a column ``__m`` for their transform, and the matrix of it and then the rotation; frames without a transform are left out."""
    own = transforms.select("fov", "t", F.struct(*(c.cast("double").alias(n) for c, n in zip(matrix_of(transforms), NAMES))).alias("__m"))
    m = tuple(F.col(f"__m.{name}") for name in NAMES)
    if degrees:
        m = compose(m, rotation(degrees, F.col("h"), F.col("w")))
    return frames.join(own, ["fov", "t"]), m


def warp(frames: DataFrame, transforms: DataFrame, degrees: float = 0.0) -> DataFrame:
    """Every frame through its transform (tx, ty or m00 to m12 by fov and t) and then the rotation; frames without a transform are left out.

    Filters on other columns pass below the warp, and it is not computed where nobody asks for pixels.
    """
    joined, m = placed(frames, transforms, degrees)
    return joined.withColumn("pixels", kernels.warped(F.col("pixels"), F.col("h"), F.col("w"), m)).drop("__m")


def unmatched(frames: DataFrame, transforms: DataFrame) -> DataFrame:
    """fov and t of frames without a transform and of transforms without a frame; empty if both align."""
    a, b = frames.select("fov", "t").distinct(), transforms.select("fov", "t").distinct()
    return a.join(b, ["fov", "t"], "left_anti").unionAll(b.join(a, ["fov", "t"], "left_anti"))


def flip_rows(pixels: Column, w: Column) -> Column:
    """A row-major image upside down."""
    n = F.floor(F.size(pixels) / w).cast("int")
    return F.when(n > 0, F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda r: F.slice(pixels, (n - 1 - r) * w + 1, w)))).otherwise(pixels)


def kymograph(pixels: DataFrame, start: int, end: int, step: int) -> DataFrame:
    """Strided frames side by side: fov, c, y and the row's values, frame after frame."""
    t = F.col("t")
    kept = pixels.where((t >= start) & (t < end) & ((t - start) % step == 0))
    place = F.floor((t - start) / step) * F.col("w") + F.col("x")
    rows = kept.groupBy("fov", "c", "y").agg(F.array_sort(F.collect_list(F.struct(place.alias("x"), F.col("v")))).alias("row"))
    return rows.withColumn("row", F.transform("row", lambda s: s["v"]))
