"""What is done to the pixels of one image, in numpy, and the Arrow functions that apply it to a column.

An Arrow batch holds frames of a bounded number of bytes
(``spark.sql.execution.arrow.maxBytesPerBatch``), so a task's memory doesn't depend on the number of frames.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

#: m00 m01 m02 m10 m11 m12 of a transform from places of the output to places of the input.
Six = tuple[float, float, float, float, float, float]


def images(pixels: pa.Array, h: pa.Array, w: pa.Array) -> Iterator[np.ndarray | None]:
    """The images of a column of row-major arrays; None for a null one.  A null pixel counts as 0."""
    values = pixels.values.fill_null(0) if pixels.values.null_count else pixels.values
    flat, bounds = values.to_numpy(zero_copy_only=False), pixels.offsets.to_numpy()
    for k, (rows, columns) in enumerate(zip(h.to_pylist(), w.to_pylist(), strict=True)):
        yield flat[bounds[k] : bounds[k + 1]].reshape(rows, columns) if pixels[k].is_valid and rows is not None and columns is not None else None


def window(image: np.ndarray, y: int, x: int, height: int, width: int) -> np.ndarray:
    """A rectangle of an image as doubles; what lies outside is 0."""
    out = np.zeros((height, width))
    y0, x0, y1, x1 = max(y, 0), max(x, 0), min(y + height, image.shape[0]), min(x + width, image.shape[1])
    if y1 > y0 and x1 > x0:
        out[y0 - y : y1 - y, x0 - x : x1 - x] = image[y0:y1, x0:x1]
    return out


def rectangle(image: np.ndarray, m: Six, y: int, x: int, height: int, width: int) -> np.ndarray:
    """The bilinear values of a rectangle of the transformed image; pixels outside the image count as 0.

    A translation has the same weights everywhere, so four shifted windows are blended; any other transform gathers
    from the part of the image that the rectangle covers.
    """
    if height <= 0 or width <= 0:
        return np.zeros((max(height, 0), max(width, 0)))
    h, w = image.shape
    if m[0] == m[4] == 1 and m[1] == m[3] == 0:
        # the weights come from the shift alone, so they don't depend on the rectangle; one that lies wholly outside stays outside, however far
        down, right = np.floor(m[5]), np.floor(m[2])
        fy, fx = m[5] - down, m[2] - right
        top, left = int(min(max(y + down, -height - 2.0), h + 1.0)), int(min(max(x + right, -width - 2.0), w + 1.0))
        part = window(image, top, left, height + 1, width + 1)
        if fy:
            part[:-1] = part[:-1] * (1 - fy) + part[1:] * fy
        part = part[:-1]
        return part[:, :-1] * (1 - fx) + part[:, 1:] * fx if fx else part[:, :-1]
    rows, columns = np.arange(y, y + height)[:, None], np.arange(x, x + width)
    sy, sx = m[3] * columns + m[4] * rows + m[5], m[0] * columns + m[1] * rows + m[2]
    iy, ix = np.clip(np.floor(sy), -2, h), np.clip(np.floor(sx), -2, w)
    fy, fx = sy - iy, sx - ix
    outside = (sy <= -1) | (sy >= h) | (sx <= -1) | (sx >= w)
    fy[outside] = fx[outside] = 0
    iy, ix = iy.astype(np.int64), ix.astype(np.int64)
    top, left = int(iy.min()), int(ix.min())
    part = window(image, top, left, int(iy.max()) - top + 2, int(ix.max()) - left + 2)
    stride, flat = part.shape[1], part.ravel()
    at = (iy - top) * stride + (ix - left)
    upper = flat[at] * (1 - fx) + flat[at + 1] * fx
    lower = flat[at + stride] * (1 - fx) + flat[at + stride + 1] * fx
    return np.where(outside, 0.0, upper * (1 - fy) + lower * fy)


def _matrices(columns: tuple[pa.Array, ...]) -> list[Six | None]:
    rows = zip(*(c.to_pylist() for c in columns), strict=True)
    return [None if any(v is None or not np.isfinite(v) for v in m) else m for m in rows]


def _lists(parts: list[np.ndarray], sizes: list[int], kind: pa.DataType, missing: list[bool] | None = None) -> pa.Array:
    """A column of lists from their values, one after another."""
    values = pa.array(np.concatenate(parts) if parts else np.zeros(0), kind)
    bounds = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    out = pa.ListArray.from_arrays(bounds, values)
    return out if not missing or not any(missing) else pa.ListArray.from_arrays(bounds, values, mask=pa.array(missing))


def warped(pixels: Column, h: Column, w: Column, matrix: tuple[Column, ...]) -> Column:
    """The whole image through its transform; null where one of them is."""

    @F.arrow_udf("array<double>")
    def warp(pixels: pa.Array, h: pa.Array, w: pa.Array, a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array, e: pa.Array, f: pa.Array) -> pa.Array:
        parts, sizes, missing = [], [], []
        for image, m in zip(images(pixels, h, w), _matrices((a, b, c, d, e, f)), strict=True):
            missing.append(image is None or m is None)
            found = np.zeros(0) if missing[-1] else rectangle(image, m, 0, 0, *image.shape).ravel()
            parts.append(found)
            sizes.append(len(found))
        return _lists(parts, sizes, pa.float64(), missing)

    return warp(pixels, h, w, *(c.cast("double") for c in matrix))


def cut_bands(image: np.ndarray, m: Six, boxes: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, int, int, np.ndarray]]:
    """Places in the list of boxes, height, width and pixels (one row a box) of all crops; of every band of rows the pixels are gathered once.

    boxes: y_top, y_bottom, x_left, x_right and needs_flip as arrays.
    """
    bands, of = np.unique(np.stack([boxes["y_top"], boxes["y_bottom"], boxes["x_right"] - boxes["x_left"]]), axis=1, return_inverse=True)
    of = of.ravel()
    done: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
    for k, (top, bottom, width) in enumerate(bands.T.tolist()):
        if (top, bottom) not in done:
            same = (boxes["y_top"] == top) & (boxes["y_bottom"] == bottom)
            left = int(boxes["x_left"][same].min())
            done = {(top, bottom): (left, rectangle(image, m, top, left, bottom - top, int(boxes["x_right"][same].max()) - left))}
        left, band = done[top, bottom]
        own = np.flatnonzero(of == k)
        height, width = max(0, bottom - top), max(0, width)
        crops = band[:, boxes["x_left"][own][:, None] - left + np.arange(width)].transpose(1, 0, 2)
        flip = boxes["needs_flip"][own]
        crops = np.where(flip[:, None, None], crops[:, ::-1], crops)
        yield own, height, width, crops.reshape(len(own), height * width)


def crops(pixels: Column, h: Column, w: Column, matrix: tuple[Column, ...], boxes: Column, id_type: str, integers: bool) -> Column:
    """An array of the crops (trench_id, h, w, pixels) of a frame; its transform and the boxes' structs must not be null.

    With ``integers`` values are cut to integers.
    """
    value = "int" if integers else "double"

    @F.arrow_udf(f"array<struct<trench_id: {id_type}, h: int, w: int, pixels: array<{value}>>>")
    def cut(pixels: pa.Array, h: pa.Array, w: pa.Array, a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array, e: pa.Array, f: pa.Array, boxes: pa.Array) -> pa.Array:
        fields = {name: boxes.values.field(name) for name in ("trench_id", "y_top", "y_bottom", "x_left", "x_right", "needs_flip")}
        numbers = {name: column.to_numpy(zero_copy_only=False) for name, column in fields.items() if name != "trench_id"}
        bounds = boxes.offsets.to_numpy()
        places, heights, widths, values, counts = [], [], [], [], []
        for k, (image, m) in enumerate(zip(images(pixels, h, w), _matrices((a, b, c, d, e, f)), strict=True)):
            low, high = int(bounds[k]), int(bounds[k + 1])
            counts.append(0)
            if image is None or m is None or low == high:
                continue
            for own, height, width, found in cut_bands(image, m, {name: column[low:high] for name, column in numbers.items()}):
                places.append(own + low)
                heights.append(np.full(len(own), height))
                widths.append(np.full(len(own), width))
                values.append((np.trunc(found).astype(np.int32) if integers else found).ravel())
                counts[-1] += len(own)
        joined = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        tall, wide = joined(heights), joined(widths)
        kind = pa.int32() if integers else pa.float64()
        rows = pa.StructArray.from_arrays(
            [fields["trench_id"].take(pa.array(joined(places))), pa.array(tall, pa.int32()), pa.array(wide, pa.int32()), _lists(values, (tall * wide).tolist(), kind)],
            names=["trench_id", "h", "w", "pixels"],
        )
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), rows)

    return cut(pixels, h, w, *(c.cast("double") for c in matrix), boxes)
