"""Label-aware selection of positions, times, pixels and channels.

Selections are DataFrame transformations, so they are immutable and chain:
keeping positions twice keeps their intersection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.slices import bounds


def rename_duplicates(labels: DataFrame, label: str, position: str) -> DataFrame:
    """Labels that occur more than once get ``-01``, ``-02``, ... in the order of ``position``; others stay."""
    own = Window.partitionBy(label)
    text = F.col(label).cast("string")
    numbered = F.format_string("%s-%02d", text, F.row_number().over(own.orderBy(position)))
    return labels.withColumn(label, F.when(F.count(F.lit(1)).over(own) > 1, numbered).otherwise(text))


def select_fovs(frames: DataFrame, keep: list[str | int]) -> DataFrame:
    """Rows of the named positions; an int is a raw position index.  Unknown names keep nothing."""
    names, places = [k for k in keep if isinstance(k, str)], [k for k in keep if not isinstance(k, str)]
    return frames.where(F.col("fov").isin(names) | F.col("p_index").isin(places))


def discard_fovs(frames: DataFrame, drop: list[str]) -> DataFrame:
    return frames.where(~F.col("fov").isin(drop))


def select_times(frames: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """Rows of the times ``[start, end)`` with the meaning of a Python slice."""
    if (start or 0) >= 0 and (end is None or end >= 0):
        out = frames.where(F.col("t") >= (start or 0))
        return out if end is None else out.where(F.col("t") < end)
    n = frames.agg((F.max("t") + 1).alias("__n"))
    low, high = bounds(start, end, F.col("__n"))
    return frames.crossJoin(F.broadcast(n)).where((F.col("t") >= low) & (F.col("t") < high)).drop("__n")  # one row beside each frame


def select_roi(frames: DataFrame, y: tuple[int | None, int | None] | None = None, x: tuple[int | None, int | None] | None = None) -> DataFrame:
    """Frames cut to a region; each axis is a Python slice, so an end of -1 drops the last pixel."""
    y0, y1 = bounds(*(y or (None, None)), F.col("h"))
    x0, x1 = bounds(*(x or (None, None)), F.col("w"))
    rows = F.when(y1 > y0, F.sequence(y0, y1 - 1)).otherwise(F.array().cast("array<int>"))
    width = F.greatest(F.lit(0), x1 - x0)
    cut = F.flatten(F.transform(rows, lambda r: F.slice("pixels", r * F.col("w") + x0 + 1, width)))
    # in one step, the new w would stand for the old one inside the array function
    return frames.withColumn("pixels", cut).withColumns({"h": F.greatest(F.lit(0), y1 - y0), "w": width})


def intersect_roi(size: Column, first: tuple[Column, Column], second: tuple[Column, Column]) -> tuple[Column, Column]:
    """The part of two ranges in raw pixels; a stop of -1 or null is open, unlike a slice's."""
    start = F.greatest(*(F.coalesce(r[0], F.lit(0)) for r in (first, second)))
    stop = F.least(*(F.coalesce(F.nullif(r[1], F.lit(-1)), size) for r in (first, second)))
    return start, stop


def strided(frames: DataFrame, start: int, end: int, step: int) -> DataFrame:
    """Every ``step``-th time from ``start`` on, before ``end``."""
    t = F.col("t")
    return frames.where((t >= start) & (t < end) & ((t - start) % step == 0))


def evenly_spaced(n: int, count: int) -> list[int]:
    """``count`` indices from 0 to n - 1 at equal distances, cut to integers."""
    return [i * (n - 1) // (count - 1) for i in range(count)] if count > 1 else [0]


def existing(frame: DataFrame, wanted: list[str]) -> DataFrame:
    """Those of the wanted columns that the table has."""
    return frame.select(*[c for c in wanted if c in frame.columns])


def ordered_distinct(rows: DataFrame, value: str, position: str) -> DataFrame:
    """Each value once, with the first position where it stood."""
    return rows.groupBy(value).agg(F.min(position).alias(position))


def first_plane(frames: DataFrame) -> DataFrame:
    """The frames of the first focus plane; all of them where the table has no planes, and those whose plane is null."""
    return frames.where("z = 0 or z is null") if "z" in frames.columns else frames


def resolve(label: str | int, names: list[str], what: str = "channel") -> str:
    """A name, or the name at an index (negative ones count from the end)."""
    if isinstance(label, int):
        return names[label]
    if label not in names:
        raise ValueError(f"no {what} {label!r}; there are {names}")
    return label


def sequence_index(axes: dict[str, int], coordinates: dict[str, Column]) -> Column:
    """The place of a frame in its file: coordinates times strides, the last axis fastest."""
    out, stride = F.lit(0), 1
    for axis in reversed(axes):
        out = out + coordinates.get(axis, F.lit(0)) * stride
        stride *= axes[axis]
    return out.cast("long")


def calibration(coordinates: DataFrame, index: str, value: str, fallback: float) -> DataFrame:
    """One row: the distance of the first two coordinates, or the fallback if there are fewer."""
    firsts = coordinates.agg(F.max(F.when(F.col(index) == 0, F.col(value))).alias("a"), F.max(F.when(F.col(index) == 1, F.col(value))).alias("b"))
    return firsts.select(F.coalesce(F.abs(F.col("b") - F.col("a")), F.lit(fallback)).alias("step"))
