"""Python's slice bounds as columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def bounds(start: int | None, end: int | None, size: Column) -> tuple[Column, Column]:
    """First and past-last index of ``[start:end]`` on an axis of the given size."""

    def place(value: int | None, default: Column) -> Column:
        if value is None:
            return default
        shifted = F.lit(value) + size if value < 0 else F.lit(value)
        return F.least(F.greatest(shifted, F.lit(0)), size)

    return place(start, F.lit(0)), place(end, size)
