"""Values of any library as values that JSON can hold."""

from __future__ import annotations

import dataclasses
import math
from collections.abc import Mapping
from pathlib import PurePath
from typing import Any


def plain(value: Any) -> Any:
    """None, bool, int, float, str, and lists and dicts of these.

    Records (dataclasses, named tuples) and mappings become dicts with text keys,
    arrays and other sequences lists, paths and bytes text; anything else is its text.
    """
    if value is None or isinstance(value, bool | int | float | str):
        return value
    if dataclasses.is_dataclass(value) and not isinstance(value, type):
        value = {f.name: getattr(value, f.name) for f in dataclasses.fields(value)}
    elif hasattr(value, "_asdict"):
        value = value._asdict()
    if isinstance(value, Mapping):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, bytes | bytearray):
        return bytes(value).decode("utf-8", "replace")
    if isinstance(value, PurePath):
        return str(value)
    if hasattr(value, "tolist"):  # arrays and scalars of numerical libraries
        return plain(value.tolist())
    if isinstance(value, list | tuple | set | frozenset):
        return [plain(v) for v in value]
    return str(value)


def without_nan(value: Any) -> Any:
    """A plain value with None in place of every NaN, at any depth."""
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dict):
        return {k: without_nan(v) for k, v in value.items()}
    return [without_nan(v) for v in value] if isinstance(value, list) else value


def is_scalar(value: Any) -> bool:
    """Whether a plain value fits one cell: not a list or a dict."""
    return not isinstance(value, list | dict)


def range_fields(start_stop: tuple[int | None, int | None] | None) -> dict[str, int | None] | None:
    """A half-open range as the fields of a slice; None stays None."""
    return None if start_stop is None else {"start": start_stop[0], "stop": start_stop[1], "step": None}
