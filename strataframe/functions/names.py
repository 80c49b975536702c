"""Column names and canonical JSON of metadata."""

from __future__ import annotations

import json

from pyspark.sql import Column, functions as F


def snake_name(name: str) -> str:
    """A field's name as a column name: words of ASCII letters and digits, joined by "_".

    A capital after a small letter or a digit begins a word; what stands in
    square brackets is named by itself and begins a word too; micro signs are the letter u.
    """
    out, at, text = "", 0, str(name)
    while at < len(text):
        sign, close = text[at], text.find("]", at)
        if sign == "[" and close >= 0:
            out += "_" + snake_name(text[at + 1 : close])
            at = close + 1
            continue
        sign = "u" if sign in "µμ" else sign
        if not (sign.isascii() and sign.isalnum()):
            out += "_"
        else:
            begins = sign.isupper() and out[-1:].isalnum() and (text[at - 1].islower() or out[-1].isdigit() or text[at - 1] == "]")
            out += ("_" if begins else "") + sign.lower()
        at += 1
    words = [w for w in out.split("_") if w]
    if not words:
        return "value"
    return "_".join(["field", *words] if words[0][0].isdigit() else words)


def snake_column(name: Column) -> Column:
    """``snake_name`` over a column of names without brackets."""
    text = F.regexp_replace(F.regexp_replace(name, "[µμ]", "u"), "([a-z0-9])([A-Z])", "$1_$2")
    text = F.lower(F.regexp_replace(F.regexp_replace(text, "[^0-9A-Za-z]+", "_"), "^_+|_+$", ""))
    return F.when(text == "", "value").when(text.rlike("^[0-9]"), F.concat(F.lit("field_"), text)).otherwise(text)


def canonical_json(value: object) -> str:
    """Compact JSON with sorted keys in ASCII, the same for equal values."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), default=str)


def human_size(n_bytes: Column) -> Column:
    """A size with one decimal in units of 1024."""
    out = F.format_string("%.1f PB", n_bytes / float(1024**5))
    for power, unit in reversed(list(enumerate(["B", "KB", "MB", "GB", "TB"]))):
        out = F.when(n_bytes < float(1024 ** (power + 1)), F.format_string(f"%.1f {unit}", n_bytes / float(1024**power))).otherwise(out)
    return out
