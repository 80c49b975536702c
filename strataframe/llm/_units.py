"""Repeated runs of a text's units (lines or sentences), found and removed.

A text is cut into units that together hold all its bytes.  A run of units is
repeated if the same run stands in a document of a smaller id, or earlier in
the same text.  Runs are compared by a hash of their units' contents.  The
first owner of each hash is an aggregate (combined in each task before the
shuffle) and stored as a table; runs are looked up in it, the most common ones
in a bounded table that all tasks have, so no task gets all rows of a common run.
Texts are shuffled once, to meet their spans; spans of a text are a set, so repeated
rows don't add up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import _text
from ._shared import looked_up, stored


class Units:
    """The units of all texts of a chunk: byte bounds, row, number of words and content hash."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, starts_at: np.ndarray):
        """starts_at: sorted places where a new unit begins, besides the starts of texts."""
        full = offsets[:-1][np.diff(offsets) > 0]
        self.start = np.union1d(full, starts_at).astype(np.int64)
        self.end = np.append(self.start[1:], len(buf))[: len(self.start)]
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        self.bounds = _text.row_ranges(self.row, len(offsets) - 1)
        w_start, w_end, _ = _text.words(buf, offsets)
        first, last = np.searchsorted(w_start, self.start), np.searchsorted(w_start, self.end)
        self.words = last - first
        filled = self.words > 0
        hashes = np.zeros(len(self.start), np.uint64)
        hashes[filled] = _text.byte_prefix(buf).spans(w_start[first[filled]], np.minimum(w_end[last[filled] - 1], self.end[filled]))
        self.hash = hashes


def line_units(buf: np.ndarray, offsets: np.ndarray) -> Units:
    return Units(buf, offsets, _inside(np.flatnonzero(buf == 10) + 1, buf, offsets))


def sentence_units(buf: np.ndarray, offsets: np.ndarray) -> Units:
    """A sentence ends with its line, or with white space after a full stop, question or exclamation mark."""
    if not len(buf):
        return Units(buf, offsets, np.zeros(0, np.int64))
    stop = (buf == 46) | (buf == 33) | (buf == 63)
    space = (buf == 32) | ((buf >= 9) & (buf <= 13))
    ends = (buf == 10) | np.append(False, stop[:-1] & space[1:])
    return Units(buf, offsets, _inside(np.flatnonzero(ends) + 1, buf, offsets))


def _inside(at: np.ndarray, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return at[(at < len(buf)) & ~np.isin(at, offsets)]


#: Of units to (first unit, unit after the last) of all runs that count.
Runs = Callable[[Units], tuple[np.ndarray, np.ndarray]]


def _keys(id_col: str, text_col: str) -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("ord"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(text_col).alias("text")]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """ord: the id as an order, nulls last; key: id and text, so repeated rows share a key; and the text."""
    return docs.select(*_keys(id_col, text_col))


def hashed(units: Units, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run, and whether the same run stands earlier in its text."""
    whole = _text.Prefix(units.hash).spans(start, end)
    row = units.row[start]
    order = np.lexsort((start, whole, row))
    again = np.zeros(len(start), bool)
    again[order[1:]] = (whole[order[1:]] == whole[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    return whole.view(np.int64), again


def owners(found: DataFrame, value: str) -> DataFrame:
    """A stored table of the values that stand twice or more: value, first (the least ord that has it), and the number n of its rows."""
    of = found.groupBy(value).agg(F.min("ord").alias("first"), F.max("ord").alias("last"), F.max(F.col("again").cast("int")).alias("twice"), F.count(F.lit(1)).alias("n"))
    return stored(of.where("first < last or twice = 1").drop("last", "twice"))


def later(found: DataFrame) -> DataFrame:
    """ord, key, start and end of every run (``run``, ``again``) that is not the first of its content."""
    return looked_up(found, owners(found, "run"), "run", ["key", "start", "end"]).where("ord > first or again").select("ord", "key", "start", "end")


def repeated(docs: DataFrame, split: Callable, runs: Runs, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """ord, key, and the units ``start`` to ``end`` (after the last) of every run that is not the first of its content."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _text.chunks(batches, "text"):
            units = split(*_text.text_bytes(chunk.column("text")))
            start, end = runs(units) if len(units.start) else (units.start, units.start)
            if not len(start):
                continue
            whole, again = hashed(units, start, end)
            row = units.row[start]
            base = units.bounds[row]
            yield pa.record_batch({
                "ord": chunk.column("ord").take(pa.array(row)), "key": chunk.column("key").take(pa.array(row)), "run": whole, "again": again,
                "start": (start - base).astype(np.int32), "end": (end - base).astype(np.int32),
            })

    return later(keyed(docs, id_col, text_col).mapInArrow(emit, "ord long, key long, run long, again boolean, start int, end int"))


def remove(docs: DataFrame, spans: DataFrame, split: Callable, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row`` (a struct of the columns of ``docs``, the text without the units of its spans), and the numbers ``units`` and ``removed``."""
    others = [c for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*others).alias("row"), *_keys(id_col, text_col))
    spans = stored(spans.groupBy("ord", "key").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    rows = rows.join(spans, ["ord", "key"], "left").select("row", "text", F.col("spans.start").alias("starts"), F.col("spans.end").alias("ends"))
    schema = T.StructType([rows.schema["row"], rows.schema["text"]]).add("units", "integer").add("removed", "integer")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _text.chunks(batches, "text"):
            buf, offsets = _text.text_bytes(chunk.column("text"))
            units = split(buf, offsets)
            starts, ends = chunk.column("starts"), chunk.column("ends")
            count = starts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            base = np.repeat(units.bounds[:-1], count)
            depth = np.zeros(len(units.start) + 1, np.int64)
            np.add.at(depth, base + starts.flatten().to_numpy(zero_copy_only=False), 1)
            np.add.at(depth, base + ends.flatten().to_numpy(zero_copy_only=False), -1)
            gone = np.cumsum(depth[:-1]) > 0
            stays = np.repeat(~gone, units.end - units.start)
            # where a text's last unit goes, white space at the end of the rest goes too
            last = units.bounds[1:][np.diff(units.bounds) > 0] - 1
            solid = np.flatnonzero(stays & ~_text.is_space(buf))
            for row in units.row[last[gone[last]]]:
                at = int(np.searchsorted(solid, offsets[row + 1])) - 1
                stays[max(offsets[row], solid[at] + 1 if at >= 0 else 0) : offsets[row + 1]] = False
            lengths = np.concatenate(([0], np.cumsum(stays)))[offsets]
            text = pa.LargeStringArray.from_buffers(len(chunk), pa.py_buffer(lengths.astype(np.int64)), pa.py_buffer(buf[stays])).cast(pa.string())
            if chunk.column("text").null_count:
                text = pa.compute.if_else(chunk.column("text").is_null(), pa.scalar(None, pa.string()), text)
            gone_sum = np.concatenate(([0], np.cumsum(gone)))[units.bounds]
            yield pa.RecordBatch.from_arrays([chunk.column("row"), text, pa.array(np.diff(units.bounds).astype(np.int32)), pa.array(np.diff(gone_sum).astype(np.int32))], names=schema.names)

    row = F.struct(*(F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
    return rows.mapInArrow(cut, schema).select(row.alias("row"), "units", "removed")


def counted(done: DataFrame, id_col: str, text_col: str, units: str) -> DataFrame:
    """The id, the text, and the numbers of units (under their name) and of removed ones."""
    return done.select(f"row.`{id_col}`", f"row.`{text_col}`", F.col("units").alias(units), "removed")


def remaining(done: DataFrame, text_col: str, length_col: str = "n_chars") -> DataFrame:
    """The columns of the table alone, without rows of which nothing is left; the number of characters follows the text where it has changed."""
    names, schema = done.schema["row"].dataType.names, done.schema["row"].dataType
    text = F.col(f"row.`{text_col}`")
    columns = []
    for c in names:
        value = F.col(f"row.`{c}`")
        if c == length_col and isinstance(schema[c].dataType, T.IntegralType):
            value = F.when(F.col("removed") > 0, F.length(text).cast(schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return done.where((F.col("removed") == 0) | (F.length(text) > 0)).select(*columns)
