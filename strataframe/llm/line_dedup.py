"""Line dedup by winnowing over line hashes.

A run of consecutive lines counts from ``min_words`` words on.

1. Select.  A window is the shortest run that counts and starts, or ends, with
   a line.  Each window selects the line of the least hash in it (the first of
   equals; blank lines never), so one line serves many windows.  A run that
   counts holds a window, and wherever the run stands, its window selects the same
   line: the selected positions are fingerprints that no repeated run can miss.
2. Join.  Positions are joined on their fingerprint; those whose fingerprint
   stands only once, the most, go no further.
3. Extend.  A joined position is extended both ways as far as the windows go that
   selected it, and each window is compared as a whole, by the hash of its lines, with those of all
   positions of its fingerprint; windows of a longer common run overlap or touch, so together they are
   the maximal common runs.  Pairs of positions are not walked line by line: each would
   have to be walked with all others of its fingerprint, not with the first alone, and
   a common line has very many.
4. Delete.  Of equal runs the first in order of id, then place, stays; the
   lines of all later ones go: those that lie in a run of at least ``min_words`` words
   that also stands in a document of a smaller id or earlier in the same text.

Lines are compared without white space at their ends, which also hides "\\r".
Where a text's last line goes, white space at the end of the rest goes too.

Cases: a null or empty text stays as it is; a null id counts as the largest;
rows of the same id don't delete each other's lines, and rows equal in id and
text are cut alike; lines shorter than ``min_words`` stay unless they lie in a longer
repeated run; a very long text is handled whole, in time in proportion to its
lines; only the named columns are read, and others may have any name; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import _text, _units
from ._shared import looked_up, stored

MIN_WORDS = 8


def windows(units: _units.Units, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window the first line, the line after the last, and the line that it selects."""
    n = len(units.start)
    total = np.concatenate(([0], np.cumsum(units.words)))
    low, high = units.bounds[units.row], units.bounds[units.row + 1]
    at = np.arange(n)
    end = np.searchsorted(total, total[:-1] + min_words)
    start = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    ahead, behind = end <= high, start >= low
    pairs = np.unique(np.concatenate([at[ahead] * (n + 1) + end[ahead], start[behind] * (n + 1) + at[behind] + 1]))
    first, after = pairs // (n + 1), pairs % (n + 1)
    if not len(pairs):
        return first, after, first
    solid = np.flatnonzero(units.words > 0)  # a window has at most min_words of these, however many blank lines
    order = np.lexsort((solid, units.hash[solid]))
    rank = np.empty(len(solid) + 1, np.int64)
    rank[order] = np.arange(len(solid))
    rank[-1] = len(solid)
    bounds = np.stack([np.searchsorted(solid, first), np.searchsorted(solid, after)], axis=1).ravel()
    return first, after, solid[order[np.minimum.reduceat(rank, bounds)[::2]]]


def _positions(min_words: int):
    """Selected positions: ord, key, the fingerprint, whether it stands twice in its text, and the windows that selected it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _text.chunks(batches, "text"):
            units = _units.line_units(*_text.text_bytes(chunk.column("text")))
            start, end, line = windows(units, min_words) if len(units.start) else (units.start,) * 3
            if not len(start):
                continue
            run, again = _units.hashed(units, start, end)
            order = np.lexsort((start, line))
            start, end, line, run, again = (x[order] for x in (start, end, line, run, again))
            first = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
            place = line[first]
            row, mark = units.row[place], units.hash[place]
            twice = np.zeros(len(place), bool)
            by = np.lexsort((place, mark, row))
            same = (mark[by[1:]] == mark[by[:-1]]) & (row[by[1:]] == row[by[:-1]])
            twice[by[1:]] = same
            base = units.bounds[units.row[line]]
            found = pa.StructArray.from_arrays([pa.array((start - base).astype(np.int32)), pa.array((end - base).astype(np.int32)), pa.array(run), pa.array(again)], ["start", "end", "run", "again"])
            yield pa.RecordBatch.from_arrays(
                [chunk.column("ord").take(pa.array(row)), chunk.column("key").take(pa.array(row)), pa.array(mark.view(np.int64)), pa.array(twice), pa.ListArray.from_arrays(pa.array(np.append(first, len(line)).astype(np.int32)), found)],
                names=["ord", "key", "mark", "again", "windows"],
            )

    return task


def repeated_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """ord, key, and the lines ``start`` to ``end`` (after the last) of every window that is not the first of its content."""
    window = "array<struct<start: int, end: int, run: long, again: boolean>>"
    positions = stored(_units.keyed(docs, id_col, text_col).mapInArrow(_positions(min_words), f"ord long, key long, mark long, again boolean, windows {window}"))
    joined = looked_up(positions, _units.owners(positions, "mark"), "mark", ["key", "windows"])
    extended = stored(joined.select("ord", "key", F.explode("windows").alias("window")).select("ord", "key", "window.*"))
    return _units.later(extended)


def _done(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    return _units.remove(docs, repeated_runs(docs, id_col, text_col, min_words), _units.line_units, id_col, text_col)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The id, the text without later repeated runs, and the numbers of its ``lines`` and of those ``removed``."""
    return _units.counted(_done(docs, id_col, text_col, min_words), id_col, text_col, "lines")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, length_col: str = "n_chars") -> DataFrame:
    """All columns of ``docs``, the text without later repeated runs; rows of which nothing is left go."""
    return _units.remaining(_done(docs, id_col, text_col, min_words), text_col, length_col)
