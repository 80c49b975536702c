"""Fill-in-middle transformation: a text is cut into prefix, middle and suffix, and these are put in another order.

A cut is a rank, a number of code points; to cut UTF-8 it has to become a place
in bytes.  One Aho-Corasick automaton scans the bytes, with every byte replaced by
its class (the letters of the sentinels as they are, other ASCII, first bytes of 2, 3
and 4, other bytes of a character).  Its patterns are the sentinels and all
pairs at which the width of characters changes: ASCII beside something wider, or two
wider ones.  Between two such events all characters are of one width, so a gap's
number of code points is its bytes divided by the width.  Sums over the few events
therefore find the place of any rank, by binary search and a multiplication; no text is decoded.

Which form a text takes, and where it is cut, come from a hash of its id alone, so a
task that runs again gives the same rows.  There is no shuffle.

Cases: a null text counts as empty; empty texts and those that contain a sentinel stay plain; a null
id is hashed as an empty one; rows of the same id and text are cut alike; a
very long text is scanned whole, in memory in proportion to it; bytes that aren't
UTF-8 come back unchanged; only the named columns are read, and others may have any name; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import _text

#: What begins the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Of a hundred texts so many are transformed, and of a hundred of those so many with the suffix first.
PERCENT, SUFFIX_FIRST = 90, 20
FORMS = ("plain", "psm", "spm")
#: The class of ASCII that is in no sentinel, of later bytes of a character, and of first bytes by width.
_ASCII, _LATER, _FIRST = 0x01, 0x80, {2: 0xC2, 3: 0xE0, 4: 0xF0}


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """Sentinels must be ASCII and begin with a character that they don't hold again, none the beginning of another, so what they part can be told."""
    for one in sentinels:
        if len(one) < 2 or not one.isascii() or any(other[0] in one[1:] for other in sentinels) or "\x01" in one:
            raise ValueError(f"not fit for a sentinel: {one!r}")
    if any(a != b and b.startswith(a) for a in sentinels for b in sentinels) or len(set(sentinels)) < 3:
        raise ValueError("a sentinel begins with another one")


class Scanner:
    """Finds where the width of characters changes, and which texts hold a sentinel."""

    def __init__(self, sentinels: tuple[str, str, str] = SENTINELS):
        check_sentinels(sentinels)
        self.longest = max(map(len, sentinels))
        own = sorted({ord(c) for one in sentinels for c in one})
        table = np.full(256, _ASCII, np.uint8)
        table[own] = own
        table[0x80:0xC0] = _LATER
        for width, low, high in ((2, 0xC0, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0x100)):
            table[low:high] = _FIRST[width]
        self.table = table
        ascii_classes = [_ASCII, *own]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)

        def add(pattern: list[int], value: int) -> None:
            automaton.add_word(bytes(pattern).decode("latin-1"), value)

        for one in sentinels:
            add([*one.encode()], len(one) << 3)  # no width: the length
        for a in ascii_classes:
            add([_LATER, a], 1)
            for width, first in _FIRST.items():
                add([a, first], width)
        for width, first in _FIRST.items():
            for after, other in _FIRST.items():
                if after != width:
                    add([first, *[_LATER] * (width - 1), other], after)
        automaton.make_automaton()
        self.automaton = automaton

    def scan(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the chunk's events the place, the width of what follows and the code points before; and which texts hold a sentinel."""
        classes = self.table[buf].tobytes().decode("latin-1")
        found = np.fromiter((end << 8 | value for end, value in self.automaton.iter(classes)), np.int64)
        end, value = found >> 8, found & 255
        marks = value > 7
        last, length = end[marks], value[marks] >> 3
        row = np.searchsorted(offsets, last, side="right") - 1
        inside = last - length + 1 >= offsets[row]  # not one that two texts make together
        holds = np.zeros(len(offsets) - 1, bool)
        holds[row[inside]] = True
        first = np.unique(offsets[:-1][np.diff(offsets) > 0])  # a text may begin with any width
        width = np.array([1] * 0xC0 + [2] * 0x20 + [3] * 0x10 + [4] * 0x10)[buf[first]] if len(first) else first
        place, at = np.unique(np.concatenate((first, end[~marks])), return_index=True)
        width = np.concatenate((width, value[~marks]))[at]
        before = np.concatenate(([0], np.cumsum(-(-np.diff(np.append(place, len(buf))) // width))))
        return np.append(place, len(buf)), np.append(width, 1), before, holds


def _places(events: tuple[np.ndarray, np.ndarray, np.ndarray], rank: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """The byte where the code point of each rank (over the chunk) begins, at most ``limit``."""
    place, width, before = events
    at = np.maximum(np.searchsorted(before, rank, side="right") - 1, 0)
    return np.minimum(place[at] + (rank - before[at]) * width[at], limit)


def _ranks(events: tuple[np.ndarray, np.ndarray, np.ndarray], offsets: np.ndarray) -> np.ndarray:
    """The number of code points before each text's start; starts of texts are events, but for empty ones at the end."""
    place, _, before = events
    return before[np.searchsorted(place, offsets)]


def _numbers(id_col: str, prefix: str) -> list[Column]:
    """The first four groups of 8 hexadecimal digits of the id's hash."""
    digest = F.sha2(F.concat(F.lit(prefix), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, suffix_first: int = SUFFIX_FIRST, seed: int = 1, sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """doc_id, n (code points), form, prefix_chars and middle_chars (null where plain) and output of every row.

    plain: the text; psm: prefix, suffix, middle; spm: suffix, prefix, middle, each after its sentinel.
    """
    check_sentinels(sentinels)
    marks = [one.encode() for one in sentinels]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(sentinels)
        for chunk in _text.chunks(batches, "text"):
            buf, offsets = _text.text_bytes(chunk.column("text"))
            place, width, before, holds = scanner.scan(buf, offsets)
            events = place, width, before
            rank = _ranks(events, offsets)
            n = np.diff(rank)
            h1, h2, h3, h4 = (chunk.column(f"h{k}").to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4))
            plain = (n == 0) | holds | (h3 % 100 >= percent)
            spm = ~plain & (h4 % 100 < suffix_first)
            a, b = h1 % (n + 1), h2 % (n + 1)
            low, high = np.minimum(a, b), np.maximum(a, b)
            first, second = (_places(events, rank[:-1] + k, offsets[1:]).tolist() for k in (low, high))
            data = memoryview(buf.tobytes())
            out = []
            for start, end, x, y, is_plain, is_spm in zip(offsets[:-1].tolist(), offsets[1:].tolist(), first, second, plain.tolist(), spm.tolist(), strict=True):
                if is_plain:
                    out.append(bytes(data[start:end]))
                else:
                    prefix, middle, suffix = data[start:x], data[x:y], data[y:end]
                    out.append(b"".join((marks[1], suffix, marks[0], prefix, marks[2], middle) if is_spm else (marks[0], prefix, marks[1], suffix, marks[2], middle)))
            form = np.array(FORMS, object)[np.where(plain, 0, np.where(spm, 2, 1))]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("id"), pa.array(n), pa.array(form, pa.string()), pa.array(low, mask=plain), pa.array(high - low, mask=plain), pa.array(out, pa.binary()).view(pa.string())],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *_numbers(id_col, f"{seed}:"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(form: Column, output: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that an output was made from."""
    p, s, m = map(F.lit, sentinels)

    def after(mark: Column, *ends: Column) -> Column:
        part = F.split_part(output, mark, F.lit(2))
        for end in ends:
            part = F.split_part(part, end, F.lit(1))
        return part

    return F.when(form == "plain", output).otherwise(F.concat(after(p, s, m), after(m), after(s, p, m)))
