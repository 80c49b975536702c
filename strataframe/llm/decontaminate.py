"""Benchmark decontamination by q-gram lemma filtering.

Texts and items are compared lower-cased (A-Z and the letters of Latin-1) with each run of white space as
one space; a character is a byte of UTF-8.  An item is cut into pieces of
``PIECE`` characters, each beginning ``STRIDE`` after the one before (a shorter item
is one piece).  A piece of m characters may have k edits, one in 16.  So a passage
of ``PIECE + STRIDE - 1`` characters holds a whole piece wherever it lies in the
item, and one of ``PIECE`` characters without edits is found too, for it lacks at most
``STRIDE / 2`` characters of a piece.

Lemma: a region within k edits of the piece shares at least m + 1 - q(k + 1)
of its q-grams with it, all within k + 1 neighbouring diagonals (place in the
text minus place in the piece).  A piece is also k + 1 segments of q characters or more, of which k edits
leave one as it is; so a region is looked for where the text has the first q-gram of a
segment, and none is missed.  Such a
place falls into diagonal bands of width 2(k + 1) that overlap by half; in each band the
piece's shared q-grams are counted, and bands that reach the bound are
verified, by a banded alignment with free ends.  Many pieces may share a phrase that a text holds: then all are candidates, and
the alignment begins at the end whose q-gram fewer pieces have, and gives a piece up as soon as it costs too much.
What is found of an item depends on no other item, and not on the blocks.

Items of fewer than q characters are found where they stand unedited as whole words.

Items are a table of blocks of bounded text.  Every block meets every text, block by
block, and what is found or kept is written before the next block is read, so neither
driver nor tasks hold more than a block of items.  All texts are read once a block.

Cases: null or empty texts and items match nothing; rows with a null id are
searched too, and items with a null id looked for; repeated rows and items are each
reported; a very long text is searched whole, and an item of any length is cut into
pieces whole; other columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import _text
from ._shared import discard, stored

Q = 12
PIECE, STRIDE = 80, 8
EDIT_SHARE = 16
#: Where more distinct pieces have the first q-gram of a piece, its alignment may begin at its end; it changes work only.
COMMON = 256
#: Most bytes of items that are sent to the tasks at once.
BLOCK = 2 << 20
_FILTER_BITS = 22
#: Most bands that are aligned, and places that are looked at, at once.
_ALIGNED, _LOOKED = 1 << 14, 1 << 21


def budget(m: int) -> int:
    """Edits allowed in m characters: one in 16, as long as the lemma asks for a shared q-gram."""
    return max(0, min(m // EDIT_SHARE, m // Q - 1))


def normal(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The compared bytes, their offsets, and the place in ``buf`` of each."""
    space = _text.is_space(buf)
    follows = np.zeros(len(buf), bool)
    follows[1:] = space[1:] & space[:-1]
    follows[offsets[:-1][offsets[:-1] < len(buf)]] = False
    place = np.flatnonzero(~follows)
    out = _text.ascii_lower(buf[place])
    out[space[place]] = 32
    capital = np.flatnonzero((out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97) & (out[:-1] == 0xC3)) + 1
    out[capital] += 0x20
    return out, np.searchsorted(place, offsets), place


#: Bytes of words: letters, digits and all but ASCII.
_OF_WORD = np.zeros(256, bool)
_OF_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


_GRAMS = PIECE - Q + 1
_PAD = 4 * PIECE


def _short_codes(codes: np.ndarray) -> np.ndarray:
    """Half of each code: enough to count by, for what is counted is aligned."""
    return (codes >> np.uint64(32)).astype(np.uint32)


class _Padded:
    """A chunk's text and q-grams with room on both sides, as windows; q-grams that two texts make together are 0, which no piece's is."""

    def __init__(self, text: np.ndarray, bounds: np.ndarray, codes: np.ndarray):
        self.size = len(text)
        room = np.zeros(_PAD, np.uint8)
        self._text = {False: np.concatenate((room, text, room)), True: np.concatenate((room, text[::-1], room))}
        short = _short_codes(codes)
        inner = bounds[1:-1]
        crossing = (inner[:, None] - np.arange(1, Q)).ravel()
        short[crossing[(crossing >= 0) & (crossing < len(short))]] = 0
        self.grams = np.lib.stride_tricks.sliding_window_view(np.concatenate((np.zeros(_PAD, np.uint32), short, np.zeros(_PAD, np.uint32))), _GRAMS)

    def chars(self, width: int, backward: bool) -> np.ndarray:
        return np.lib.stride_tricks.sliding_window_view(self._text[backward], width)


class Index:
    """The q-grams of a block of items.

    Pieces (arrays at, length, edits, least and chars) are distinct; those after the
    first ``len(self.at)`` stand for items shorter than q.  ``item`` and ``item_at`` list the items of each.
    """

    def __init__(self, items: list[tuple[int, str]]):
        data = [t.encode() for _, t in items]
        buf, offsets, _ = normal(np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data]))).astype(np.int64))
        pieces: dict[bytes, tuple[int, dict[int, None]]] = {}  # of a piece's bytes: where it stands first, and its items
        short: dict[bytes, dict[int, None]] = {}
        whole = buf.tobytes()
        for (item, _), low, high in zip(items, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            if high - low < Q:
                word = whole[low:high].strip(b" ")
                if word:
                    short.setdefault(word, {})[item] = None
                continue
            for at in dict.fromkeys([*range(low, high - PIECE, STRIDE), max(low, high - PIECE)]):
                pieces.setdefault(whole[at : min(high, at + PIECE)], (at, {}))[1][item] = None
        owners = [[*own] for _, own in pieces.values()] + [[*own] for own in short.values()]
        self.item = np.array([i for own in owners for i in own], np.int64)
        self.item_at = np.concatenate(([0], np.cumsum([len(own) for own in owners]))).astype(np.int64)
        self.at, self.length = np.array([at for at, _ in pieces.values()], np.int64), np.array([len(p) for p in pieces], np.int64)
        self.edits = np.array([budget(m) for m in self.length], np.int64)
        self.least = self.length + 1 - Q * (self.edits + 1)
        self.low = int(self.least.min()) if len(pieces) else 1
        self.chars = np.zeros((len(pieces), PIECE), np.uint8)
        for i, p in enumerate(pieces):
            self.chars[i, : len(p)] = np.frombuffer(p, np.uint8)
        self._find_keys(buf)
        self.short = {}  # of a length: sorted hashes and their pieces
        for n in sorted({len(w) for w in short}):
            own = [(len(pieces) + i, w) for i, w in enumerate(short) if len(w) == n]
            codes = _text.byte_prefix(np.frombuffer(b"".join(w for _, w in own), np.uint8)).spans(np.arange(len(own)) * n, np.arange(1, len(own) + 1) * n)
            order = np.argsort(codes)
            self.short[n] = codes[order], np.array([i for i, _ in own])[order]

    def _find_keys(self, buf: np.ndarray) -> None:
        """The first q-grams of all segments, with their pieces and places in them; all q-grams; and which end of each piece is rarer."""
        begin = np.arange(max(0, len(buf) - Q + 1))
        low, high = np.searchsorted(self.at + self.length, begin + Q), np.searchsorted(self.at, begin, side="right")
        held = high > low
        self.codes_at = _text.byte_prefix(buf).spans(begin, begin + Q) if len(begin) else np.zeros(0, np.uint64)
        self.known, number = np.unique(self.codes_at[held], return_inverse=True)
        holders = np.zeros(len(begin) + 1, np.int64)
        holders[:-1][held] = np.bincount(number, weights=(high - low)[held], minlength=len(self.known)).astype(np.int64)[number]
        first, last = holders[self.at], holders[self.at + self.length - Q]
        self.backward = (first > COMMON) & (last < first)
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.known >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

        segments = self.edits + 1
        piece = np.repeat(np.arange(len(self.at)), segments)
        offset = _text.spread(np.zeros(len(self.at), np.int64), segments) * self.length[piece] // segments[piece]
        codes = self.codes_at[self.at[piece] + offset]
        order = np.argsort(codes, kind="stable")
        self.keys, first = np.unique(codes[order], return_index=True)
        self.first = np.append(first, len(codes))
        self.key_piece, self.key_offset = piece[order], offset[order]
        short = _short_codes(self.codes_at)
        self.grams = np.lib.stride_tricks.sliding_window_view(np.append(np.maximum(short, 1), np.zeros(_GRAMS, np.uint32)), _GRAMS)

    def search(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Row, piece, start, end and edits of every verified region."""
        text, bounds, place = normal(buf, offsets)
        prefix = _text.byte_prefix(text)
        found = [self._whole_words(text, bounds, prefix)]
        if len(self.at) and len(text) >= Q:
            found.append(self._regions(text, bounds, prefix))
        row, piece, start, end, edits = (np.concatenate(x) for x in zip(*found, strict=True))
        after = np.append(place, len(buf))
        return row, piece, place[start] - offsets[row], after[end - 1] + 1 - offsets[row], edits

    def _whole_words(self, text: np.ndarray, bounds: np.ndarray, prefix: _text.Prefix) -> tuple[np.ndarray, ...]:
        out = [(np.zeros(0, np.int64),) * 5]
        word = _OF_WORD[text]
        for n, (codes, piece) in self.short.items():
            at = np.arange(max(0, len(text) - n + 1))
            value = prefix.spans(at, at + n)
            k = np.minimum(np.searchsorted(codes, value), len(codes) - 1)
            at = at[codes[k] == value]
            row = np.searchsorted(bounds, at, side="right") - 1
            begins = (at == bounds[row]) | ~word[at - 1] | ~word[at]
            ends = (at + n == bounds[row + 1]) | ~word[np.minimum(at + n, len(text) - 1)] | ~word[at + n - 1]
            good = (at + n <= bounds[row + 1]) & begins & ends
            at, row = at[good], row[good]
            out.append((row, piece[np.searchsorted(codes, value[at])], at, at + n, np.zeros(len(at), np.int64)))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _regions(self, text: np.ndarray, bounds: np.ndarray, prefix: _text.Prefix) -> tuple[np.ndarray, ...]:
        none = tuple(np.zeros(0, np.int64) for _ in range(5))
        at = np.arange(len(text) - Q + 1)
        codes = prefix.spans(at, at + Q)
        hit = np.flatnonzero(self.filter[(codes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        hit = hit[self.known[np.minimum(np.searchsorted(self.known, codes[hit]), len(self.known) - 1)] == codes[hit]]
        # a place without enough shared q-grams around it can't lie in a region
        reach = PIECE + budget(PIECE)
        near = np.searchsorted(hit, hit + reach, side="right") - np.searchsorted(hit, hit - reach)
        hit = hit[near >= self.low]
        row = np.searchsorted(bounds, hit, side="right") - 1
        k = np.searchsorted(self.keys, codes[hit])
        telling = (hit + Q <= bounds[row + 1]) & (k < len(self.keys))
        telling[telling] = self.keys[k[telling]] == codes[hit[telling]]
        hit, row, k = hit[telling], row[telling], k[telling]
        if not len(hit):
            return none
        padded = _Padded(text, bounds, codes)
        total = np.cumsum(self.first[k + 1] - self.first[k])
        top, n_rows, found, low = len(text) + 2 * PIECE, len(bounds), [none], 0
        while low < len(hit):  # so many places at once as lead to a bounded number of pieces (one place at least)
            high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + _LOOKED, side="right")))
            part = slice(low, high)
            count = self.first[k[part] + 1] - self.first[k[part]]
            entry = _text.spread(self.first[k[part]], count)
            piece = self.key_piece[entry]
            diagonal = np.repeat(hit[part], count) - self.key_offset[entry] + PIECE  # kept positive
            band = diagonal // (self.edits[piece] + 1)
            key = (piece * n_rows + np.repeat(row[part], count)) * top
            keys = np.unique(np.concatenate([key + band, key + np.maximum(0, band - 1)]))
            for i in range(0, len(keys), _ALIGNED):
                own = keys[i : i + _ALIGNED]
                found.append(self._verify(text, bounds, padded, own // top // n_rows, own // top % n_rows, own % top))
            low = high
        row, piece, start, end, edits = (np.concatenate(x) for x in zip(*found, strict=True))
        once = np.unique(np.stack([row, piece, start, end, edits], axis=1), axis=0)
        return tuple(once.T)

    def _verify(self, text: np.ndarray, bounds: np.ndarray, padded: _Padded, piece: np.ndarray, row: np.ndarray, band: np.ndarray) -> tuple[np.ndarray, ...]:
        """Regions of the bands whose piece has enough of its q-grams on the band's diagonals and aligns within its edits."""
        first = band * (self.edits[piece] + 1) - PIECE
        wanted = np.where(np.arange(_GRAMS) <= (self.length[piece] - Q)[:, None], self.grams[self.at[piece]], np.uint32(1))
        shared, widths = np.zeros(wanted.shape, bool), 2 * (self.edits[piece] + 1)
        for d in range(int(widths.max(initial=0))):
            on = padded.grams[first + d + _PAD] == wanted
            if d >= widths.min():
                on &= (d < widths)[:, None]
            shared |= on
        keep = np.flatnonzero(shared.sum(axis=1) >= self.least[piece])
        keep = keep[self._may_align(padded, piece[keep], first[keep])]
        piece, row, first = piece[keep], row[keep], first[keep]
        if not len(piece):
            return tuple(np.zeros(0, np.int64) for _ in range(5))
        start, end, edits = self._align(text, bounds, piece, row, first)
        good = edits <= self.edits[piece]
        return row[good], piece[good], start[good], end[good], edits[good]

    def _may_align(self, padded: _Padded, piece: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether each piece aligns within its edits if neighbouring texts are taken as one, from its rarer end on; most that don't are given up early."""
        out = np.zeros(len(piece), bool)
        for backward in (False, True):
            own = np.flatnonzero(self.backward[piece] == backward)
            if not len(own):
                continue
            some, length, edits = piece[own], self.length[piece[own]], self.edits[piece[own]]
            k = int(edits.max())
            width = 2 * (k + 1) + 2 * k + 1
            low = first[own] - k
            if backward:  # read from the other end, diagonals run the other way
                low = padded.size - length - low - width + 1
            view = padded.chars(width, backward)
            value = np.zeros((len(own), width), np.uint8)
            for i in range(1, PIECE + 1):
                chars = self.chars[some, length - i if backward else np.full(len(some), i - 1)]
                x = value + (view[low + (i - 1 + _PAD)] != chars[:, None])
                np.minimum(x[:, :-1], value[:, 1:] + 1, out=x[:, :-1])
                step = 1
                while step <= k:  # runs of 1, 3, 7, ... characters that the text has more
                    np.minimum(x[:, step:], x[:, :-step] + step, out=x[:, step:])
                    step *= 2
                value = x
                done = length == i
                if i % 3 and not (i >= Q and done.any()):
                    continue
                fine = value.min(axis=1) <= edits
                out[own[done & fine]] = True
                stay = fine & ~done
                if not stay.all():
                    own, some, length, edits, low, value = own[stay], some[stay], length[stay], edits[stay], low[stay], value[stay]
                if not len(own):
                    break
        return out

    def _align(self, text: np.ndarray, bounds: np.ndarray, piece: np.ndarray, row: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Least edits of each piece against the text at the band's diagonals and k beside them, its start and its end."""
        k = int(self.edits[piece].max())
        width = 2 * (k + 1) + 2 * k + 1
        low = first - k
        steps = np.arange(width) * 4096  # a value is edits * 4096 + the diagonal where the region starts
        value = np.broadcast_to(np.arange(width), (len(piece), width)).astype(np.int64)
        out_of_text = 1 << 40
        begin = low[:, None] + np.arange(width)
        value = np.where((begin >= bounds[row][:, None]) & (begin <= bounds[row + 1][:, None]), value, out_of_text)
        final = np.full((len(piece), width), out_of_text)
        final[self.length[piece] == 0] = value[self.length[piece] == 0]
        for i in range(1, PIECE + 1):
            j = low[:, None] + i + np.arange(width)  # text characters used so far
            valid = (j - 1 >= bounds[row][:, None]) & (j <= bounds[row + 1][:, None])
            same = text[np.clip(j - 1, 0, len(text) - 1)] == self.chars[piece, i - 1][:, None]
            x = np.where(valid, value + np.where(same, 0, 4096), out_of_text)
            drop = np.concatenate([value[:, 1:] + 4096, np.full((len(piece), 1), out_of_text)], axis=1)
            x = np.minimum(x, np.where((j >= bounds[row][:, None]) & (j <= bounds[row + 1][:, None]), drop, out_of_text))
            value = np.minimum.accumulate(x - steps, axis=1) + steps
            value = np.where(j <= bounds[row + 1][:, None], value, out_of_text)
            done = self.length[piece] == i
            final[done] = value[done]
        best = final.argmin(axis=1)
        value = final[np.arange(len(piece)), best]
        edits = value // 4096
        start = low + value % 4096
        end = low + self.length[piece] + best
        fine = edits < 4096
        return np.where(fine, start, 0), np.where(fine, end, 1), np.where(fine, edits, 1 << 20)


def _index(items: list[tuple[int | None, str]]) -> Index:
    """The index of a block; its items are numbers in the block, for ids may be null or repeated."""
    return Index([(n, text) for n, (_, text) in enumerate(items)])


def regions(index: Index, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, item, start, end and most edits of every region: those of an item's pieces that overlap or touch are one."""
    row, piece, start, end, edits = index.search(buf, offsets)
    count = index.item_at[piece + 1] - index.item_at[piece]
    item = index.item[_text.spread(index.item_at[piece], count)]
    row, start, end, edits = (np.repeat(x, count) for x in (row, start, end, edits))
    order = np.lexsort((end, start, item, row))
    row, item, start, end, edits = (x[order] for x in (row, item, start, end, edits))
    if not len(row):
        return row, item, start, end, edits
    fresh = np.append(True, (row[1:] != row[:-1]) | (item[1:] != item[:-1]))
    group = np.cumsum(fresh) * (int(end.max()) + 1)
    so_far = np.maximum.accumulate(end + group) - group  # the largest end of the same row and item so far
    begins = fresh.copy()
    begins[1:] |= start[1:] > so_far[:-1]
    at = np.flatnonzero(begins)
    return row[at], item[at], start[at], np.maximum.reduceat(end, at), np.maximum.reduceat(edits, at)


def _search(items: list[tuple[int | None, str]]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, ids = _index(items), pa.array([i for i, _ in items], pa.int64())
        for chunk in _text.chunks(batches, "text", 1 << 20):
            row, item, start, end, edits = regions(index, *_text.text_bytes(chunk.column("text")))
            if len(row):
                yield pa.RecordBatch.from_arrays([chunk.column("doc_id").take(pa.array(row)), ids.take(pa.array(item)), pa.array(start), pa.array(end), pa.array(edits.astype(np.int32))], names=["doc_id", "item_id", "start", "end", "edits"])

    return task


def _blocks(benchmark: DataFrame, item_col: str, item_text: str, block: int) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of about ``block`` bytes, each read when it is asked for; one empty block if there are none."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text")).where("text is not null")
    n = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block))
    if n == 1:
        yield [(r.item, r.text) for r in items.orderBy("item", "text").collect()]
        return
    # a number for each row, written before it is used, deals even equal items evenly
    dealt = stored(items.withColumn("row", F.monotonically_increasing_id())).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n)))
    for k in range(n):
        yield [(r.item, r.text) for r in dealt.where(F.col("block") == k).orderBy("item", "text").collect()]


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, item_id, the bytes ``start`` to ``end`` of the text, and the most edits of a piece, for every region found."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["doc_id"]]).add("item_id", "long").add("start", "long").add("end", "long").add("edits", "integer")
    parts, last = [], None
    for part in _blocks(benchmark, item_col, item_text, block):
        if last is not None:
            parts.append(stored(last)._stored_at)
        last = rows.mapInArrow(_search(part), schema)
    return last if not parts else docs.sparkSession.read.schema(schema).parquet(*parts).unionAll(last)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block: int = BLOCK, least_bytes: int = 1) -> DataFrame:
    """The rows of ``docs`` in which no item is found, without a shuffle: each block of items filters the rows that the one before left.

    Items of under ``least_bytes`` bytes (without white space at their ends) delete nothing: a single word or number stands in any text. ``matches`` reports them all.
    """
    benchmark = benchmark.where(F.octet_length(F.regexp_replace(item_text, r"^\s+|\s+$", "")) >= least_bytes)

    def without(items: list[tuple[int | None, str]]):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(items)
            for chunk in _text.chunks(batches, text_col, 1 << 20):
                stays = np.ones(len(chunk), bool)
                stays[index.search(*_text.text_bytes(chunk.column(text_col)))[0]] = False
                yield chunk.filter(pa.array(stays))

        return task

    schema, before, last = docs.schema, None, None
    for part in _blocks(benchmark, item_col, item_text, block):
        if last is not None:
            kept = stored(last)
            if before is not None:
                discard(before)
            before = docs = kept
        last = docs.mapInArrow(without(part), schema)
    return last
