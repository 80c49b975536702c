"""SentencePiece encoding and decoding by suffix-array matching.

The distinct words of a batch are laid end to end and indexed by a suffix
array, sorted as deep as the longest piece.  Every piece of the vocabulary is
found in it by binary search; its range of suffixes gives all its
occurrences, the edges of a graph over the text.  Edges are sorted by where
they end and relaxed in that order.

The vocabulary is a BPE model with byte fallback, so relaxing can't add up
scores: it keeps, for each place, the one piece that the model's own merges
would end with there.  A piece follows another if the merges of both
together give back the two (checked once a pair, then remembered), which
makes the path of each word the model's own encoding.

Words are cut before each run of spaces, which no piece crosses; a vocabulary
with a piece that does is refused, and so is a model that isn't BPE or that changes texts
before encoding.  A task remembers the words it has encoded, up to a bound.

Cases: a null text gives null ids and null text; an empty text no ids; a
character outside the vocabulary becomes its bytes; the sign U+2581 decodes as a space,
as in the public library; repeated rows encode alike; a very long text is
encoded whole, its distinct words in blocks; a column of the input named like one of the results (ids,
n_tokens, decoded, round_trip) gives way to it, and other columns may have any name; empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F, types as T

from . import _text
from ._shared import unused

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Most words and pairs that a task remembers.
WORDS, PAIRS = 400_000, 2_000_000
#: Characters of distinct words that are indexed at once (one word at least).
BLOCK = 200_000


def _fields(data: bytes) -> dict[int, list[int | bytes]]:
    """The fields of a protocol buffer message by number: whole numbers, or bytes."""
    at, out = 0, {}

    def number() -> int:
        nonlocal at
        value, shift = 0, 0
        while True:
            byte, at = data[at], at + 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        tag = number()
        kind = tag & 7
        size = {0: 0, 1: 8, 5: 4}.get(kind)
        if kind == 0:
            value: int | bytes = number()
        else:
            size = number() if size is None else size
            value, at = data[at : at + size], at + size
        out.setdefault(tag >> 3, []).append(value)
    return out


def _check(proto: bytes) -> None:
    """ValueError unless the model is BPE (type 2 of its trainer's field 3), adds a space in front, and keeps characters and white space as they are."""
    model = _fields(proto)
    trainer, normalizer = (_fields(b"".join(model.get(k, []))) for k in (2, 3))
    if trainer.get(3, [1]) != [2]:
        raise ValueError("only BPE models are supported")
    changes, dummy, shrinks = normalizer.get(2, [b""])[-1], normalizer.get(3, [1])[-1], normalizer.get(4, [1])[-1]
    if changes or not dummy or shrinks:
        raise ValueError("the model changes texts before it encodes them")


def load(path: str) -> dict:
    """Pieces, their scores and what kind each is, read on the driver; its size is the vocabulary's."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    _check(sp.serialized_model_proto())
    n = sp.get_piece_size()
    plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)) for i in range(n)]
    pieces = [sp.id_to_piece(i) for i in range(n)]
    if any(SPACE in p.lstrip(SPACE) for p, ok in zip(pieces, plain, strict=True) if ok):
        raise ValueError("a piece of this vocabulary crosses words")
    return {"pieces": pieces, "scores": [sp.get_score(i) for i in range(n)], "plain": plain, "byte": sp.piece_to_id("<0x00>")}


class Codec:
    def __init__(self, model: dict):
        self.pieces, self.n = model["pieces"], len(model["pieces"])
        plain = np.array(model["plain"])
        self.ids = {p: i for i, (p, ok) in enumerate(zip(self.pieces, plain, strict=True)) if ok}
        self.score = {p: model["scores"][i] for p, i in self.ids.items()}
        self.byte = model["byte"]
        whole = [i for p, i in self.ids.items() if self.merged(p) == [p]]  # others are never the result of merges
        self.usable = np.array(sorted(whole), np.int64)
        letters = sorted({ord(c) for p in self.ids for c in p})
        self.letters = np.array(letters, np.uint32)
        self.longest = max(map(len, self.ids))
        width = -(-self.longest // 4) * 4
        codes = np.zeros((len(self.usable), width), np.uint16)
        self.length = np.array([len(self.pieces[i]) for i in self.usable], np.int64)
        for k, i in enumerate(self.usable):
            codes[k, : self.length[k]] = np.searchsorted(self.letters, [ord(c) for c in self.pieces[i]]) + 1
        self.width = width
        upper = codes.copy()
        upper[np.arange(width) >= self.length[:, None]] = 0xFFFF
        self.low, self.high = (np.ascontiguousarray(x.astype(">u2")).view(f"S{2 * width}").ravel() for x in (codes, upper))
        self.piece_length = np.zeros(self.n, np.int64)
        self.piece_length[self.usable] = self.length
        data = [p.replace(SPACE, " ").encode() if plain[i] else b"" for i, p in enumerate(self.pieces)]
        if self.byte >= 0:
            data[self.byte : self.byte + 256] = [bytes([b]) for b in range(256)]
        self.data = np.frombuffer(b"".join(data), np.uint8)
        self.data_at = np.concatenate(([0], np.cumsum([len(d) for d in data]))).astype(np.int64)
        self.pair_key, self.pair_ok = np.zeros(0, np.int64), np.zeros(0, bool)
        self.forget()

    def forget(self) -> None:
        self.known, self.token_at, self.tokens = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int32)

    def merged(self, text: str) -> list[str]:
        """The model's merges: always the adjacent pair of the best score, the first of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, a: str, b: str) -> bool:
        """Whether ``merged`` of both texts, each a piece that its own merges give, gives back the two."""
        score, none = self.score, float("-inf")
        if a + b in score:
            return False
        parts, left = list(a + b), len(a)
        pairs = [score.get(x + y, none) for x, y in zip(parts, parts[1:])]
        while len(parts) > 2:
            best = max(pairs)
            at = pairs.index(best)
            if best == none or at == left - 1:  # nothing more to merge, or a merge across the border
                return False
            parts[at] += parts.pop(at + 1)
            pairs.pop(at)
            left -= at < left - 1
            if at:
                pairs[at - 1] = score.get(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = score.get(parts[at] + parts[at + 1], none)
        return True

    def _follows(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether merges keep the two pieces apart."""
        key = before.astype(np.int64) * self.n + piece
        at = np.searchsorted(self.pair_key, key)
        found = at < len(self.pair_key)
        found[found] = self.pair_key[at[found]] == key[found]
        if not found.all():
            new = np.unique(key[~found])
            if len(self.pair_key) > PAIRS:
                self.pair_key, self.pair_ok = np.zeros(0, np.int64), np.zeros(0, bool)
                new = np.unique(key)
            text = self.pieces
            ok = np.fromiter((self.apart(text[a], text[b]) for a, b in zip((new // self.n).tolist(), (new % self.n).tolist(), strict=True)), bool, len(new))
            place = np.searchsorted(self.pair_key, new)
            self.pair_key, self.pair_ok = np.insert(self.pair_key, place, new), np.insert(self.pair_ok, place, ok)
            at = np.searchsorted(self.pair_key, key)
        return self.pair_ok[at]

    def _edges(self, codes: np.ndarray, begin: np.ndarray, end_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and piece of every occurrence of a usable piece that lies in one word."""
        n = len(codes)
        padded = np.concatenate([codes, np.zeros(self.width, np.uint16)])
        keys = np.zeros((n, self.width), ">u2")
        left = end_of - np.arange(n)
        for c in range(self.width):
            keys[:, c] = np.where(left > c, padded[c : c + n], 0)
        columns = keys.view(">u8").astype(np.uint64)
        order = np.lexsort(columns.T[::-1])
        suffixes = np.ascontiguousarray(keys[order]).view(f"S{2 * self.width}").ravel()
        low = np.searchsorted(suffixes, self.low)
        count = np.searchsorted(suffixes, self.high, side="right") - low
        return order[_text.spread(low, count)].astype(np.int32), np.repeat(np.arange(len(self.usable), dtype=np.int32), count)

    def _encode_words(self, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words, and the bounds of each word's; words: runs of code points."""
        n = len(points)
        at = np.searchsorted(self.letters, points)
        at[at == len(self.letters)] = 0
        codes = np.where(self.letters[at] == points, at + 1, 0xFFFE).astype(np.uint16)
        word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        begin, end_of = bounds[word], bounds[word + 1]
        start, k = self._edges(codes, begin, end_of)
        end, piece = start + self.length[k], self.usable[k]
        single = np.zeros(n, bool)
        single[start[self.length[k] == 1]] = True
        lone = np.flatnonzero(~single)
        # a character outside the vocabulary is a token of its own, numbered after all pieces
        start, end, piece = (np.concatenate(x).astype(np.int32) for x in ((start, lone), (end, lone + 1), (piece, np.full(len(lone), self.n))))
        depth = end - begin[start]
        order = np.lexsort((end, depth))
        start, end, piece, depth = start[order], end[order], piece[order], depth[order]
        last = np.full(n + 1, -1, np.int32)  # the piece that ends at a place
        stops = np.flatnonzero(np.append(depth[1:] != depth[:-1], True)) + 1 if len(depth) else []
        low = 0
        for high in stops:
            s, e, p = start[low:high], end[low:high], piece[low:high]
            first = s == begin[s]
            before = np.where(first, self.n, last[np.where(first, 0, s)])
            good = first | (before == self.n) | (p == self.n)
            ask = np.flatnonzero(~good & (before >= 0))
            good[ask] = self._follows(before[ask], p[ask])
            last[e[good]] = p[good]
            low = high
        # walk back from the words' ends
        place, owner, taken, owners, step = bounds[1:].copy(), np.arange(len(bounds) - 1), [], [], []
        depth_now = 0
        while len(place):
            p = last[place]
            taken.append(np.where(p == self.n, self.n + points[place - 1].astype(np.int64), p))
            owners.append(owner)
            step.append(np.full(len(place), depth_now))
            place = place - np.where(p == self.n, 1, self.piece_length[np.minimum(p, self.n - 1)])
            more = place > bounds[owner]
            place, owner = place[more], owner[more]
            depth_now += 1
        taken, owners, step = np.concatenate(taken), np.concatenate(owners), np.concatenate(step)
        order = np.lexsort((-step, owners))
        taken, owners = taken[order], owners[order]
        if (taken >= self.n).any():
            chars = ["".join(map(chr, [t - self.n])).encode() if t >= self.n else b"" for t in taken.tolist()]
            width = np.array([max(1, len(c)) for c in chars])
            out = np.repeat(taken, width)
            owners = np.repeat(owners, width)
            raw = np.frombuffer(b"".join(chars), np.uint8)
            out[out >= self.n] = (self.byte + raw.astype(np.int64)) if self.byte >= 0 else 0
            taken = out
        return taken.astype(np.int32), np.searchsorted(owners, np.arange(len(bounds)))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts, and the bounds of each text's."""
        full = [SPACE + t if t else "" for t in texts]
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in full]))).astype(np.int64)
        points = np.frombuffer("".join(full).encode("utf-32-le"), np.uint32)
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = np.where(points == 32, ord(SPACE), points).astype(np.uint32)
        gap = points == ord(SPACE)
        starts = gap.copy()
        starts[1:] &= ~gap[:-1]
        starts[bounds[:-1][np.diff(bounds) > 0]] = True
        start = np.flatnonzero(starts)
        end = np.append(start[1:], len(points))
        value = _text.Prefix(_text.mix(points.astype(np.uint64) + np.uint64(977))).spans(start, end)
        distinct, first, inverse = np.unique(value, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > WORDS:
            self.forget()
        new = distinct[~np.isin(distinct, self.known, assume_unique=True)]
        if len(new):
            own = first[np.searchsorted(distinct, new)]
            width = end[own] - start[own]
            total = np.cumsum(width)
            low = 0
            while low < len(new):
                high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + BLOCK, side="right")))
                part = slice(low, high)
                tokens, token_at = self._encode_words(points[_text.spread(start[own[part]], width[part])], np.concatenate(([0], np.cumsum(width[part]))))
                self._remember(new[part], tokens, token_at)
                low = high
        at = np.searchsorted(self.known, distinct)[inverse]
        count = np.diff(self.token_at)[at]
        tokens = self.tokens[_text.spread(self.token_at[at], count)]
        text_of = np.searchsorted(start, bounds)
        return tokens, np.concatenate(([0], np.cumsum(count)))[text_of]

    def _remember(self, new: np.ndarray, tokens: np.ndarray, token_at: np.ndarray) -> None:
        known = np.concatenate([self.known, new])
        begin = np.concatenate([self.token_at[:-1], token_at[:-1] + len(self.tokens)])
        count = np.concatenate([np.diff(self.token_at), np.diff(token_at)])
        order = np.argsort(known)
        pool = np.concatenate([self.tokens, tokens])
        self.known, self.tokens = known[order], pool[_text.spread(begin[order], count[order])]
        self.token_at = np.concatenate(([0], np.cumsum(count[order])))

    def decode(self, tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts and their offsets; the space that encoding puts before a text is dropped."""
        width = np.diff(self.data_at)[tokens]
        at = np.concatenate(([0], np.cumsum(width)))
        data = self.data[_text.spread(self.data_at[tokens], width)]
        offsets = at[bounds]
        full = np.diff(offsets) > 0
        heads = offsets[:-1][full]
        dropped = heads[data[heads] == 32] if len(heads) else heads
        keep = np.ones(len(data), bool)
        keep[dropped] = False
        return data[keep], offsets - np.searchsorted(dropped, offsets)


_codecs: dict[int, Codec] = {}


def _codec(model: dict) -> Codec:
    key = hash((tuple(model["pieces"]), tuple(model["scores"])))
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(model)
    return _codecs[key]


def _rows(docs: DataFrame, keep: list[str] | None, text_col: str, results: tuple[str, ...]) -> tuple[DataFrame, str]:
    """The kept columns but those named like results, and the text under an unused name, which is the last."""
    names = [c for c in keep or docs.columns if c.lower() not in results]
    (text,) = unused(docs, "__text")
    return docs.select(*names, F.col(text_col).alias(text)), text


def encode(docs: DataFrame, model_path: str = MODEL, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (all, if not given), ``ids`` and ``n_tokens`` of every row."""
    model = load(model_path)
    rows, text_name = _rows(docs, keep, text_col, ("ids", "n_tokens"))
    schema = T.StructType(rows.schema.fields[:-1]).add("ids", T.ArrayType(T.IntegerType(), False)).add("n_tokens", "integer")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for chunk in _text.chunks(batches, text_name):
            text = chunk.column(text_name)
            tokens, bounds = codec.encode(text.to_pylist())
            null = text.is_null().to_numpy(zero_copy_only=False)
            count = np.diff(bounds)
            ids = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(tokens), mask=pa.array(null)) if null.any() else _text.list_array(pa.array(tokens), bounds)
            yield pa.RecordBatch.from_arrays([*chunk.columns[:-1], ids, pa.array(count.astype(np.int32), mask=null)], names=schema.names)

    return rows.mapInArrow(run, schema)


def decode(rows: DataFrame, model_path: str = MODEL, ids_col: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns and the text of the ids in the column ``into``."""
    model = load(model_path)
    out = rows.drop(into)
    schema = T.StructType(list(out.schema)).add(into, "string")
    names = out.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = part.column(names.index(ids_col))
                bounds = np.concatenate(([0], np.cumsum(ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))))
                data, offsets = codec.decode(ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64), bounds)
                text = pa.LargeStringArray.from_buffers(len(part), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
                if ids.null_count:
                    text = pa.compute.if_else(ids.is_null(), pa.scalar(None, pa.string()), text)
                yield pa.RecordBatch.from_arrays([*part.columns, text], names=schema.names)

    return out.mapInArrow(run, schema)


def round_trip(docs: DataFrame, model_path: str = MODEL, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``encode`` and ``decode`` in one task: the columns of ``keep``, ids, n_tokens, decoded, and whether it equals the text."""
    model = load(model_path)
    rows, text_name = _rows(docs, keep, text_col, ("ids", "n_tokens", "decoded", "round_trip"))
    schema = T.StructType(rows.schema.fields[:-1]).add("ids", T.ArrayType(T.IntegerType(), False)).add("n_tokens", "integer").add("decoded", "string").add("round_trip", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model)
        for chunk in _text.chunks(batches, text_name):
            text = chunk.column(text_name)
            tokens, bounds = codec.encode(text.to_pylist())
            data, offsets = codec.decode(tokens, bounds)
            back = pa.LargeStringArray.from_buffers(len(chunk), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())
            null = text.is_null()
            mask = null.to_numpy(zero_copy_only=False)
            if mask.any():
                back = pa.compute.if_else(null, pa.scalar(None, pa.string()), back)
            ids = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(tokens), mask=pa.array(mask)) if mask.any() else _text.list_array(pa.array(tokens), bounds)
            same = pa.compute.fill_null(pa.compute.equal(back, text.cast(pa.string())), True)
            yield pa.RecordBatch.from_arrays([*chunk.columns[:-1], ids, pa.array(np.diff(bounds).astype(np.int32), mask=mask), back, same], names=schema.names)

    return rows.mapInArrow(run, schema)
