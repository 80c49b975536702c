"""Language identification with hyperdimensional profiles.

Every letter (code point, in lower case) has a random +1/-1 vector, drawn from
a hash of its number.  A letter trigram is bound from its letters' vectors,
permuted by position: ``roll(a, 2) * roll(b, 1) * c``; what lies between words
counts as a letter of its own.  A text's vector bundles (adds) those of its
trigrams, a language's prototype bundles those of its training texts, and a
text gets the language whose prototype has the largest cosine.

Cases: a null text or one without letters is ``und`` with score 0; rows with a
null language don't train; if no row trains, every row is ``und``; equal
cosines go to the language that sorts first; an empty table gives an empty
result; repeated rows are predicted alike; a very long text is bundled whole,
``BLOCK`` distinct trigrams at a time; a row with a null id is predicted
and neither trains nor is held out in the query.  Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import _text

DIM = 1024
#: Most trigram vectors that a task remembers, and that it makes at once.
CACHE, BLOCK = 65_536, 32_768
_CHUNK = 1 << 20
#: Most numbers of a matrix of counts.
_DENSE = 4 << 20


def _letter_table() -> np.ndarray:
    """The letter of each code point: its lower case if it is a letter, else 0."""
    table = np.zeros(0x110000, np.uint32)
    for cp in range(0x32400):  # no letters lie beyond
        c = chr(cp)
        if c.isalpha():
            table[cp] = ord(c.lower()[0])
    return table


class Profiles:
    """Vectors of trigrams, made when they are first seen."""

    def __init__(self, dim: int):
        self.dim, self.table = dim, _letter_table()
        self.forget()

    def forget(self) -> None:
        self.known, self.place = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.vectors = np.zeros((0, self.dim), np.int8)

    def letters(self, points: np.ndarray) -> np.ndarray:
        """The vectors of letters."""
        seeds = points.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, -(-self.dim // 64) + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        bits = np.unpackbits(_text.mix(_text.mix(seeds)).astype("<u8").view(np.uint8), axis=1, bitorder="little")[:, : self.dim]
        return bits.astype(np.int8) * 2 - 1

    def bound(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of trigrams, from those of their letters."""
        out = np.ones((len(keys), self.dim), np.int8)
        for back in (2, 1, 0):
            letters, at = np.unique(keys >> (21 * back) & 0x1FFFFF, return_inverse=True)
            out *= np.roll(self.letters(letters), back, axis=1)[at]
        return out

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of distinct trigrams in order; new ones are remembered while there is room."""
        at = np.searchsorted(self.known, keys)
        found = at < len(self.known)
        found[found] = self.known[at[found]] == keys[found]
        new = keys[~found]
        if not len(new):
            return self.vectors[self.place[at]]
        made = self.bound(new)
        if len(self.known) + len(new) > CACHE:
            out = np.empty((len(keys), self.dim), np.int8)
            out[found], out[~found] = self.vectors[self.place[at[found]]], made
            if len(new) <= CACHE // 2:  # a text of few trigrams begins anew, one of very many doesn't drive out all others
                self.forget()
                self.known, self.place, self.vectors = new, np.arange(len(new)), made
            return out
        where = np.searchsorted(self.known, new)
        self.place = np.insert(self.place, where, len(self.vectors) + np.arange(len(new)))
        self.known = np.insert(self.known, where, new)
        self.vectors = np.concatenate([self.vectors, made])
        return self.vectors[self.place[np.searchsorted(self.known, keys)]]

    def trigrams(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct trigrams of all texts, of each trigram that stands in a text its number among those, and the n+1 bounds of each text's."""
        points = np.frombuffer("\n".join(["", *((t or "") for t in texts), ""]).encode("utf-32-le", "replace"), np.uint32)
        starts = np.cumsum([1] + [len(t or "") + 1 for t in texts])
        letter = self.table[points]
        keep = np.ones(len(letter), bool)
        keep[1:] = (letter[1:] != 0) | (letter[:-1] != 0)
        s = letter[keep].astype(np.int64)
        if len(s) < 3:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        middle = np.flatnonzero(s[1:-1] != 0)
        keys, number = np.unique(s[middle] << 42 | s[middle + 1] << 21 | s[middle + 2], return_inverse=True)
        kept_before = np.cumsum(keep)[starts - 1] - 1  # of kept places the one that stands for a text's line break before it
        return keys, number, np.searchsorted(middle, kept_before)

    def bundles(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The vector of each text, as exact whole numbers, and the number of its trigrams."""
        keys, number, bounds = self.trigrams(texts)
        out, row = np.zeros((len(texts), self.dim)), np.repeat(np.arange(len(texts)), np.diff(bounds))
        for low in range(0, len(keys), BLOCK):
            vectors = self.of(keys[low : low + BLOCK]).astype(np.float32)
            inside = (number >= low) & (number < low + BLOCK) if len(keys) > BLOCK else slice(None)
            cell, count = np.unique(row[inside] * len(vectors) + number[inside] - low, return_counts=True)
            rows, column = cell // len(vectors), cell % len(vectors)
            of = np.searchsorted(rows, np.arange(len(texts) + 1))
            at = 0
            while at < len(texts):
                # sums stay exact in 32 bits while a text has fewer than 2 ** 24 trigrams
                end = max(at + 1, min(len(texts), at + _DENSE // len(vectors)))
                part = slice(of[at], of[end])
                if (end - at) * len(vectors) > 40 * (of[end] - of[at]) or count[part].sum() >= 1 << 24:
                    for i in range(at, end):
                        for k in range(of[i], of[i + 1], 8192):
                            own = slice(k, min(k + 8192, of[i + 1]))
                            out[i] += (count[own].astype(np.float64) @ vectors[column[own]]) if count[own].sum() >= 1 << 24 else count[own].astype(np.float32) @ vectors[column[own]]
                else:
                    dense = np.zeros((end - at, len(vectors)), np.float32)
                    dense[rows[part] - at, column[part]] = count[part]
                    out[at:end] += dense @ vectors
                at = end
        return out, np.diff(bounds)


_profiles: dict[int, Profiles] = {}


def _of(dim: int) -> Profiles:
    if dim not in _profiles:
        _profiles[dim] = Profiles(dim)
    return _profiles[dim]


def train(rows: DataFrame, text_col: str = "text", lang_col: str = "lang", dim: int = DIM) -> dict[str, np.ndarray]:
    """The prototype of each language: exact integer sums, so they don't depend on how rows are dealt.

    Each task sends one vector a language; the driver gets one vector a language.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, sums = _of(dim), {}
        for chunk in _text.chunks(batches, "text", _CHUNK):
            vectors, _ = p.bundles(chunk.column("text").to_pylist())
            for lang, vector in zip(chunk.column("lang").to_pylist(), vectors, strict=True):
                sums[lang] = sums.get(lang, 0) + vector.astype(np.int64)
        for lang, vector in sums.items():
            yield pa.record_batch({"lang": pa.array([lang] * dim, pa.string()), "place": np.arange(dim, dtype=np.int32), "value": vector})

    rows = rows.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("lang is not null and text is not null")
    sums = rows.mapInArrow(partial, "lang string, place int, value long").groupBy("lang", "place").agg(F.sum("value").alias("value"))
    out: dict[str, np.ndarray] = {}
    for r in sums.collect():
        out.setdefault(r.lang, np.zeros(dim))[r.place] = r.value
    return {lang: v for lang, v in sorted(out.items()) if v.any()}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text", extra: dict[str, Column] | None = None, dim: int = DIM) -> DataFrame:
    """id, the columns of ``extra``, ``lang_pred`` and ``score`` (the cosine, 0 at least) of every row."""
    docs = docs.select(F.col(id_col), *(c.alias(k) for k, c in (extra or {}).items()), F.col(text_col).alias("__text"))
    schema = T.StructType(docs.schema.fields[:-1]).add("lang_pred", "string").add("score", "double")
    names = list(prototypes)
    unit = np.array([v / np.linalg.norm(v) for v in prototypes.values()], np.float64).reshape(len(names), dim)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = _of(dim)
        for chunk in _text.chunks(batches, "__text", _CHUNK):
            vectors, n = p.bundles(chunk.column("__text").to_pylist())
            best, top = [], []
            for vector, count in zip(vectors, n.tolist(), strict=True):
                norm = float(np.linalg.norm(vector))
                cosines = unit @ vector / norm if norm and names else None
                k = int(np.argmax(cosines)) if cosines is not None else 0
                best.append(names[k] if cosines is not None and count else "und")
                top.append(float(min(1, max(0, cosines[k]))) if cosines is not None and count else 0.0)
            yield pa.RecordBatch.from_arrays([*chunk.columns[:-1], pa.array(best, pa.string()), pa.array(top, pa.float64())], names=schema.names)

    return docs.mapInArrow(score, schema)
