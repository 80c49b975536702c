"""SimHash near duplicates: fingerprints that differ in few bits, found by pigeonhole blocks.

1. Fingerprint.  A text's shingles are hashed; a bit of its fingerprint is 1 if it
   is set in over half of the hashes.  Rows of equal fingerprints are one class, so copies never meet.
2. Blocks.  The 64 bits are cut into ``BLOCKS`` blocks.  Fingerprints that differ in
   ``distance`` bits agree in all blocks but as many, so every choice of the others is a
   key, and close fingerprints share one of the keys.
3. Join.  Classes that share a key are joined and their distance is verified.
   A key shared by more than ``CROWD`` classes is not joined with itself, for that grows with the
   square: there every fingerprint is sent to itself and to all places one bit away among the
   bits that the key leaves open.  Two fingerprints at most two bits apart, and only those, have such
   a place in common, where at most 65 can meet; each is linked to the least there.  So no link
   between classes is lost (as to what it reaches), and crowds cost in proportion to their size.
4. Components of the links give each document its class id.

Keys that many classes share, and fingerprints that many rows have, are looked up through a bounded table
that all tasks have; so a hot one needs no task of its own.

Cases: a text without words, or null, has fingerprint 0 and links like any other;
fewer words than a shingle make one shingle of all; repeated rows are copies; a null id takes part
in links but is no class id unless all of its class are null; a very long text is hashed
whole, a part of its shingles at a time; only the named columns are read, and others may have any
name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from . import _text
from ._shared import looked_up, stored
from .components import components

WORDS, SEED = 3, 42
DISTANCE, BLOCKS = 2, 4
#: Most classes of a key that are joined in pairs.
CROWD = 64
#: Hashes whose bits are counted at once.
_AT_ONCE = 1 << 17


def joined_words(buf: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased words of all texts with one space after each; start, end and row of each."""
    start, end, row = _text.words(buf, offsets)
    length = end - start
    data = np.append(_text.ascii_lower(buf), np.uint8(32))[_text.spread(start, length + 1)]
    stop = np.cumsum(length + 1)
    data[stop - 1] = 32
    return data.tobytes(), stop - length - 1, stop - 1, row


def fingerprints(buf: np.ndarray, offsets: np.ndarray, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """The fingerprint of every text as a signed 64-bit number."""
    n = len(offsets) - 1
    data, start, end, row = joined_words(buf, offsets)
    bounds = _text.row_ranges(row, n)
    first = np.arange(len(start))
    last = np.minimum(first + words, bounds[row + 1])
    keep = (last - first == words) | (first == bounds[row])  # a short text's only shingle begins with it
    start, end, row = start[first[keep]], end[last[keep] - 1], row[keep]
    count = np.zeros((n, 64), np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, len(row), _AT_ONCE):
        part = slice(at, at + _AT_ONCE)
        hashes = b"".join([digest(data[s:e], seed) for s, e in zip(start[part].tolist(), end[part].tolist(), strict=True)])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        own = row[part]
        begins = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        count[own[begins]] += np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
    whole = np.bincount(row, minlength=n)
    return np.packbits(2 * count > whole[:, None], axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """id and fp of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _text.chunks(batches, "text"):
            found = fingerprints(*_text.text_bytes(chunk.column("text")), words, seed)
            yield pa.RecordBatch.from_arrays([chunk.column("id"), pa.array(found)], names=["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _masks(distance: int, blocks: int) -> list[int]:
    """The bits of every choice of blocks that close fingerprints may agree in."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    block = [(1 << edges[k + 1]) - (1 << edges[k]) for k in range(blocks)]
    return [sum(chosen) for chosen in combinations(block, blocks - distance)]


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(classes: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, crowd: int = CROWD) -> DataFrame:
    """a and b: pairs of fingerprints ``fp`` of the classes that join all that is within the distance (1 or 2), directly or by others."""
    if distance not in (1, 2) or not distance < blocks <= 16:
        raise ValueError("the distance must be 1 or 2, and less than the blocks")
    masks, fp = _masks(distance, blocks), F.col("fp")
    keys = F.array(*(F.struct(F.lit(k).alias("choice"), F.xxhash64(F.lit(k), fp.bitwiseAND(F.lit(_signed(m)))).alias("key")) for k, m in enumerate(masks)))
    keyed = stored(classes.select("fp", F.explode(keys).alias("k")).select("fp", "k.choice", "k.key"))
    shared = stored(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("size", F.col("n")))
    keyed = stored(looked_up(keyed, shared, "key", ["fp"]))

    few = keyed.where(F.col("size") <= crowd)
    pairs = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key").where("a < b")

    # distance 1: a place of the key itself is enough on one side, but both sides one bit away would be two bits apart
    steps = [F.array(F.lit(0), *(F.lit(_signed(1 << b)) for b in range(64) if not m >> b & 1)) for m in masks]
    places = F.explode(F.transform(F.element_at(F.array(*steps), F.col("choice") + 1), lambda bit: fp.bitwiseXOR(bit))).alias("place")
    crowds = keyed.where(F.col("size") > crowd).select("fp", places).groupBy("place").agg(F.collect_set("fp").alias("near")).where(F.size("near") > 1)
    if distance == 2:
        starred = crowds.select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
    else:  # who stands at the place itself is one bit from all others there
        starred = crowds.where(F.array_contains("near", F.col("place"))).select(F.col("place").alias("a"), F.explode("near").alias("b"))
    found = pairs.select("a", "b").unionAll(starred.where("a != b"))
    return found.where(_apart("a", "b") <= distance).distinct()


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE, blocks: int = BLOCKS, words: int = WORDS, seed: int = SEED, crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (the least id that links reach) of every row."""
    rows = stored(fingerprinted(docs, id_col, text_col, words, seed))
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")))
    labels = components(stored(links(classes, distance, blocks, crowd)))
    labelled = classes.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    ids = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    table = stored(labelled.join(ids, "component").select("fp", "n", "component_id"))
    found = looked_up(rows, table, "fp", ["id"])
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
