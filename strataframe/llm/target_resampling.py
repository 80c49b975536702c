"""Importance resampling of documents towards a target distribution of hashed word n-grams.

1. Count.  Each task adds up the buckets of its texts' features with ``bincount``
   to one vector; the vectors, one a partition, are merged by a tree reduction.
2. Weigh.  A bucket's gain is the logarithm of how much likelier it is in the
   target, in thousandths.  The gains (one number a bucket, a fixed size) are
   broadcast; each task gathers those of its features and adds them up a
   document, by ``bincount`` with weights.  A document's weight is their floored mean.
3. Draw.  A number from the hash of the id turns weights into scores so that the
   highest are a weighted draw without replacement.  Scores are dealt by ranges and sorted in
   each; a prefix sum over the ranges' sizes, a row a range, gives every row its rank.

Features are hashed by CRC-32, byte by byte for all words of a chunk at once;
words of more than ``LONG`` bytes one by one.

Cases: a null text has no words; a document without features has weight 0; a
null id is hashed as an empty one and comes last among equal scores; repeated rows count and are drawn each by
itself, in any order among themselves; a very long text is weighed whole; only the named columns are
read, and others may have any name; an empty target or table has the counts 0,
and an empty table gives an empty result.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import _text
from ._shared import partitions, stored

BUCKETS = 10_000
WORDS = 2
LEAST_WORDS, PERCENT = 20, 25
LONG = 64
#: Levels of the tree that merges the partitions' vectors.
DEPTH = 3

_SOLID = np.zeros(256, bool)
_SOLID[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()
_ONES = np.uint32(0xFFFFFFFF)


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of letters, digits and non-ASCII; words end with their text."""
    solid = _SOLID[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offsets] = True
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    return start, np.flatnonzero(ends) + 1, np.searchsorted(offsets, start, side="right") - 1


def crc_states(buf: np.ndarray, start: np.ndarray, end: np.ndarray, state: np.ndarray) -> np.ndarray:
    """The CRC-32 registers (checksums with all bits turned) after the bytes of each span, from those before."""
    length = end - start
    order = np.argsort(length, kind="stable")
    start, length, state = start[order], length[order], state[order]
    short = int(np.searchsorted(length, LONG, side="right"))
    for p in range(int(length[short - 1]) if short else 0):
        some = slice(int(np.searchsorted(length[:short], p, side="right")), short)
        now = state[some]
        state[some] = _CRC[(now ^ buf[start[some] + p]) & 255] ^ (now >> np.uint32(8))
    for k in range(short, len(length)):
        state[k] = zlib.crc32(buf[start[k] : start[k] + length[k]], int(state[k] ^ _ONES)) ^ 0xFFFFFFFF
    out = np.empty_like(state)
    out[order] = state
    return out


def features(buf: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS, most: int = WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket and row of every word, then of every pair of neighbours, and so on up to ``most`` words."""
    buf = _text.ascii_lower(buf)
    start, end, row = words(buf, offsets)
    state = crc_states(buf, start, end, np.full(len(start), _ONES))
    yield (state ^ _ONES) % np.uint32(buckets), row
    for n in range(1, most):
        inside = np.flatnonzero(row[n:] == row[: len(row) - n]) if len(row) > n else np.zeros(0, np.int64)
        first = state if n == 1 else kept
        now = first[inside]
        now = _CRC[(now ^ np.uint32(32)) & 255] ^ (now >> np.uint32(8))
        kept = np.zeros(len(row), np.uint32)
        kept[inside] = crc_states(buf, start[inside + n], end[inside + n], now)
        yield (kept[inside] ^ _ONES) % np.uint32(buckets), row[inside]


def counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS, most: int = WORDS) -> np.ndarray:
    """How often each bucket holds a feature of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for chunk in _text.chunks(batches, "text"):
            for bucket, _ in features(*_text.text_bytes(chunk.column("text")), buckets, most):
                total += np.bincount(bucket, minlength=buckets)
        yield pa.record_batch({"counts": pa.array([total.tobytes()], pa.binary())})

    vectors = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "counts binary").rdd
    if not vectors.getNumPartitions():
        return np.zeros(buckets, np.int64)
    return vectors.map(lambda r: np.frombuffer(r.counts, np.int64)).treeReduce(operator.add, DEPTH)


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of how much likelier each bucket is in the target, one added to every count, floored."""
    buckets = len(own)
    ratio = (target + 1.0) * (own.sum() + float(buckets)) / ((own + 1.0) * (target.sum() + float(buckets)))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", most: int = WORDS) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain.astype(np.float64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for chunk in _text.chunks(batches, "text"):
            n = np.zeros(len(chunk), np.int64)
            total, n_words = np.zeros(len(chunk), np.float64), None
            for bucket, row in features(*_text.text_bytes(chunk.column("text")), len(gain), most):
                n += (own := np.bincount(row, minlength=len(chunk)))
                n_words = own if n_words is None else n_words
                total += np.bincount(row, weights=gain[bucket], minlength=len(chunk))  # whole numbers under 2 ** 53: exact
            weight = np.where(n > 0, total.astype(np.int64) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([chunk.column("id"), pa.array(n_words), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def scored(weighed: DataFrame, seed: int = 7) -> DataFrame:
    """The rows with score: the weight and a Gumbel number, in thousandths, from the hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise)


def drawn(rows: DataFrame, least_words: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """The stored rows with rank: 1, 2, ... for the given share of those of enough words with the highest scores, ties to the smaller id; else null."""
    spark = rows.sparkSession
    fit = rows.where(F.col("n_words") >= least_words)
    most = fit.count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    dealt = stored(fit.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()))
    part, within = F.shiftrightunsigned("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    dealt = dealt.withColumns({"part": part, "within": within})
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    begins = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("size")).select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("within") + 1
    ranked = dealt.join(F.broadcast(begins), "part").select(*rows.columns, F.when(rank <= most, rank).alias("rank"))
    return ranked.unionAll(rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS, most: int = WORDS,
    least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = 7,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row; rows with a rank are the sample, in the order drawn."""
    gain = gains(counts(docs, text_col, buckets, most), counts(target, target_text, buckets, most))
    rows = scored(weigh(docs, gain, id_col, text_col, most), seed)
    return drawn(stored(rows.withColumn("row", F.monotonically_increasing_id())), least_words, percent).drop("row")
