"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader (FTRL-proximal) updates, scored as sparse dot products.

Tokens are runs of letters and digits or runs of other signs.  Two streams of
tokens give n-grams: the lower-cased tokens (1 and 2 of them), and the tokens'
kinds (1 to 3): lower case, capitalised, upper case, number, the signs
themselves, or "same as two tokens' neighbours before" for a repeated word.
Each n-gram is hashed to one of ``2 ** BITS`` weights; a feature's value is its
share of the text's n-grams, times ``SCALE``.

Cases: a null or empty text has no n-grams and gets the score of the bias
alone; rows with a null label don't train; of training rows with the same key the
one of the smallest text, then label, counts; without any training row the score
is 0.5; a very long text is scored whole (its n-grams are summed in one
chunk); repeated rows score alike; other columns may have any name, and where
``keep`` or ``extra`` holds the name of the score's column, choose another with ``into``;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from . import _text
from ._shared import stored, unused

BITS = 18
SCALE = 30.0
#: At most about so many labelled rows are fitted, those of the smallest hash; every row is scored.
TRAIN_ROWS = 20_000
#: ... and so many bytes of their texts, so that a few very long ones can't fill a task (the first row always counts).
TRAIN_BYTES = 256 << 20
#: A part's rows are gone over until it has made about so many updates, between 2 and 20 times.
UPDATES = 10_000

_KIND = np.full(256, 2, np.uint8)  # 0 space, 1 letter or digit, 2 sign
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_UPPER, _DIGIT = np.zeros(256, np.int64), np.zeros(256, np.int64)
_UPPER[65:91] = 1
_DIGIT[48:58] = 1


def features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, text by text, and the n+1 bounds of each text's."""
    n = len(offsets) - 1
    kind = _KIND[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[offsets] = True
    change = np.ones(len(buf), bool)
    change[1:] = kind[1:] != kind[:-1]
    starts = np.flatnonzero(change | first[:-1]) if len(buf) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(buf))
    real = kind[starts] > 0 if len(buf) else np.zeros(0, bool)
    starts, ends = starts[real], ends[real]
    m = len(starts)
    if not m:
        return np.zeros(0, np.int64), np.zeros(n + 1, np.int64)
    row = np.searchsorted(offsets, starts, side="right") - 1
    lower = _text.byte_prefix(_text.ascii_lower(buf)).spans(starts, ends)
    uppers, digits = (np.concatenate(([0], np.cumsum(t[buf]))) for t in (_UPPER, _DIGIT))
    up, dig, length = uppers[ends] - uppers[starts], digits[ends] - digits[starts], ends - starts
    word = kind[starts] == 1
    shape = np.where(dig > 0, 4, np.where((up >= 2) & (2 * up >= length), 3, np.where(up > 0, 2, 1))).astype(np.uint64)
    again = np.zeros(m, bool)
    for back in (1, 2, 3):
        again[back:] |= word[back:] & (lower[back:] == lower[:-back]) & (row[back:] == row[:-back])
    shape[again] = 5
    shape = np.where(word, shape, lower)
    grams, rows = [], []
    for seed, codes, longest in ((11, lower, 2), (13, shape, 3)):
        h = np.zeros(m, np.uint64)
        for size in range(1, longest + 1):
            h = h[: m - size + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[size - 1 :]
            same = row[: m - size + 1] == row[size - 1 :]
            grams.append((_text.mix(h + np.uint64(seed * 8 + size)) >> np.uint64(64 - BITS)).astype(np.int64)[same])
            rows.append(row[: m - size + 1][same])
            if m <= size:
                break
    rows, grams = np.concatenate(rows), np.concatenate(grams)
    order = np.argsort(rows, kind="stable")
    return grams[order], _text.row_ranges(rows[order], n)


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], epochs: int, alpha: float = 0.1, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4) -> np.ndarray:
    """Weights after FTRL-proximal updates, example by example; the last weight is the bias."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weight(at: np.ndarray) -> np.ndarray:
        zi = z[at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for at, value, label in examples:
            w = weight(at)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - label) * value
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weight(np.arange(len(z)))


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "quality", key: Column | None = None, max_rows: int = TRAIN_ROWS, max_bytes: int = TRAIN_BYTES, parts: int = 4, labels: DataFrame | None = None, id_col: str = "doc_id") -> np.ndarray | None:
    """Weights fitted on at most ``max_rows`` labelled rows, those whose hashed key is smallest; rows of one key count once.

    labels: a table of one label an id, for rows that have none of their own; the id is the key then.
    Ids meet their labels without texts, and only the rows to fit send theirs.

    Up to ``parts`` models are fitted beside each other on a share of the rows
    each and then averaged, so no task has more than ``max_rows / parts`` rows, give
    or take; the driver gets at most ``parts`` times the number of weights.
    """
    by = F.xxhash64(id_col if labels is not None else key if key is not None else F.col(text_col)).alias("key")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("size")
    label = F.col(label_col).cast("int").alias("label")
    if labels is None:
        rows = labelled.select(F.col(text_col).alias("text"), label, by, size).where("label is not null")
        found = rows.select("key", "size", "label")
    else:
        found = labelled.select(F.col(id_col).alias("id"), by, size).join(labels.select(F.col(id_col).alias("id"), label).where("label is not null"), "id")
    kept = stored(found.groupBy("key").agg(F.min("size").alias("size"), F.min("label").alias("label")).orderBy("key").limit(max_rows))
    before = F.sum("size").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)) - F.min("size").over(Window.orderBy("key").rowsBetween(Window.unboundedPreceding, 0))  # at most max_rows thin rows
    limit = kept.withColumn("before", before).where(F.col("before") <= max_bytes).agg(F.max("key"), F.count(F.lit(1))).first()
    if not limit[1]:
        return None
    parts = max(1, min(parts, limit[1] // 1000))  # a few rows make one model
    inside = F.col("key") <= F.lit(limit[0])
    if labels is not None:
        rows = labelled.select(F.col(text_col).alias("text"), by).join(F.broadcast(kept.where(inside).select("key", "label")), "key")
    rows = rows.where(inside).groupBy("key").agg(F.min(F.struct("text", "label")).alias("row")).select("key", "row.*").withColumn("part", F.pmod("key", F.lit(parts)))

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("label", "ascending")])
        examples = []
        for chunk in _text.chunks(iter(table.to_batches()), "text"):
            grams, bounds = features(*_text.text_bytes(chunk.column("text")))
            for i, label in enumerate(chunk.column("label").to_pylist()):
                at, count = np.unique(grams[bounds[i] : bounds[i + 1]], return_counts=True)
                examples.append((np.append(at, 1 << BITS), np.append(count * (SCALE / max(1, count.sum())), 1.0), int(label > 0)))
        w = ftrl(examples, min(20, max(2, UPDATES // max(1, len(examples)))))
        at = np.flatnonzero(w)
        return pa.table({"place": at.astype(np.int64), "weight": w[at]})

    w = np.zeros((1 << BITS) + 1)
    fitted = rows.groupBy("part").applyInArrow(fit, "place long, weight double")
    for r in fitted.groupBy("place").agg(F.sum("weight").alias("weight")).toLocalIterator():
        w[r.place] = r.weight / parts
    return w.astype(np.float32)


def score(docs: DataFrame, weights: np.ndarray | None, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, extra: dict[str, Column] | None = None, into: str = "score") -> DataFrame:
    """id (or the columns of ``keep``), the columns of ``extra``, and the score of every row in the column ``into``."""
    cols = keep or [id_col]
    docs = docs.select(*cols, *(c.alias(k) for k, c in (extra or {}).items()), F.col(text_col))
    docs = docs.toDF(*docs.columns[:-1], unused(docs, "__text")[0])
    schema = T.StructType(docs.schema.fields[:-1]).add(into, "double")
    text = docs.columns[-1]
    w = weights if weights is not None else np.zeros((1 << BITS) + 1, np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _text.chunks(batches, text, 1 << 20):
            grams, bounds = features(*_text.text_bytes(chunk.column(text)))
            sums = np.concatenate(([0.0], np.cumsum(w[grams], dtype=np.float64)))
            dot = SCALE * (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(1, np.diff(bounds)) + float(w[-1])
            yield pa.RecordBatch.from_arrays([*chunk.columns[:-1], pa.array(1 / (1 + np.exp(-np.clip(dot, -35, 35))))], names=schema.names)

    return docs.mapInArrow(run, schema)


def keep_good(docs: DataFrame, weights: np.ndarray | None, least: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is ``least`` or more."""
    (into,) = unused(docs, "__score")
    return score(docs, weights, text_col=text_col, keep=docs.columns, into=into).where(F.col(into) >= least).drop(into)
