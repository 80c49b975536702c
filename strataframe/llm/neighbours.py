"""Nearest neighbours by a block matrix join on int8 codes.

Every vector is scaled to int8; the length of what rounding left over bounds
the error of its code, so a product of int8 tiles gives every distance up to
the sum of the two bounds, and up to the rounding of the squares and the product
it is made of, which is in proportion to the vectors' lengths.  Pairs whose lower
bound isn't above the k-th least upper bound survive; their distances are computed anew in
double precision from the original vectors.  Each task keeps the k best of each query in
heaps, and the tasks' lists are merged.  No true neighbour can be lost.

Queries come in blocks of what a task may hold.  A block first meets one row in ``FEW``,
whose k-th nearest bounds what can be among the k nearest of all; then it meets every
row, and tasks return only what lies within that bound.  So what is shuffled grows with the queries,
by about ``FEW`` * k rows each, and not with the number of tasks too.  What is found is written before the next block
is read, so driver and tasks hold one block at a time.  All vectors are read once a block: dealing them to pairs of
blocks instead would shuffle them as many times as they are read now.

Cases: a vector takes no part if it, one of its components or its id is null,
if a component isn't finite or if all are zero; vectors of different lengths are not
compared; ties go to the smaller id; rows that repeat an id count as one row,
at its nearest distance; of a vector that many rows share all rows are compared exactly, and k kept a tile; empty tables give an empty result.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ._shared import discard, stored

#: What a task may hold of a block of queries and of what it finds for them, in bytes.
MEMORY = 256 << 20
#: One row in so many bounds the distances of each query's nearest.
FEW = 64
TILE = 1024
#: The bytes of a component (as it is, as a code, as a factor), of an entry of a heap and of a query beside them.
_COMPONENT, _ENTRY, _QUERY = 13, 160, 512


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """ids and vectors of the rows, by length."""
    column, ids = batch.column("vector"), batch.column("id").to_numpy(zero_copy_only=False)
    flat, bounds = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))
    length = np.diff(bounds)
    for n in np.unique(length):
        rows = np.flatnonzero(length == n)
        yield ids[rows], flat[bounds[rows][:, None] + np.arange(n)]


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, the length of each decoded vector's step, and the error's bound."""
    step = np.abs(x).max(axis=1) / 127
    code = np.rint(x / step[:, None]).astype(np.int8)
    error = np.linalg.norm(x - code * step[:, None], axis=1)
    return code, step, error * (1 + 1e-9) + 1e-12 * np.linalg.norm(x, axis=1)


def bounds(a_square: np.ndarray, b_square: np.ndarray, product: np.ndarray, error: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of distances, from the squares and products of decoded vectors and the sum of their errors.

    The sum of squares and product is off by a few roundings of its largest term; near vectors cancel, so this must not be taken relative to the distance.
    """
    square, rounding = a_square + b_square - 2 * product, 16 * np.finfo(float).eps * (a_square + b_square)
    low, high = np.sqrt(np.maximum(0, square - rounding)), np.sqrt(np.maximum(0, square + rounding))
    return np.maximum(0, low - error) * (1 - 1e-9), (high + error) * (1 + 1e-9)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, summed in the order of the components."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        diff = a[:, d] - b[:, d]
        total += diff * diff
    return np.sqrt(total)


def _best(i: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int, repeats: bool) -> np.ndarray:
    """Places of the k best of each query ``i``, an id once."""
    if repeats:
        order = np.lexsort((score, ids, i))
        first = np.ones(len(order), bool)
        first[1:] = (i[order][1:] != i[order][:-1]) | (ids[order][1:] != ids[order][:-1])
        some = order[first]
    else:
        some = np.arange(len(i))
    order = some[np.lexsort((ids[some], score[some], i[some]))]
    begins = np.flatnonzero(np.diff(i[order], prepend=-1))
    return order[np.arange(len(order)) - np.repeat(begins, np.diff(begins, append=len(order))) < k]


def _search(queries: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int):
    """A task that finds the k nearest of each query among its rows, of those within the query's bound. queries: ids, vectors and bounds, by length."""
    sides = {}
    for ids, q, within in queries:
        code, step, error = encode(q)
        sides[q.shape[1]] = ids, q, code, step, error, (code.astype(np.float64) ** 2).sum(1) * step**2, within

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], dict[int, float]] = {}  # of each query: id -> distance, the k best so far
        worst = {n: side[6].copy() for n, side in sides.items()}
        # products of int8 codes are exact in float32 while n * 127 * 127 stays under 2 ** 24
        factor = {n: side[2].astype(np.float32 if n < 1000 else np.float64) for n, side in sides.items()}
        for batch in batches:
            for ids, all_vectors in _matrices(batch) if batch.num_rows else ():
                n = all_vectors.shape[1]
                if n not in sides:
                    continue
                q_ids, q, _, q_step, q_error, q_square, _ = sides[n]
                for at in range(0, len(ids), TILE):
                    c_ids, c = ids[at : at + TILE], all_vectors[at : at + TILE]
                    code, step, error = encode(c)
                    c_square, c_factor, repeats = (code.astype(np.float64) ** 2).sum(1) * step**2, code.astype(factor[n].dtype), _repeats(c_ids)
                    for q0 in range(0, len(q_ids), TILE):
                        rows = slice(q0, q0 + TILE)
                        low, high = bounds(q_square[rows, None], c_square, (q_step[rows, None] * step) * (factor[n][rows] @ c_factor.T), q_error[rows, None] + error)
                        bound = worst[n][rows]
                        own = q_ids[rows, None] == c_ids
                        if len(c_ids) > k and not repeats:
                            bound = np.minimum(bound, np.partition(np.where(own, np.inf, high), k - 1, axis=1)[:, k - 1])
                        i, j = np.nonzero((low <= bound[:, None]) & ~own)
                        exact = distances(q[q0 + i], c[j])
                        near = exact <= worst[n][q0 + i]
                        i, j, exact = q0 + i[near], j[near], exact[near]
                        kept = _best(i, c_ids[j], exact, k, repeats)
                        for a, b, d in zip(i[kept].tolist(), c_ids[j[kept]].tolist(), exact[kept].tolist(), strict=True):
                            heap = best.setdefault((n, a), {})
                            if d <= heap.get(b, np.inf):
                                heap[b] = d
                        for a in np.unique(i).tolist():
                            nearest_k = heapq.nsmallest(k, best[n, a].items(), key=lambda x: (x[1], x[0]))
                            best[n, a] = dict(nearest_k)
                            if len(nearest_k) == k:
                                worst[n][a] = nearest_k[-1][1]
        entries = ((int(sides[n][0][a]), b, d) for (n, a), kept in best.items() for b, d in kept.items())
        while some := list(itertools.islice(entries, 65_536)):
            q_id, b, d = zip(*some, strict=True)
            yield pa.record_batch({"query_id": pa.array(q_id, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(d, pa.float64())})

    return task


def _repeats(ids: np.ndarray) -> bool:
    return len(np.unique(ids)) < len(ids)


def _ranked(found: DataFrame) -> DataFrame:
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    return found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", memory: int = MEMORY, few: int = FEW) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (the distance) of each query's k nearest rows."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.transform(vector_col, lambda v: v.cast("double")).alias("vector"), is_query.alias("is_query"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda v: v != 0))
    asked = stored(rows.where("is_query").groupBy("id").agg(F.min("vector").alias("vector")))
    rows = rows.select("id", "vector")
    first = stored(rows.where(F.pmod(F.xxhash64("id", F.lit("few")), F.lit(few)) == 0))
    held = asked.agg(F.sum(F.size("vector") * _COMPONENT + (k * _ENTRY + _QUERY))).first()[0] or 0
    blocks = -(-held // memory) or 1

    def search(part: list, among: DataFrame, within: dict[int, float]) -> DataFrame:
        by_length: dict[int, list] = {}
        for r in part:
            by_length.setdefault(len(r.vector), []).append(r)
        queries = [(np.array([r.id for r in own]), np.array([r.vector for r in own]), np.array([within.get(r.id, np.inf) for r in own])) for own in by_length.values()]
        return among.mapInArrow(_search(queries, k), "query_id long, vec_id long, score double")

    def nearest_of(block: int) -> DataFrame:
        part = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).collect()
        within = {r.query_id: r.score for r in _ranked(search(part, first, {})).where(F.col("rank") == k).collect()}
        return search(part, rows, within)

    if blocks == 1:
        found = nearest_of(0)
    else:
        found = rows.sparkSession.read.parquet(*(stored(nearest_of(n))._stored_at for n in range(blocks)))
    discard(asked, first)
    return _ranked(found).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
