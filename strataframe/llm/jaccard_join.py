"""N-gram Jaccard join with signature trees.

A document's set holds its distinct word shingles; two documents link when
their sets' Jaccard similarity reaches ``percent``.  Documents of equal sets are
one class, so copies are never compared.

1. Routing.  Similar sets share one of the first n - ceil(n * percent) + 1
   shingles of either in any fixed order, so each class is routed by those.
   The order puts frequent shingles last: their counts come from all
   documents, and at most ``HOT`` of them are kept.  It only changes how much
   is compared, never what is found.  A row tells its class's size and the largest set
   that could still link if this shingle is the first shared; of a bucket only classes that
   fit another one there stay (all of a bucket of more than ``NEAR``).  A shingle's bucket is named after its least class
   (a frequent shingle's after a class fixed beforehand, so its rows are never
   brought together), and classes of one name form a group; two classes that
   share a bucket share that group.
2. Signature trees.  Groups are cut into bands of size, and bands of more classes
   than a task should hold into blocks.  Each block builds a tree over its classes
   sorted by size: a node has the OR of its token bitmaps and its range of
   sizes.  A dual traversal drops pairs of nodes whose largest possible overlap
   is too small.  The first traversal needs the signatures only and drops
   classes without a possible partner; texts are sent for the rest (a text is
   no larger than the hashes of its shingles), whose pairs left at the leaves are
   verified on the sets, unless links found before connect them.  What a place has linked
   is given as links to the least class, so that places with the same classes give the same links.
3. Large groups.  Each block is joined by itself first.  Then a few classes of
   each component in the group stand for it, and these are joined the same way,
   round by round, so near copies, however many, soon are one component.  At last only classes of
   different components still have to meet: the blocks of a group's largest component meet
   those of all others, but not each other.
4. Components of the links give each document its class id.

What is sent grows in proportion to a group of near copies.  It grows with the
square only for a group of *different* sets, or of several large components, that share
a rare shingle and don't link.

Cases: documents without words, or null, have empty sets and link with nothing;
fewer words than a shingle make one shingle of all; repeated rows are copies;
a null id takes part in links but is no class id unless all of its class are null;
an empty table gives an empty result.  Very long texts are handled whole, few in a block;
only the named columns are read, and others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import _text
from ._shared import looked_up, stored, unused
from .components import components

WORDS = 5
PERCENT = 75
#: Most frequent shingles that are put last, and the least count of one.
HOT, HOT_LEAST = 50_000, 16
#: Classes in a block, and about how many shingles they have together at most.
BLOCK, BLOCK_SHINGLES = 512, 4 << 20
#: Bands of sizes; sets of band ``LAST_BAND`` and larger ones have signatures of the same width.
BANDS, LAST_BAND = 24, 10
#: Most rounds in which components of large groups are joined by so many classes of each, before all that is left is compared.
ROUNDS, STAND = 6, 4
#: Rows of a bucket that are compared with each other, and rows of one that are held.
NEAR, HELD = 64, 1 << 16
#: At most so many classes whose texts are wanted are sent to all tasks; if there are more, texts are shuffled to meet them.
SENT = 2_000_000
_FLUSH = 16 << 20
#: A routed row's key: 41 bits of the shingle's hash, 11 each of two sizes, and one that tells a name (1) from a shingle (0).
_HASH, _SIZE, _MOST, _CODE = 23, 12, 1, (1 << 11) - 1
_STEPS = np.unique(np.floor(1.011 ** np.arange(2000)).astype(np.int64))


def shingles(buf: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all texts, sorted in each text, and the n+1 bounds."""
    n = len(offsets) - 1
    start, end, row = _text.words(buf, offsets)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    word = _text.byte_prefix(_text.ascii_lower(buf)).spans(start, end)
    bounds = _text.row_ranges(row, n)
    first = np.arange(len(word))
    last = np.minimum(first + words, bounds[row + 1])
    keep = (last - first == words) | (first == bounds[row])  # a short text's only shingle begins with it
    first, last, row = first[keep], last[keep], row[keep]
    value = _text.Prefix(word).spans(first, last)
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    fresh = np.ones(len(value), bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[fresh], _text.row_ranges(row[fresh], n)


def classes(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each set, and its size."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_text.mix(values + np.uint64(0x51ED27)))))
    size = np.diff(bounds)
    return _text.mix(sums[bounds[1:]] - sums[bounds[:-1]] + size.astype(np.uint64)).view(np.int64), size


def prefix_length(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return np.where(size > 0, size - -(-size * percent // 100) + 1, 0)


def bands(size: np.ndarray) -> np.ndarray:
    """The band of each size: its signature has 64 << band bits, two a shingle at least, up to band ``LAST_BAND``."""
    return np.searchsorted([32 << k for k in range(BANDS)], size)


def signatures(values: np.ndarray, size: np.ndarray, bits: int | None = None) -> pa.Array:
    """A bitmap of each set's shingles, as wide as its band asks or of so many bits."""
    width = np.full(len(size), bits, np.int64) if bits else np.int64(64) << np.minimum(bands(size), LAST_BAND)
    at = np.concatenate(([0], np.cumsum(width)))
    bits = np.zeros(at[-1], bool)
    row = np.repeat(np.arange(len(size)), size)
    bits[at[row] + ((values >> np.uint64(20)) & (width[row] - 1).astype(np.uint64)).astype(np.int64)] = True
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer((at // 8).astype(np.int32)), pa.py_buffer(np.packbits(bits, bitorder="little"))])


def describe(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """id, key (of id and text), class, size and signature of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _text.chunks(batches, "text"):
            values, bounds = shingles(*_text.text_bytes(chunk.column("text")), words)
            cls, size = classes(values, bounds)
            yield pa.RecordBatch.from_arrays([chunk.column("id"), chunk.column("key"), pa.array(cls), pa.array(size), signatures(values, size)], names=["id", "key", "cls", "size", "signature"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, key long, cls long, size long, signature binary")


def frequent(docs: DataFrame, text_col: str, words: int, most: int, least: int) -> dict[int, int]:
    """The most frequent shingles, at most ``most``, and for each a class that names its group.

    Each task counts the shingles that come twice or more in a stretch of its texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            value, cls = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(value, kind="stable")
            value, cls = value[order], cls[order]
            first = np.flatnonzero(np.append(True, value[1:] != value[:-1])) if len(value) else np.zeros(0, np.int64)
            count = np.diff(np.append(first, len(value)))
            often = count >= 2
            name = np.minimum.reduceat(cls, first)[often] if len(first) else cls[:0]
            return pa.record_batch({"shingle": value[first[often]].view(np.int64), "n": count[often], "name": name})

        for chunk in _text.chunks(batches, "text"):
            values, bounds = shingles(*_text.text_bytes(chunk.column("text")), words)
            cls, n = classes(values, bounds)
            _, fresh = np.unique(cls, return_index=True)  # copies count once a chunk
            n_fresh = n[fresh]
            held.append((values[_text.spread(bounds[fresh], n_fresh)], np.repeat(cls[fresh], n_fresh)))
            size += chunk.column("text").nbytes
            if size >= _FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    counts = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "shingle long, n long, name long")
    counts = counts.groupBy("shingle").agg(F.sum("n").alias("n"), F.min("name").alias("name")).where(F.col("n") >= least)
    top = counts.orderBy(F.desc("n"), "shingle").limit(most)
    return {r.shingle: r.name for r in top.toLocalIterator()}


def _coded(size: np.ndarray) -> np.ndarray:
    """Sizes in 11 bits: a larger one never has a smaller code."""
    return np.searchsorted(_STEPS, size, side="right")


def fitting(key: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """name and class of those that may link, in whole buckets sorted by key and class; a bucket's name is its least class that stays.

    Two classes fit if neither is larger than what the other allows.
    """
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
    key, cls = key[fresh], cls[fresh]
    _, bucket, count = np.unique(key >> _HASH, return_inverse=True, return_counts=True)
    own = count[bucket]
    key, cls, bucket, own = (x[own > 1] for x in (key, cls, bucket, own))
    size, most = (key >> _SIZE) & _CODE, (key >> _MOST) & _CODE
    stays = own > NEAR
    at = np.flatnonzero(~stays)
    for step in range(1, NEAR):
        at = at[own[at] > step]
        first = at[at + step < len(key)]
        first = first[bucket[first + step] == bucket[first]]
        first = first[(size[first + step] <= most[first]) & (size[first] <= most[first + step])]
        stays[first] = True
        stays[first + step] = True
    cls, bucket = cls[stays], bucket[stays]
    start = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(bucket) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(cls, start) if len(start) else cls
    return np.repeat(least, np.diff(np.append(start, len(cls)))) | 1, cls


def route(docs: DataFrame, hot: dict[int, int], text_col: str, words: int, percent: int, held: int = HELD) -> DataFrame:
    """name and class: classes that share a name may be similar."""
    hot_value = np.array(sorted(hot), np.int64)
    hot_name = np.array([hot[int(v)] for v in hot_value], np.int64)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _text.chunks(batches, "text"):
            values, bounds = shingles(*_text.text_bytes(chunk.column("text")), words)
            cls, size = classes(values, bounds)
            row = np.repeat(np.arange(len(size)), size)
            signed = values.view(np.int64)
            place = np.searchsorted(hot_value, signed)
            is_hot = np.zeros(len(values), bool)
            inside = place < len(hot_value)
            is_hot[inside] = hot_value[place[inside]] == signed[inside]
            order = np.argsort(2 * row + is_hot, kind="stable") if is_hot.any() else np.arange(len(values))
            rank = np.arange(len(values)) - bounds[row]
            _, fresh = np.unique(cls, return_index=True)
            only = np.zeros(len(cls), bool)
            only[fresh] = True
            chosen = (rank < prefix_length(size, percent)[row]) & only[row]
            taken, left = order[chosen], (size[row] - rank)[chosen]
            warm = taken[is_hot[taken]]
            named = np.unique(np.stack([hot_name[place[warm]], cls[row[warm]]], axis=1), axis=0) if len(warm) else np.zeros((0, 2), np.int64)
            cold, left = taken[~is_hot[taken]], left[~is_hot[taken]]
            # sets link if (100 + percent) * shared >= percent * (both sizes), and no more than what is left is shared
            most = (100 + percent) * left // percent - size[row[cold]]
            key = (signed[cold] >> _HASH << _HASH) | _coded(size[row[cold]]) << _SIZE | _coded(most) << _MOST
            yield pa.record_batch({"key": np.concatenate([key, named[:, 0] | 1]), "cls": np.concatenate([cls[row[cold]], named[:, 1]])})

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by key and class."""
        key, cls = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the last bucket may go on in the next batch
        long, long_name = None, 0  # a bucket of too many rows to hold
        for batch in batches:
            more, more_cls = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            direct = more & 1 == 1
            out = [(more[direct], more_cls[direct])]
            key, cls = np.concatenate([key, more[~direct]]), np.concatenate([cls, more_cls[~direct]])
            if len(key):
                bucket = key >> _HASH
                done, last = np.searchsorted(bucket, long, side="right") if long is not None else 0, np.searchsorted(bucket, bucket[-1])
                out.append((np.full(done, long_name), cls[:done]))
                if last > done:
                    out.append(fitting(key[done:last], cls[done:last]))
                key, cls = key[max(done, last) :], cls[max(done, last) :]
                if len(key) > held:
                    long, long_name = bucket[-1], cls.min() | 1
                    out.append((np.full(len(cls), long_name), cls))
                    key, cls = key[:0], cls[:0]
            names, members = (np.concatenate(x) for x in zip(*out, strict=True))
            yield pa.record_batch({"name": names, "cls": members})
        names, members = fitting(key, cls)
        yield pa.record_batch({"name": names, "cls": members})

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(emit, "key long, cls long")
    dealt = rows.repartition(F.when(F.col("key").bitwiseAND(1) == 1, F.col("cls")).otherwise(F.shiftright("key", _HASH))).sortWithinPartitions("key", "cls")
    return dealt.mapInArrow(name, "name long, cls long").distinct()


class Tree:
    """A signature tree over sets sorted by size: levels of nodes, each half as long as the one below.

    A node has the OR of its bitmaps, the range of its sizes, and the most
    shingles that one of its sets has beyond the bits it sets.
    """

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, leaf: int = 4):
        self.maps, self.sizes, self.leaf = maps, sizes, leaf
        self.excess = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
        nodes, step = (maps, sizes, sizes, self.excess), leaf
        self.levels = []
        while not self.levels or len(self.levels[-1][1]) > 1:
            at = np.arange(0, len(nodes[1]), step)
            nodes = (np.bitwise_or.reduceat(nodes[0], at), np.minimum.reduceat(nodes[1], at), np.maximum.reduceat(nodes[2], at), np.maximum.reduceat(nodes[3], at))
            self.levels.append(nodes)
            step = 2

    def pairs(self, percent: int, apart: np.ndarray | None = None, done: np.ndarray | None = None, joined: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """By dual traversal, each set and those after it whose possible overlap is large enough.

        apart: bit flags of each set; only pairs whose flags share no bit count.
        done: sets that need no further partner; node pairs of such sets are dropped.
        joined: the component of each set; only pairs of different ones count.
        """
        n, leaf = len(self.sizes), self.leaf
        stack = [(len(self.levels) - 1, 0, 0)]
        while stack:
            level, a, b = stack.pop()
            maps, low, high, excess = self.levels[level]
            span = leaf << level
            if done is not None and done[a * span : (a + 1) * span].all() and done[b * span : (b + 1) * span].all():
                continue
            if a != b:
                if 100 * high[a] < percent * low[b]:
                    continue
                shared = int(np.bitwise_count(maps[a] & maps[b]).sum()) + min(excess[a], excess[b])
                if (100 + percent) * min(shared, high[a], high[b]) < percent * (low[a] + low[b]):
                    continue
            if level:
                under = len(self.levels[level - 1][1])
                below_a, below_b = ([x for x in (2 * k, 2 * k + 1) if x < under] for k in (a, b))
                stack += [(level - 1, x, y) for x in below_a for y in below_b if a != b or x <= y]
                continue
            rows_b = np.arange(b * leaf, min(n, (b + 1) * leaf))
            for i in range(a * leaf, min(n, (a + 1) * leaf)):
                others = rows_b[rows_b > i] if a == b else rows_b
                if apart is not None:
                    others = others[(apart[others] & apart[i]) == 0]
                if joined is not None:
                    others = others[joined[others] != joined[i]]
                if len(others):
                    shared = np.bitwise_count(self.maps[others] & self.maps[i]).sum(axis=1, dtype=np.int64) + np.minimum(self.excess[others], self.excess[i])
                    shared = np.minimum(shared, np.minimum(self.sizes[others], self.sizes[i]))
                    others = others[(100 + percent) * shared >= percent * (self.sizes[others] + self.sizes[i])]
                    if len(others):
                        yield i, others


def bitmaps(signatures: list[bytes], width: int) -> np.ndarray:
    """Signatures as rows of 64-bit words, the wider ones folded to the width."""
    out = np.zeros((len(signatures), width // 64), np.uint64)
    for i, data in enumerate(signatures):
        words = np.frombuffer(data, np.uint64)
        while len(words) > width // 64:
            words = words[: len(words) // 2] | words[len(words) // 2 :]
        out[i] = words
    return out


#: Flags of a row in a group: it is a guest from the next band, or of the first or the second block of a pair.
_GUEST, _FIRST, _SECOND = 1, 2, 4


def join_sets(cls: list[int], sets: list[np.ndarray], flags: list[int], percent: int = PERCENT, joined: list[int] | None = None) -> list[tuple[int, int]]:
    """Links that connect what all links connect, among sets whose flags share no bit and whose components, if given, differ.

    Each is from the least component (or class) of those that are linked to another one.
    """
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), int(sets[i][0])))
    cls, sets, joined = [cls[i] for i in order], [sets[i] for i in order], [(joined or cls)[i] for i in order]
    size = np.array([len(x) for x in sets], np.int64)
    width = 64 << min(int(bands(size).max()), LAST_BAND)
    tree = Tree(bitmaps(signatures(np.concatenate(sets), size, width).to_pylist(), width), size)
    first: dict[int, int] = {}
    parent = [first.setdefault(c, i) for i, c in enumerate(joined)]

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    linked = []
    for i, others in tree.pairs(percent, np.array(flags)[order], joined=np.array(joined)):
        for j in others.tolist():
            if find(i) != find(j):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                    parent[find(j)] = find(i)
                    linked += [i, j]
    least: dict[int, int] = {}
    for i in linked:
        least[find(i)] = min(joined[i], least.get(find(i), joined[i]))
    return sorted({(least[find(i)], joined[i]) for i in linked if joined[i] != least[find(i)]})


def needed(groups: DataFrame) -> DataFrame:
    """name and size of the groups to compare: of two classes or more, and not wholly inside another.

    A group is left out if all its classes are also in the group that comes
    first among those of its least class; names get smaller that way, so some group keeps every pair.
    """
    counts = groups.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.min("cls").alias("least")).where("n > 1")
    first = groups.groupBy(F.col("cls").alias("least")).agg(F.min("name").alias("parent"))
    inner = counts.join(first, "least").where("parent < name").select("name", "n", "parent")
    held = groups.join(inner, "name").join(groups.select(F.col("name").alias("parent"), "cls"), ["parent", "cls"])
    inside = held.groupBy("name", "n").agg(F.count(F.lit(1)).alias("held")).where("held = n").select("name")
    return counts.join(inside, "name", "left_anti").select("name", "n")


def _rows_of(band: Column, block: int) -> Column:
    """How many classes of a band make a block."""
    return F.greatest(F.lit(2), F.least(F.lit(block), F.floor(F.lit(BLOCK_SHINGLES) / F.pow(F.lit(2), band + 5)))).cast("int")


def _alone(members: DataFrame) -> DataFrame:
    """Members (name, band, cls, guest, blocks, comp), each in the block that its hash gives it: places (name, band, i, j, cls, flags, comp)."""
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    return members.select("name", "band", own.alias("i"), own.alias("j"), "cls", (F.col("guest") * _GUEST).cast("int").alias("flags"), "comp")


def _apart(members: DataFrame, block: int) -> DataFrame:
    """The places where members (name, band, cls, guest, comp) of different components meet, each pair of blocks in one."""
    counts = members.groupBy("name", "band", "comp").agg(F.count(F.lit(1)).alias("m"))
    counts = counts.groupBy("name", "band").agg(F.sum("m").alias("n"), F.max(F.struct("m", "comp")).alias("most"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    rows = _rows_of(F.col("band"), block)
    main = F.when(F.col("most.m") > rows, F.col("most.m")).otherwise(0)
    shape = stored(counts.select("name", "band", F.col("most.comp").alias("main"), F.ceil(main / rows).cast("int").alias("of_main"), F.ceil((F.col("n") - main) / rows).cast("int").alias("of_rest")))
    members = members.join(shape, ["name", "band"])
    is_main = (F.col("of_main") > 0) & (F.col("comp") == F.col("main"))
    turn = F.xxhash64("cls")
    members = members.withColumn("own", F.when(is_main, F.col("of_rest") + F.pmod(turn, F.greatest("of_main", F.lit(1)))).otherwise(F.pmod(turn, F.greatest("of_rest", F.lit(1)))).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("of_rest") - 1 + F.when(is_main, 0).otherwise(F.col("of_main")))))
    flags = F.col("guest") * _GUEST + F.when(F.col("own") < F.col("other"), _FIRST).when(F.col("own") > F.col("other"), _SECOND).otherwise(0)
    return members.select("name", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "cls", flags.cast("int").alias("flags"), "comp")


def prune(rows: DataFrame, percent: int) -> DataFrame:
    """The places (with size and signature) whose class may have a partner there."""
    columns = ["name", "band", "i", "j", "cls", "flags", "comp"]

    def group(table: pa.RecordBatch, start: int, end: int) -> np.ndarray:
        part = table.slice(start, end - start)
        size = part.column("size").to_numpy()
        order = np.argsort(size, kind="stable")
        found = np.zeros(end - start, bool)
        width = 64 << min(part.column("band")[0].as_py(), LAST_BAND)
        tree = Tree(bitmaps([part.column("signature")[int(k)].as_py() for k in order], width), size[order])
        for i, others in tree.pairs(percent, part.column("flags").to_numpy()[order], found, part.column("comp").to_numpy()[order]):
            found[i] = True
            found[others] = True
        return order[found] + start

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last group may go on in the next batch

        def done(table: pa.RecordBatch, last: bool) -> tuple[pa.RecordBatch, pa.RecordBatch]:
            keys = np.stack([table.column(c).to_numpy() for c in ("name", "band", "i", "j")])
            starts = np.flatnonzero(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
            ends = np.append(starts[1:], table.num_rows)
            if not last:
                starts, ends = starts[:-1], ends[:-1]
            found = [group(table, s, e) for s, e in zip(starts.tolist(), ends.tolist(), strict=True) if e - s > 1]
            rest = int(ends[-1]) if len(ends) else 0
            return table.select(columns).take(pa.array(np.concatenate([np.zeros(0, np.int64), *found]))), table.slice(rest)

        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0] if held is not None and held.num_rows else batch
                out, held = done(table, False)
                yield out
        if held is not None and held.num_rows:
            yield done(held, True)[0]

    dealt = rows.repartition("name", "band", "i", "j").sortWithinPartitions("name", "band", "i", "j")
    return dealt.mapInArrow(run, "name long, band int, i int, j int, cls long, flags int, comp long")


def _compare(kept: DataFrame, pool: DataFrame, words: int, percent: int) -> DataFrame:
    """A stored table of links ``a``, ``b`` among the classes that meet at the places ``kept``; pool: the text of each class."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        sets: list[np.ndarray] = []
        for chunk in _text.chunks(iter([batch]), "text"):
            values, bounds = shingles(*_text.text_bytes(chunk.column("text")), words)
            sets += [values[bounds[k] : bounds[k + 1]] for k in range(len(chunk))]
        found = join_sets(batch.column("cls").to_pylist(), sets, batch.column("flags").to_pylist(), percent, batch.column("comp").to_pylist())
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return stored(kept.join(pool, "cls").groupBy("name", "band", "i", "j").applyInArrow(run, "a long, b long"))


def links(docs: DataFrame, described: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, hot: int = HOT, hot_least: int = HOT_LEAST, block: int = BLOCK) -> DataFrame:
    """Pairs of classes ``a``, ``b`` that link, enough to connect all that any links connect."""
    groups = stored(route(docs, frequent(docs, text_col, words, hot, hot_least), text_col, words, percent))
    classes = stored(described.where("size > 0").groupBy("cls").agg(F.min("key").alias("key"), F.max("size").alias("size"), F.first("signature").alias("signature")))
    size = F.col("size")
    own = sum((size > (32 << k)).cast("int") for k in range(BANDS))
    # a set that may match one of the band before is a guest there
    near = (own > 0) & (percent * size <= 3200 * F.pow(F.lit(2), own - 1))
    places = F.when(near, F.array(F.struct(own.alias("band"), F.lit(0).alias("guest")), F.struct((own - 1).alias("band"), F.lit(1).alias("guest")))).otherwise(F.array(F.struct(own.alias("band"), F.lit(0).alias("guest"))))
    members = stored(groups.join(stored(needed(groups)).select("name"), "name").join(classes.select("cls", F.explode(places).alias("place")), "cls").select("name", "cls", "place.*"))
    counts = members.groupBy("name", "band").agg(F.count(F.lit(1)).alias("n"), F.min("guest").alias("guests")).where("n > 1 and guests = 0")
    counts = stored(counts.select("name", "band", F.ceil(F.col("n") / _rows_of(F.col("band"), block)).cast("int").alias("blocks")))
    members = stored(members.join(counts, ["name", "band"]).select("name", "band", "cls", "guest", "blocks", F.col("cls").alias("comp")))
    marks = stored(classes.select("cls", "size", "signature").join(members.select("cls").distinct(), "cls", "left_semi"))

    def pruned(at: DataFrame) -> DataFrame:
        return stored(prune(at.join(marks, "cls"), percent))

    kept = pruned(_alone(members))
    large = members.where("blocks > 1").drop("comp", "blocks")
    wanted = stored(kept.select("cls").unionAll(large.select("cls")).distinct().join(classes.select("cls", "key"), "cls"))
    texts = docs.select(F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    pool = stored(texts.join(F.broadcast(wanted) if wanted.count() <= SENT else wanted, "key").groupBy("cls").agg(F.first("text").alias("text")))
    found = _compare(kept, pool, words, percent)
    if large.isEmpty():
        return found

    def joined() -> DataFrame:
        """Members of large groups with the component that links so far give them."""
        of = components(found)
        return stored(large.join(of.select(F.col("node").alias("cls"), "component"), "cls", "left").select("name", "band", "cls", "guest", F.coalesce("component", "cls").alias("comp")))

    for turn in range(ROUNDS):
        # a few classes of each component, others in each round
        some = joined().withColumn("slice", F.pmod(F.xxhash64("cls", F.lit(turn)), F.lit(STAND)))
        some = some.groupBy("name", "band", "comp", "slice").agg(F.min(F.struct("guest", F.xxhash64("cls", F.lit(-turn)).alias("order"), "cls")).alias("one")).select("name", "band", "comp", "one.guest", "one.cls")
        sizes = stored(some.groupBy("name", "band").agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("name", "band", F.ceil(F.col("n") / _rows_of(F.col("band"), block)).cast("int").alias("blocks")))
        if sizes.isEmpty():
            return found
        more = _compare(pruned(_alone(some.join(sizes, ["name", "band"]))), pool, words, percent)
        if more.isEmpty():
            break
        found = stored(found.unionAll(more))
    return found.unionAll(_compare(pruned(_apart(joined(), block)), pool, words, percent))


def _grouped(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, tuning: dict[str, int]) -> DataFrame:
    """id, key (of id and text), size, and of the component the ``least`` id and the row ``kept`` (a key), of every row."""
    described = stored(describe(docs, id_col, text_col, words))
    found = components(stored(links(docs, described, id_col, text_col, words, percent, **tuning)))
    order = F.struct(F.col("id").isNull(), "id", "key")
    filled = described.where("size > 0")
    classes = filled.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.min(order).alias("kept"))
    classes = stored(classes.join(found.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls")))
    whole = stored(classes.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("least"), F.min("kept").alias("kept")).select("component", "n", "least", F.col("kept.key").alias("kept")))
    of = stored(looked_up(classes.select("cls", "component", F.col("n").alias("rows")), whole, "component", ["cls"]).select("cls", F.col("rows").alias("n"), "least", "kept"))
    rows = looked_up(filled.select("id", "key", "cls", "size"), of, "cls", ["key"]).select("id", "key", "size", "least", "kept")
    return rows.unionAll(described.where("size = 0").select("id", "key", "size", F.col("id").alias("least"), F.col("key").alias("kept")))


def linked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, **tuning: int) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    rows = _grouped(docs, id_col, text_col, words, percent, tuning)
    return rows.select(F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.col("least").alias("component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, **tuning: int) -> DataFrame:
    """One row of ``docs`` for each group of linked documents, that of the least id (nulls last), and all without words.

    Rows equal in id and text are one document.
    """
    kept = stored(_grouped(docs, id_col, text_col, words, percent, tuning).where("key = kept").select("key").distinct())
    (key,) = unused(docs, "__key")
    return docs.withColumn(key, F.xxhash64(id_col, text_col)).join(kept.withColumnRenamed("key", key), key, "left_semi").dropDuplicates([key]).drop(key)
