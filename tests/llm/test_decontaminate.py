import re
import time

import numpy as np
from pyspark.sql import functions as F

from strataframe.llm import decontaminate
from tests.llm import brute


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        k = int(rng.integers(len(chars)))
        kind = rng.integers(3)
        if kind == 0:
            chars[k] = "q"
        elif kind == 1:
            chars.insert(k, "z")
        else:
            del chars[k]
    return "".join(chars)


def test_equals_alignment_of_all_pieces(prose):
    rng = np.random.default_rng(4)
    texts = [t for _, t in prose if t and len(t) < 1500][:30]
    items = [(k, t[:200]) for k, t in enumerate(texts) if len(t) > 60][:12] + [(91, "exactly twelve or so")]
    docs = [texts[0]] + [t + " " + edited(rng, items[k % len(items)][1], k % 14) + " " + t[:50] for k, t in enumerate(texts)] + ["X" + items[0][1].upper().replace(" ", "\n \t")]
    index = decontaminate.Index(items)
    data = [d.encode() for d in docs]
    buf, offsets = np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data])))
    row, piece, start, end, edits = index.search(buf, offsets)
    found = {(int(r), int(p)): int(e) for r, p, e in sorted(zip(row, piece, -edits, strict=True))}
    for r, text in enumerate(docs):
        whole = brute.folded(text).encode()
        for p in range(len(index.at)):
            chars = index.chars[p, : index.length[p]].tobytes()
            best = brute.distance_in(chars, whole)
            assert ((r, p) in found) == (best <= index.edits[p]), (r, p, best, index.edits[p])
            if (r, p) in found:
                assert -found[r, p] >= best
    for r, p, s, e in zip(row, piece, start, end, strict=True):
        part = brute.folded(data[r][s:e].decode(errors="ignore")).encode()
        assert brute.distance_in(index.chars[p, : index.length[p]].tobytes(), part) <= index.edits[p] + 1


def test_matches_and_clean(spark):
    item = "An item of the benchmark that is long enough to be found in texts, with several words more."
    items = spark.createDataFrame([(5, item), (6, None), (7, "")], "item_id long, text string")
    rows = [(1, "before " + item + " after"), (2, "nothing of the kind"), (3, None), (4, ""), (None, item), (1, "before " + item + " after"), (8, "x" * 300_000 + item)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("own")).withColumn("start", F.lit(0))
    found = decontaminate.matches(docs, items).collect()
    assert sorted([(r.doc_id, r.item_id, r.start) for r in found], key=str) == sorted([(1, 5, 7), (1, 5, 7), (None, 5, 0), (8, 5, 300_000)], key=str)
    kept = decontaminate.clean(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4] and kept.columns == docs.columns
    assert decontaminate.clean(docs, items.limit(0)).count() == len(rows) and decontaminate.matches(docs.limit(0), items).count() == 0
    blocks = decontaminate.matches(docs, items.unionAll(items), block=60)
    assert blocks.count() == 8


def test_excerpts_are_found_wherever_they_begin(prose):
    """Excerpts of a piece's length, as they stand, and of a whole piece and a stride, with edits, from any place of an item."""
    rng = np.random.default_rng(6)
    item = "".join(chr(c) for c in rng.integers(97, 123, 233))
    other = "".join(chr(c) for c in rng.integers(97, 123, 500))
    index = decontaminate.Index([(1, "short item, one piece"), (2, item)])
    long = decontaminate.PIECE + decontaminate.STRIDE - 1
    docs = [(2, other[:99] + item[i : i + 80] + other[99:]) for i in range(233 - 80 + 1)] + [(2, item[10:110])]
    docs += [(2, other[:99] + edited(rng, item[i : i + long], 5) + other[99:]) for i in range(233 - long + 1)]
    docs += [(None, other[:99] + item[i : i + 50] + other[99:]) for i in range(0, 180, 7)]
    data = [d.encode() for _, d in docs]
    row, piece, start, *_ = index.search(np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data]))))
    assert set(row.tolist()) == {k for k, (wanted, _) in enumerate(docs) if wanted} and set(index.item[index.item_at[piece]].tolist()) == {2}


def test_an_excerpt_between_pieces_is_one_region(spark):
    item = " ".join(f"word{k * k}" for k in range(40))[:233]
    docs = spark.createDataFrame([(1, "before " + item[10:110] + " after"), (2, "before " + item[10:60] + " after")], "doc_id long, text string")
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate.matches(docs, items).collect()] == [(1, 5)]
    assert [r.doc_id for r in decontaminate.clean(docs, items).collect()] == [2]


def test_items_with_null_ids_are_looked_for(spark):
    texts = [" ".join(f"{name}{k * k}" for k in range(30)) for name in ("one", "two", "three")]
    items = spark.createDataFrame([(None, texts[0]), (None, texts[1]), (5, texts[2]), (5, texts[0]), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(k, f"before {t} after") for k, t in enumerate([*texts, "nothing of the kind"])], "doc_id long, text string")
    for block in (250, decontaminate.BLOCK):
        found = [(r.doc_id, r.item_id) for r in decontaminate.matches(docs, items, block=block).collect()]
        assert sorted(found, key=str) == sorted([(0, None), (0, 5), (1, None), (2, 5)], key=str)
        assert [r.doc_id for r in decontaminate.clean(docs, items, block=block).collect()] == [3]


def test_items_that_share_a_phrase_lead_nowhere_by_it():
    """2,000 items with a phrase and a text that repeats it: seconds, no match; the items themselves, and near copies, are found."""
    rng = np.random.default_rng(7)
    phrase = "which of the following statements is the case: "
    items = [(k, phrase + "".join(rng.choice(list("abcdefghij "), 120))) for k in range(2000)]
    docs = [phrase * 200, items[7][1] + " " + phrase, "x " + edited(rng, items[1500][1], 3)]
    data = [d.encode() for d in docs]
    began = time.time()
    index = decontaminate.Index(items)
    row, item, *_ = decontaminate.regions(index, np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data]))))
    assert time.time() - began < 20
    assert {(int(r), int(i)) for r, i in zip(row, item, strict=True)} == {(1, 7), (2, 1500)}


def test_pieces_of_common_q_grams_only(monkeypatch):
    """Every piece has telling q-grams, so exact copies of items that differ by a letter are found too; equal items are one piece."""
    monkeypatch.setattr(decontaminate, "COMMON", 3)
    items = [(k, f"a template that all of the items share, with number {k} in the middle, and the same end for all of them") for k in range(30)] + [(99, "a template that all of the items share, with number 7 in the middle, and the same end for all of them")]
    docs = [f"before {t} after" for _, t in items]
    data = [d.encode() for d in docs]
    index = decontaminate.Index(items)
    row, item, *_ = decontaminate.regions(index, np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data]))))
    found = {(int(r), int(i)) for r, i in zip(row, item, strict=True)}
    assert {(k, i) for k, (i, _) in enumerate(items)} <= found and {(7, 99), (30, 7)} <= found


def test_query_equals_brute_force(spark):
    """Regions of whole items against alignments of every piece at every place; short items as whole words; repeats that don't touch are two."""
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(90)]
    long = [" ".join(rng.choice(words, 16)) for _ in range(3)]
    items = [(1, long[0]), (2, long[1]), (3, "Paris"), (4, "42"), (5, " a b "), (6, long[2][:30]), (7, "¿qué?")]
    gap = " ".join(rng.choice(words, 40))
    docs = [(1, f"{long[0]} {gap} {long[0]}"), (2, "in paris, 42 a  b"), (3, "parisian 420 xa b, qué"), (4, edited(rng, long[1], 3)), (5, f"{gap} {long[2][:30]} ¿QUÉ? {gap}"), (6, gap)]
    found = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    wanted = []
    for i, text in docs:
        whole = brute.folded(text).encode()
        for k, item in items:
            piece = brute.folded(item).strip().encode()
            if len(piece) < decontaminate.Q:
                wanted += [(i, k)] * len(re.findall(rf"(?<!\w){re.escape(piece.decode())}(?!\w)", whole.decode()))
            else:
                cuts = [piece[a : a + 80] for a in {*range(0, max(1, len(piece) - 80), 8), max(0, len(piece) - 80)}]
                wanted += [(i, k)] * (whole.count(piece) or any(brute.distance_in(c, whole) <= decontaminate.budget(len(c)) for c in cuts))
    assert sorted((r.doc_id, r.item_id) for r in found) == sorted(wanted) and (1, 1) in wanted[1:]
    first, second = sorted(r.start for r in found if r.doc_id == 1)
    assert first == 0 and second >= len(long[0]) + len(gap)


def test_clean_keeps_all_columns(spark):
    item = "An item of the benchmark that is long enough to be found in texts, with several words more."
    docs = spark.createDataFrame([(1, item), (2, "other"), (None, None)], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("item", "row", "block", "item_id", "start", "__text")})
    for block in (60, decontaminate.BLOCK):
        kept = decontaminate.clean(docs, spark.createDataFrame([(5, item), (6, "x" * 30)], "item_id long, text string"), block=block)
        assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect()), key=str) == [2, None]


def test_what_is_found_depends_on_no_other_item(spark):
    """A near copy of one item among many that share 60 characters, in one block and in many."""
    rng = np.random.default_rng(12)
    start = "which one of the following answers is the right one to give "[:60]
    items = [(k, start + "".join(rng.choice(list("abcdefghij "), 60))) for k in range(3000)]
    piece = items[0][1][:80]
    changed = piece[:66] + "Q" + piece[67:73] + piece[74:]
    text = f"some words before {changed} and after"
    data = np.frombuffer(text.encode(), np.uint8)
    alone = None
    for n in (1, 200, 256, 257, 300, 3000):
        index = decontaminate.Index(items[:n])
        _, item, start_at, end, edits = decontaminate.regions(index, data, np.array([0, len(data)]))
        assert item.tolist() == [0] and (n == 1 or (start_at.tolist(), end.tolist(), edits.tolist()) == alone), n
        alone = alone if n > 1 else (start_at.tolist(), end.tolist(), edits.tolist())
    docs, table = spark.createDataFrame([(1, text), (2, start + "only")], "doc_id long, text string"), spark.createDataFrame(items[:300], "item_id long, text string")
    for block in (12_000, decontaminate.BLOCK):
        assert [(r.doc_id, r.item_id, [r.start], [r.end], [r.edits]) for r in decontaminate.matches(docs, table, block=block).collect()] == [(1, 0, *alone)]
        assert [r.doc_id for r in decontaminate.clean(docs, table, block=block).collect()] == [2]


def test_common_pieces_against_alignment_of_all(monkeypatch):
    """Pieces that share their start, middle or end, in texts with edits anywhere, begun at either end."""
    rng = np.random.default_rng(13)
    letters = list("abcdefgh ")
    part = lambda n: "".join(rng.choice(letters, n))
    shared = part(55)
    items = [(k, shared + part(25)) for k in range(30)] + [(100 + k, part(25) + shared) for k in range(30)] + [(200 + k, part(14) + shared + part(11)) for k in range(30)] + [(300, part(30))]
    docs = [part(20) + edited(rng, items[k][1], int(rng.integers(0, 8))) + part(20) for k in range(0, 90, 3)] + [shared + shared, part(300), items[-1][1], "", items[4][1][40:], items[40][1][:60]]
    data = [d.encode() for d in docs]
    buf, offsets = np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data])))
    for common in (1 << 30, 0):
        monkeypatch.setattr(decontaminate, "COMMON", common)
        index = decontaminate.Index(items)
        assert index.backward.any() == (common == 0)
        row, piece, *_ = index.search(buf, offsets)
        found = set(zip(row.tolist(), piece.tolist(), strict=True))
        for r, text in enumerate(docs):
            whole = brute.folded(text).encode()
            for p in range(len(index.at)):
                assert ((r, p) in found) == (brute.distance_in(index.chars[p, : index.length[p]].tobytes(), whole) <= index.edits[p]), (r, p)


def test_short_items_report_but_do_not_delete(spark):
    docs = spark.createDataFrame([(1, "the answer is 42 as ever"), (2, "nothing of the kind"), (3, "a whole sentence of some words stands here")], "doc_id long, text string")
    items = spark.createDataFrame([(1, " 42 \n"), (2, "whole sentence of some words"), (3, None), (4, "")], "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in decontaminate.matches(docs, items).collect()) == [(1, 1), (3, 2)]
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [2]
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items, least_bytes=12).collect()) == [1, 2]
    assert decontaminate.clean(docs, items, least_bytes=100).count() == 3
