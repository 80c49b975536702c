"""Fill-in-middle, target resampling and SimHash join against plain versions."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strataframe.llm import fill_in_middle, simhash_join, target_resampling
from tests.llm import brute

DATA = "/root/testdata/sf0.001"
ODD = [
    "", "a", "é", "€", "😀", "aé€😀", "😀€éa", "é€é€", "€😀€😀", "a<P>b", "<M>", "<", "<S", "P>", "<<P", "<P", ">", "x<S>y<M>", "ééééé", "日本語のテキスト", "a日b本c語",
    "nul \x00 and \x01 in it", "tab\tand\nlines\r\n", "　wide　space　", "née", "\U0010ffffࠀ߿\u0080\x7f", "word " * 30,
]


def frame(spark, rows, more=None):
    table = spark.createDataFrame([(i, t) for i, t in rows], "doc_id long, text string")
    names = ["n", "form", "output", "h1", "id", "fp", "weight", "score", "rank", "row", "key", "place", "part", "n_words", "component_id", "__key"] if more is None else more
    return table.withColumns({c: F.lit("own") for c in names})


def plain_form(doc_id, text):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:low], text[low:high], text[high:]
    return (n, "spm", low, high - low, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", low, high - low, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle(spark, prose):
    rng = np.random.default_rng(3)
    made = ["".join(rng.choice(list("ab <PSM>é€😀\n"), rng.integers(1, 60))) for _ in range(400)]
    rows = prose + list(enumerate(ODD + made + ["é a" * 200_000, "x" * 3_000_000 + "😀" * 10], 1000)) + [(None, None), (None, "x"), (5, "again"), (5, "again")]
    found = fill_in_middle.transform(frame(spark, rows)).withColumn("back", fill_in_middle.restored(F.col("form"), F.col("output"))).collect()
    wanted = sorted(((i, *plain_form(i, t), t or "") for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in found), key=repr) == wanted
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert fill_in_middle.transform(frame(spark, rows).limit(0)).collect() == []


def test_fill_in_middle_parameters(spark):
    rows = [(k, f"text é {k}") for k in range(200)]
    marks = ("[pre]", "(suf)", "{mid}")
    table = fill_in_middle.transform(frame(spark, rows), percent=100, suffix_first=100, seed=9, sentinels=marks)
    found = table.withColumn("back", fill_in_middle.restored(F.col("form"), F.col("output"), marks)).collect()
    assert all(r.form == "spm" and r.output.startswith("(suf)") and r.back == f"text é {r.doc_id}" for r in found)
    for bad in (("<P>", "<P>x", "<M>"), ("<P>", "<P>", "<M>"), ("a<", "<S>", "<M>"), ("é", "<S>", "<M>"), ("P", "<S>", "<M>")):
        with pytest.raises(ValueError):
            fill_in_middle.check_sentinels(bad)


def plain_resample(docs, target):
    def features(text):
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        return len(ws), [zlib.crc32(f.encode()) % 10000 for f in ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]]

    own = [features(t) for _, t in docs]
    s, t = (np.bincount([b for _, f in some for b in f], minlength=10000) for some in (own, [features(x) for x in target]))
    gain = [math.floor(1000 * math.log((int(b) + 1.0) * (int(s.sum()) + 10000.0) / ((int(a) + 1.0) * (int(t.sum()) + 10000.0)))) for a, b in zip(s, t)]
    rows = []
    for (i, _), (n, f) in zip(docs, own):
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        rows.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    rank = [*range(1, len(fit) * 25 // 100 + 1)] + [None] * (len(fit) - len(fit) * 25 // 100)
    return [(*r, k) for r, k in zip(fit, rank)] + [(*r, None) for r in rows if r[1] < 20]


def test_target_resampling(spark, prose):
    long = "w" * 70 + " " + "é" * 50 + " short " + "Ab1-cd_ef"
    docs = prose + list(enumerate([*ODD, long, long * 3, "ABC " * 25, "many words " * 60_000], 2000)) + [(None, "tie " * 30)] * 3 + [(3, "tie " * 30)] * 3
    target = [prose[k][1] for k in (3, 9, 27)] + [None, "", "Some TARGET text é1 " * 20]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = target_resampling.resample(frame(spark, docs).repartition(7), goal).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(plain_resample(docs, target), key=key)
    ranks = sorted(r.rank for r in found if r.rank)
    assert ranks == list(range(1, len(ranks) + 1)) and ranks


def test_target_resampling_of_nothing(spark, prose):
    empty, goal = frame(spark, prose).limit(0), spark.createDataFrame([], "text string")
    assert target_resampling.resample(empty, goal).collect() == []
    found = target_resampling.resample(frame(spark, prose), goal, percent=100, least_words=0).collect()
    assert sorted(map(tuple, ((r.rank,) for r in found))) == [(k,) for k in range(1, len(prose) + 1)]
    assert (target_resampling.counts(empty) == 0).all()


def test_three_words_a_feature(spark):
    found = target_resampling.counts(spark.createDataFrame([("a b c d",), ("x",)], "text string"), most=3, buckets=100)
    wanted = [zlib.crc32(f.encode()) % 100 for f in ("a", "b", "c", "d", "x", "a b", "b c", "c d", "a b c", "b c d")]
    assert found.tolist() == np.bincount(wanted, minlength=100).tolist()


def plain_fingerprint(text, words=3):
    ws = brute.WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    hashes = [xxhash.xxh64_intdigest(" ".join(ws[i : i + words]).encode(), 42) for i in range(max(1, len(ws) - words + 1))] if ws else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(docs, distance=2):
    marks = sorted({plain_fingerprint(t) for _, t in docs})
    label = {m: m for m in marks}
    pairs = [(a, b) for k, a in enumerate(marks) for b in marks[:k] if (a ^ b).bit_count() <= distance]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    out = []
    for i, t in docs:
        own = plain_fingerprint(t)
        ids = [j for j, u in docs if j is not None and label[plain_fingerprint(u)] == label[own]]
        out.append((i, f"{own:016x}", min(ids) if ids else None))
    return out


@pytest.mark.parametrize("crowd", [64, 1])
def test_simhash(spark, prose, crowd):
    docs = prose + list(enumerate([*ODD, "one two three four", "One  Two\tTHREE four", "ten words " * 5, "ten words " * 5 + "more"], 3000))
    found = simhash_join.linked(frame(spark, docs), crowd=crowd).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(plain_components(docs), key=key)
    assert len({r.component_id for r in found}) < len({r.fingerprint for r in found})


def test_simhash_of_a_very_long_text(spark):
    text = "some words of a long text " * 40_000
    found = {r.doc_id: r for r in simhash_join.linked(frame(spark, [(4, text), (2, text), (9, None)])).collect()}
    assert found[4].fingerprint == f"{plain_fingerprint(text):016x}" and found[4].component_id == 2 and found[9].fingerprint == "0" * 16
    assert simhash_join.linked(frame(spark, [(4, text)]).limit(0)).collect() == []


@pytest.mark.parametrize("distance, blocks, crowd", [(2, 4, 64), (2, 4, 3), (2, 3, 1), (2, 5, 2), (1, 2, 64), (1, 3, 1)])
def test_links_reach_what_all_pairs_reach(spark, distance, blocks, crowd):
    rng = np.random.default_rng(8)
    centres = rng.integers(0, 1 << 63, 12, dtype=np.uint64)
    marks = set()
    for c in map(int, centres):
        for _ in range(25):
            m = c
            for b in rng.choice(64, int(rng.integers(0, 5)), replace=False):
                m ^= 1 << int(b)
            marks.add(m)
    marks = sorted(marks)
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    found = simhash_join.links(spark.createDataFrame([(signed(m),) for m in marks], "fp long"), distance, blocks, crowd).collect()
    near = {(a, b) for a in marks for b in marks if a != b and (a ^ b).bit_count() <= distance}
    assert {(r.a % (1 << 64), r.b % (1 << 64)) for r in found} <= near

    def parts(pairs):
        label = {m: m for m in marks}
        for _ in marks:
            before = dict(label)
            for a, b in pairs:
                label[a] = label[b] = min(label[a], label[b])
            if label == before:
                return label

    assert parts(near) == parts({(r.a % (1 << 64), r.b % (1 << 64)) for r in found})


def test_blocks_must_outnumber_the_distance(spark):
    for distance, blocks in ((0, 4), (3, 5), (2, 2), (2, 17)):
        with pytest.raises(ValueError):
            simhash_join.links(spark.createDataFrame([(1,)], "fp long"), distance, blocks)
