import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataframe.llm import language_id, neighbours, quality, queries, sharding


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 16)).astype(np.float32)
    x[50:60] = x[100]  # ties
    x[5] = x[6] * 1000
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [None] + [1.0] * 15), (1003, [float("nan")] * 16), (1004, [float("inf")] + [1.0] * 15), (None, [1.0] * 16), (1200, [1.0, 2.0]), (1300, [2.0, 1.0]), rows[100], rows[51]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    is_query = F.col("vec_id") % 100 == 0
    found = neighbours.nearest(frame.repartition(5), is_query, memory=9_000).collect()  # four blocks
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    wide = x.astype(np.float64)
    for q in range(0, 700, 100):
        d = np.sqrt(((wide - wide[q]) ** 2).sum(axis=1))
        order = sorted((float(v), i) for i, v in enumerate(d) if i != q)[:10]
        assert [i for i, _ in got[q]] == [i for _, i in order]
        assert np.allclose([s for _, s in got[q]], [v for v, _ in order], rtol=1e-12)
    assert got[1200] == [(1300, np.sqrt(2))] and sorted(got) == [0, 100, 200, 300, 400, 500, 600, 1200, 1300]
    for few in (1, 7, 10_000):  # bounds from all rows, from some, and none
        assert sorted(neighbours.nearest(frame.repartition(3), is_query, few=few).collect()) == sorted(found)
    assert neighbours.nearest(frame.limit(0), is_query).count() == 0


def test_neighbours_of_a_vector_that_many_share(spark):
    """Most rows, and most queries, are one vector; some ids come twice."""
    x = np.ones((3000, 8))
    x[::3] = np.random.default_rng(8).normal(size=(1000, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(i, [1.0] * 8) for i in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 100 == 0, k=4).where("score = 0").orderBy("rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q in range(100, 3000, 100):
        same = [i for i in range(6) if i != q] if q % 3 else []
        assert got.get(q, []) == same[:4]


def test_what_tasks_return_is_bounded_by_few_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 8))
    ids = np.arange(4000)
    batches = [pa.record_batch({"id": pa.array(ids[at : at + 100]), "vector": pa.array(x[at : at + 100].tolist())}) for at in range(0, 4000, 100)]
    q = x[:50]
    d = np.sqrt(((q[:, None] - x) ** 2).sum(2))
    d[np.arange(50), np.arange(50)] = np.inf
    within = np.sort(d[:, :: 8], axis=1)[:, 9]
    for bound, most in ((np.full(50, np.inf), 50 * 40 * 10), (within * (1 + 1e-12), 50 * 8 * 10 * 2)):
        rows = [b for batch in batches for b in neighbours._search([(ids[:50], q, bound)], 10)(iter([batch]))]
        assert sum(b.num_rows for b in rows) <= most
        found = sorted((a, s, v) for b in rows for a, v, s in zip(*(c.to_pylist() for c in b.columns)))
        for a in range(50):
            assert [v for o, _, v in found if o == a][:10] == np.argsort(d[a], kind="stable")[:10].tolist()


@pytest.mark.parametrize("size", [1e-3, 1.0, 1e3, 1e5, 1e7, 1e12])
def test_bounds_hold(size):
    """Of vectors far from the origin and near each other, whose squares cancel."""
    rng = np.random.default_rng(int(np.log10(size)) + 9)
    for spread in (1.0, 1e-3, 1e-7, 0.0):
        x = size * (1 + spread * rng.normal(size=(150, 24)))
        code, step, error = neighbours.encode(x)
        square = (code.astype(float) ** 2).sum(1) * step**2
        low, high = neighbours.bounds(square[:, None], square, np.outer(step, step) * (code.astype(float) @ code.T.astype(float)), error[:, None] + error)
        exact = np.array([neighbours.distances(np.broadcast_to(v, x.shape), x) for v in x])
        assert (low <= exact).all() and (exact <= high).all()


def test_neighbours_far_from_the_origin(spark):
    rng = np.random.default_rng(5)
    x = 1e6 + rng.normal(size=(400, 8))
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    for r in neighbours.nearest(frame, F.col("vec_id") % 100 == 0, k=3).where("rank = 1").collect():
        d = np.sqrt(((x - x[r.query_id]) ** 2).sum(axis=1))
        d[r.query_id] = np.inf
        assert r.vec_id == int(d.argmin())


def test_shards(spark, prose):
    docs = spark.createDataFrame(prose, "doc_id long, text string").withColumn("shard", F.lit("clash"))
    rows = sharding.assign_shards(docs.repartition(3), 5).orderBy("shard", "slot").collect()
    assert len(rows) == len(prose)
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    sizes = [sum(r["size"] for r in rows if r.shard == k) for k in range(5)]
    assert max(sizes) - min(sizes) <= 2 * max(r["size"] for r in rows)
    for k in range(5):
        assert [r.slot for r in rows if r.shard == k] == list(range(sum(r.shard == k for r in rows)))
    text = {i: t for i, t in prose if i is not None and i not in (7,)}
    for r in rows:
        if r.doc_id in text:
            t = text[r.doc_id]
            assert (r["size"], r.text_crc32) == ((8, None) if t is None else (len(t.encode()) + 8, zlib.crc32(t.encode())))
    assert sharding.assign_shards(docs.limit(0), 5).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * (i % 7)) for i in range(50)], "doc_id long, text string")
    sharding.write_shards(docs, f"{tmp_path}/s", 4)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.count() == 50 and back.select("__shard").distinct().count() == 4


DATA = "/root/testdata/sf0.01"


def test_languages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    found = queries.op1_language_id(spark, DATA).join(docs, "doc_id").where("held_out").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.97 and found.score.between(0, 1).all()


def test_language_cases(spark):
    train = spark.createDataFrame([("the cat and the dog", "en"), ("der hund und die katze", "de"), ("no label", None), (None, "en")], "text string, lang string")
    prototypes = language_id.train(train)
    docs = spark.createDataFrame([(1, "the dog", "x"), (2, None, "x"), (3, "", "x"), (4, "12 34!", "x"), (5, "und die", "x"), (5, "und die", "x"), (6, "日本" * 5000 + "𝒜𝒷", "x"), (None, "and the", "x")], "doc_id long, text string, score string")
    found = [(r.doc_id, r.lang_pred) for r in language_id.predict(docs, prototypes).collect()]
    assert found[:5] == [(1, "en"), (2, "und"), (3, "und"), (4, "und"), (5, "de")] and found[-1] == (None, "en")
    none = language_id.predict(docs, language_id.train(train.limit(0))).collect()
    assert {r.lang_pred for r in none} == {"und"} and {r.score for r in none} == {0.0}
    assert language_id.predict(docs.limit(0), prototypes).count() == 0


def test_quality(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    found = queries.op3_quality(spark, DATA).join(labels, "doc_id").where("held_out").toPandas()
    assert (found.predicted == found.quality).mean() > 0.9
    assert queries.op3_quality(spark, DATA).count() == 1000


def test_quality_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "### $$$ %%%"), (3, "### $$$ %%%"), (None, "some words of text"), (4, "w " * 200_000)], "doc_id long, text string")
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    rows = [(f"plain words number {i} in a row", 1) for i in range(40)] + [(f"### {i} $$$ !!! %%%", 0) for i in range(40)] + [("no label", None)]
    weights = quality.train(spark.createDataFrame(rows, "text string, quality int"))
    score = [r.score for r in quality.score(docs, weights).collect()]
    assert score[2] == score[3] < 0.3 < score[4] and score[0] == score[1]
    assert quality.train(spark.createDataFrame([], "text string, quality int")) is None
    assert quality.score(docs.limit(0), weights).count() == 0


def test_languages_equal_plain_bundles(spark):
    """Trigram by trigram, letter by letter; languages apart only by letters beyond a-z; equal cosines; blocks and a small cache."""
    train = [("кіт і пес їдять", "uk"), ("кот и пёс едят", "ru"), ("the cat eats", "en"), ("漢字文章世界", "zh"), ("ひらがな文章", "ja"), ("twin words", "t1"), ("twin words", "t2")]
    docs = [(k, t) for k, t in enumerate(["пес їдять", "пёс едят", "The CAT", "漢字文章", "ひらがな", "twin words", "ab", "a", "1 2", "𐐀𐐁𐐂 cat"])]
    dim, p = 256, language_id.Profiles(256)

    def plain(text):
        letters = [ord(c.lower()[0]) if c.isalpha() else 0 for c in f"\n{text}\n"]
        letters = [x for i, x in enumerate(letters) if x or not i or letters[i - 1]]
        vector = lambda x: p.letters(np.array([x]))[0].astype(int)
        return sum((np.roll(vector(a), 2) * np.roll(vector(b), 1) * vector(c) for a, b, c in zip(letters, letters[1:], letters[2:]) if b), np.zeros(dim, int))

    wanted = {}
    for text, lang in train:
        wanted[lang] = wanted.get(lang, 0) + plain(text)
    found = language_id.train(spark.createDataFrame(train, "text string, lang string").repartition(3), dim=dim)
    assert sorted(found) == sorted(wanted) and all((found[k] == wanted[k]).all() for k in wanted)
    out = {r.doc_id: r for r in language_id.predict(spark.createDataFrame(docs, "doc_id long, text string"), found, dim=dim).collect()}
    for i, text in docs:
        v = plain(text)
        if not v.any():
            assert (out[i].lang_pred, out[i].score) == ("und", 0.0)
            continue
        cosines = {k: float(v @ wanted[k] / np.linalg.norm(v) / np.linalg.norm(wanted[k])) for k in sorted(wanted)}
        best = max(cosines.values())
        assert out[i].lang_pred in [k for k, c in cosines.items() if best - c < 1e-9] and abs(out[i].score - max(0, best)) < 1e-9
    assert [out[i].lang_pred for i in range(6)] == ["uk", "ru", "en", "zh", "ja", "t1"]
    texts = [t for _, t in docs] * 3
    whole = p.bundles(texts)[0]
    for name, value in (("BLOCK", 5), ("CACHE", 12), ("_DENSE", 7)):
        old = getattr(language_id, name)
        setattr(language_id, name, value)
        assert (language_id.Profiles(256).bundles(texts)[0] == whole).all()
        setattr(language_id, name, old)


def test_quality_equals_plain_ftrl(spark):
    """Updates one by one over dicts of weights; several parts averaged; rows of one key count once; the row and byte caps; clashing columns."""
    rng = np.random.default_rng(8)
    rows = [(int(k), " ".join(rng.choice(["good", "text", "of", "words", "###", "$$", "SPAM!!"], 12)), int(rng.integers(2))) for k in range(60)]
    rows += [(3, "zz another text of the same key", 0), (3, "aa the least text of the key", 1), rows[5]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, quality int").repartition(4)
    keyed = {r.doc_id: r.k for r in frame.select("doc_id", F.xxhash64("doc_id").alias("k")).collect()}

    def plain(examples):
        z, n, passes = {}, {}, min(20, max(2, quality.UPDATES // len(examples)))
        weight = lambda i: 0.0 if abs(z.get(i, 0)) <= 1e-4 else -(z[i] - np.sign(z[i]) * 1e-4) / ((1 + n[i] ** 0.5) / 0.1 + 1e-4)
        for _ in range(passes):
            for text, label in examples:
                grams = quality.features(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[0].tolist()
                x = {g: grams.count(g) * quality.SCALE / len(grams) for g in set(grams)} | {1 << quality.BITS: 1.0}
                w = {i: weight(i) for i in x}
                p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x.items())))
                for i, v in x.items():
                    g = (p - label) * v
                    sigma = ((n.get(i, 0) + g * g) ** 0.5 - n.get(i, 0) ** 0.5) / 0.1
                    z[i], n[i] = z.get(i, 0) + g - sigma * w[i], n.get(i, 0) + g * g
        return {i: weight(i) for i in z}

    once = {}
    for i, t, y in rows:
        once[i] = min(once.get(i, (t, y)), (t, y))
    order = sorted(once, key=keyed.get)
    for cap in (len(order), 20):
        wanted = plain([once[i] for i in order[:cap]])
        found = quality.train(frame, key=F.col("doc_id"), max_rows=cap)
        assert set(np.flatnonzero(found)) == {i for i, v in wanted.items() if v} and all(abs(found[i] - v) < 1e-5 for i, v in wanted.items())
    few = quality.train(frame, key=F.col("doc_id"), max_bytes=1)
    alone = plain([once[order[0]]])
    assert all(abs(few[i] - v) < 1e-5 for i, v in alone.items())
    many = spark.createDataFrame([(k, f"good text {k}" if k % 2 else f"### {k} $$", k % 2) for k in range(4000)], "doc_id long, text string, quality int")
    model = quality.train(many, key=F.col("doc_id"))
    docs = spark.createDataFrame([(1, "good text 17", 0.0, "x"), (2, "### 16 $$", 0.0, "y")], "doc_id long, text string, score double, __text string").withColumn("__SCORE", F.lit(1))
    assert [r.doc_id for r in quality.keep_good(docs, model, 0.5).collect()] == [1] and quality.keep_good(docs, model, 0.5).columns == docs.columns


def test_only_fitted_texts_are_sent(spark):
    """Documents meet their labels by id: what is shuffled doesn't grow with texts that are not fitted."""
    rng = np.random.default_rng(4)
    docs = spark.createDataFrame([(i, rng.bytes(3000).hex()) for i in range(1500)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 1500, 75)] + [(3, None), (9999, 1)], "doc_id long, quality int")
    wanted = quality.train(docs.join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0), key=F.col("doc_id"))
    sc = spark.sparkContext._jsc.sc()

    def shuffled():
        sc.listenerBus().waitUntilEmpty()
        return sum(sc.statusStore().executorList(False).apply(k).totalShuffleWrite() for k in range(sc.statusStore().executorList(False).size()))

    before, threshold = shuffled(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = queries.quality_weights(docs, labels)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert shuffled() - before < 1 << 20
    assert np.array_equal(got, wanted)
