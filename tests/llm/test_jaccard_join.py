import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.llm import jaccard_join
from strataframe.llm.components import components
from tests.llm import brute


def found(spark, docs, **tuning):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.linked(frame.repartition(4), **tuning).collect()], key=str)


@pytest.mark.parametrize("tuning", [{}, {"hot": 50, "hot_least": 2}, {"block": 3}])
def test_equals_brute_force(spark, prose, tuning):
    wanted = sorted([(i, *x) for (i, _), x in zip(prose, brute.components(prose), strict=True)], key=str)
    assert found(spark, prose, **tuning) == wanted


def test_the_bound_is_exact(spark):
    base = [f"w{i}" for i in range(18)]  # 14 shingles; changing the last word changes one, so 13 of 15 are shared
    docs = [(1, " ".join(base)), (2, " ".join([*base[:-1], "x"])), (3, " ".join([*base[:-2], "y", "z"])), (4, " ".join([*base[:-3], "p", "q", "r"]))]
    assert found(spark, docs) == sorted([(i, *x) for (i, _), x in zip(docs, brute.components(docs), strict=True)], key=str)


def test_large_group_of_near_copies(spark, monkeypatch):
    """Near copies in many blocks, beside sets that share their shingles but don't link: what meets grows with their number, not its square."""
    met, compare = [], jaccard_join._compare
    monkeypatch.setattr(jaccard_join, "_compare", lambda kept, *rest: met.append(kept.count()) or compare(kept, *rest))
    rng = np.random.default_rng(1)
    base, totals = [f"t{i}" for i in range(120)], []
    for n in (150, 300):
        docs = []
        for i in range(n):
            words = list(base)
            for k in rng.integers(0, 120, 2):
                words[k] = f"n{i}"
            docs.append((i, " ".join(words)))
        docs += [(2000 + i, " ".join([*base[:30], *(f"o{i}-{k}" for k in range(90))])) for i in range(5)]
        assert found(spark, docs, block=16) == sorted([(i, *x) for (i, _), x in zip(docs, brute.components(docs), strict=True)], key=str)
        assert len(met) > 1
        totals.append(sum(met))
        met.clear()
    assert totals[1] < 2.6 * totals[0], totals


def test_tree_finds_all_pairs_that_may_link():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(12):
        core = rng.integers(0, 1 << 62, rng.integers(5, 200)).astype(np.uint64)
        sets += [np.unique(np.concatenate([core, rng.integers(0, 1 << 62, int(rng.integers(0, 1 + len(core) // 3))).astype(np.uint64)])) for _ in range(4)]
    links = jaccard_join.join_sets(list(range(len(sets))), sets, [0] * len(sets))
    label = list(range(len(sets)))
    for a, b in links:
        label = [label[a] if x == label[b] else x for x in label]
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                assert label[i] == label[j]


def test_one_of_each_group_stays(spark, prose):
    prose = prose[:-1]  # else two groups have the same least id
    docs = spark.createDataFrame(prose, "doc_id long, text string")
    kept = jaccard_join.representatives(docs).collect()
    wanted = {}
    for (i, t), (size, component) in zip(prose, brute.components(prose), strict=True):
        wanted.setdefault((component,) if size else (i, t), []).append((i, t))
    assert len(kept) == len(wanted)
    for group in wanted.values():
        assert len([r for r in kept if (r.doc_id, r.text) in set(group)]) == 1


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[100 + i] == 100 for i in range(50))


def test_other_columns(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (2, text + " more"), (3, None)], "doc_id long, text string").withColumns({c: F.lit(7) for c in ("key", "id", "cls", "size", "component", "__key", "n", "kept")})
    assert [r.component_id for r in jaccard_join.linked(docs).orderBy("doc_id").collect()] == [1, 1, 3]
    kept = jaccard_join.representatives(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_classes_that_cannot_link_are_not_routed(spark):
    """One shared shingle of sets too unlike in size, or too late in their order, routes nothing; sets that link stay."""
    tail = " ".join(f"s{i}" for i in range(5))
    docs = [(i, " ".join(f"d{i}-{k}" for k in range(30 * 2**i)) + " " + tail) for i in range(6)]
    near = [(10 + i, " ".join([*(f"n{k}" for k in range(60)), f"end{i}"])) for i in range(5)]
    frame = spark.createDataFrame(docs + near, "doc_id long, text string")
    sets = {i: jaccard_join.shingles(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]), 5) for i, t in docs + near}
    cls = {i: int(jaccard_join.classes(*x)[0][0]) for i, x in sets.items()}
    rows = jaccard_join.route(frame, {}, "text", 5, 75).collect()
    assert {r.cls for r in rows} == {cls[i] for i, _ in near}
    # all of one bucket, and more of one than are compared or held
    size = jaccard_join._coded(np.arange(1, 3000))
    assert (np.diff(size) >= 0).all() and size.max() <= jaccard_join._CODE
    for n in (2, jaccard_join.NEAR, jaccard_join.NEAR + 1):
        key = np.full(n, (5 << jaccard_join._HASH) | 70 << jaccard_join._SIZE | 70 << jaccard_join._MOST)
        assert jaccard_join.fitting(key, np.arange(n))[1].tolist() == list(range(n))


def test_long_buckets_go_on_in_other_batches(spark):
    """A bucket of more rows than are held or come in one batch keeps all its classes under one name."""
    docs = [(i, " ".join([*(f"t{k}" for k in range(60)), f"e{i}"])) for i in range(150)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        rows = jaccard_join.route(spark.createDataFrame(docs, "doc_id long, text string"), {}, "text", 5, 75, held=40).groupBy("name").count().collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert max(r["count"] for r in rows) == 150


def test_links_of_a_place_go_to_the_least_class():
    """Places that hold the same near copies give the same links, so their number follows the classes, not the places."""
    base = np.arange(1000, 1100).astype(np.uint64)
    sets = [np.unique(np.append(base, np.uint64(5000 + i))) for i in range(12)]
    for order in (range(12), reversed(range(12)), [5, 3, 9, 0, 11, 2, 1, 4, 10, 6, 8, 7]):
        order = list(order)
        assert jaccard_join.join_sets(order, [sets[i] for i in order], [0] * 12) == [(0, i) for i in range(1, 12)]
