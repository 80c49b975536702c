"""Kernels on pixels, means, drift, profiles and chunked stores against plain versions."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.operators import geometry, kernels, means, registration, signal, trenches
from strataframe.sources import chunks, store
from tests.test_operators import SCHEMA, image_of, stack

BOXES = "trench_id int, fov string, lane_index int, x_left int, x_right int, y_top int, y_bottom int, orientation int, needs_flip boolean"


def explained(frame):
    return frame.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "formatted")


def plain_warp(image, m):
    h, w = image.shape
    at = lambda y, x: image[y, x] if 0 <= y < h and 0 <= x < w else 0.0
    out = np.zeros((h, w))
    for y in range(h):
        for x in range(w):
            sy, sx = m[3] * x + m[4] * y + m[5], m[0] * x + m[1] * y + m[2]
            y0, x0 = int(np.floor(sy)), int(np.floor(sx))
            fy, fx = sy - y0, sx - x0
            out[y, x] = (at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx) * (1 - fy) + (at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx) * fy
    return out


MATRICES = [
    (1, 0, 0, 0, 1, 0), (1, 0, 2.25, 0, 1, -1.5), (1, 0, -40, 0, 1, 1e9), (1, 0, -6.5, 0, 1, 7.5), (0.9, 0.2, 1.1, -0.3, 1.2, -0.4), (0, 1, 0, -1, 0, 6), (3, 0, -20, 0, 3, -20), (1, 0, -1, 0, 1, 7),
    (1e6, 0, 0, 0, 1e6, 0),
]


def test_rectangles():
    image = np.random.default_rng(1).normal(size=(7, 9))
    for m in MATRICES:
        whole = plain_warp(image, m)
        assert np.allclose(kernels.rectangle(image, m, 0, 0, 7, 9), whole), m
        assert np.allclose(kernels.rectangle(image, m, 2, 3, 4, 5), whole[2:6, 3:8]), m
    assert kernels.rectangle(image, MATRICES[0], 3, 3, 0, 4).shape == (0, 4)
    assert (kernels.rectangle(image, MATRICES[0], -2, -1, 3, 3)[:2] == 0).all()


def test_warp_by_matrices_and_nulls(spark):
    rng = np.random.default_rng(2)
    data = stack(spark, {("a", 0, t): rng.normal(size=(7, 9)) for t in range(len(MATRICES))})
    moves = spark.createDataFrame([("a", t, *map(float, m)) for t, m in enumerate(MATRICES)], "fov string, t int, " + ", ".join(f"{n} double" for n in geometry.NAMES))
    raw = {r.t: image_of(r) for r in data.collect()}
    for r in geometry.warp(data, moves).collect():
        assert np.allclose(image_of(r), plain_warp(raw[r.t], MATRICES[r.t]))
    odd = spark.createDataFrame([("a", 0, 0, "x", 1, 2, [1, None]), ("a", 0, 1, "x", 1, 2, None), ("a", 0, 2, "x", 1, 2, [3, 4]), ("a", 0, 3, "x", 0, 0, [])], SCHEMA.replace("array<double>", "array<int>"))
    still = spark.createDataFrame([("a", t, None if t == 2 else 0.0, 0.0) for t in range(4)], "fov string, t int, tx double, ty double")
    assert [r.pixels for r in geometry.warp(odd, still).orderBy("t").collect()] == [[1, 0], None, None, []]


def test_warp_is_not_computed_for_other_columns(spark, tmp_path):
    data = stack(spark, {("a", 0, 0): np.ones((2, 2))})
    data.write.parquet(f"{tmp_path}/f")
    data = spark.read.parquet(f"{tmp_path}/f")
    still = data.select("fov", "t", F.lit(0.0).alias("tx"), F.lit(0.0).alias("ty"))
    plan = explained(geometry.warp(data, still).where("t = 0").select("fov"))
    assert "ArrowEvalPython" not in plan and "EqualTo(t,0)" in plan and "pixels" not in plan


def test_crops_of_many_boxes(spark):
    rng = np.random.default_rng(3)
    images = {(f, p, t): rng.integers(0, 60000, (30, 40)) for p, f in enumerate("ab") for t in range(3)}
    boxes = [(k, "ab"[k % 2], 0, x, x + w, y, y + h, 1, bool(k % 3)) for k, (x, w, y, h) in enumerate([(0, 5, 0, 9), (3, 5, 0, 9), (35, 5, 0, 9), (8, 7, 0, 9), (2, 4, 12, 18), (1, 4, 12, 18), (30, 10, 29, 1), (5, 0, 3, 3)])]
    moves = [(f, t, 0.4 * t, -0.7 * p) for (f, p, t) in images]
    data, table = stack(spark, images), spark.createDataFrame(boxes, BOXES)
    transforms = spark.createDataFrame(moves, "fov string, t int, tx double, ty double")
    for degrees, integers in ((0.0, True), (5.0, False)):
        warped = {(r.fov, r.t): image_of(r) for r in geometry.warp(data, transforms, degrees).collect()}
        found = trenches.crops(data, transforms, table, degrees, integers).collect()
        assert len(found) == 3 * 7  # the box without width has no crops
        for r in found:
            _, fov, _, x0, x1, y0, y1, _, flip = boxes[r.trench_id]
            want = warped[fov, r.t][y0:y1, x0:x1]
            want = want[::-1] if flip else want
            assert (r.h, r.w) == (y1 - y0, x1 - x0)
            assert (image_of(r) == np.trunc(want)).all() if integers else np.allclose(image_of(r), want)


def test_a_large_frame_is_cut_fast():
    image = np.random.default_rng(4).integers(0, 60000, (512, 512)).astype(np.uint16)
    x = np.arange(0, 480, 12)
    boxes = {"y_top": np.repeat([40, 300], len(x)), "y_bottom": np.repeat([200, 460], len(x)), "x_left": np.tile(x, 2), "x_right": np.tile(x, 2) + 32, "needs_flip": np.repeat([False, True], len(x))}
    for m in ((1, 0, 0.3, 0, 1, 0.6), (0.99, 0.1, 0.3, -0.1, 0.99, 0.6)):
        began = time.process_time()
        for _ in range(5):
            assert sum(len(own) for own, *_ in kernels.cut_bands(image, m, boxes)) == 80
        assert (time.process_time() - began) / 5 < 0.1


def test_means_of_whole_images(spark, monkeypatch):
    rows = [("a", 0, t, c, 2, 3, [None if (t + i) % 4 == 0 or (c == "y" and i == 5) else float(i * t) for i in range(6)]) for t in range(5) for c in "xy"] + [("b", 1, 0, "x", 1, 1, [7.0]), ("b", 1, 1, "x", 1, 1, None)]
    data = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(means, "PIECE", 4)
    monkeypatch.setattr(means, "HELD", 60)
    found = {(r.fov, r.c): (r.h, r.w, r.pixels) for r in means.mean_frames(data).collect()}
    for (fov, c), (h, w, pixels) in found.items():
        own = [r[6] for r in rows if r[0] == fov and r[3] == c and r[6]]
        for i, v in enumerate(pixels):
            values = [p[i] for p in own if p[i] is not None]
            assert (v is None and not values) or abs(v - sum(values) / len(values)) < 1e-12
    assert set(found) == {("a", "x"), ("a", "y"), ("b", "x")} and found["a", "y"][2][5] is None
    image = means.mean_image(data, 3, "start").collect()
    assert len(image) == 13 and {(r.y, r.x) for r in image if r.c == "y"} == {(y, x) for y in range(2) for x in range(3)}
    assert means.mean_frames(data.limit(0)).collect() == []


def scene(n, ty, tx, seed=1):
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[:n, :n].astype(float)
    image = np.zeros((n, n))
    for _ in range(14):
        cy, cx, s, a = rng.uniform(-10, n + 10), rng.uniform(-10, n + 10), rng.uniform(2, 5), rng.uniform(40, 120)
        image += a * np.exp(-((y - cy - ty) ** 2 + (x - cx - tx) ** 2) / (2 * s * s))
    return image


@pytest.mark.parametrize("n, noise", [(64, 0), (96, 2), (200, 2)])
def test_known_shifts(n, noise):
    rng = np.random.default_rng(0)
    for tx, ty in ((0.1, 0), (0.5, -0.3), (3.2, 1.7), (8, -4.5), (15, 4), (22, -12), (-25, 25)):
        ref, mov = scene(n, 0, 0) + noise * rng.normal(size=(n, n)), scene(n, ty, tx) + noise * rng.normal(size=(n, n))
        x, y, residual = registration.least_squares(ref, mov)
        assert abs(x - tx) < 0.05 and abs(y - ty) < 0.05 and residual < 1, (n, noise, tx, ty, x, y)


def test_shifts_that_pixels_do_not_tell():
    x = np.arange(64.0)
    a, b = np.tile(np.sin(x / 5), (64, 1)), np.tile(np.sin((x - 3) / 5), (64, 1))
    tx, ty, _ = registration.least_squares(a, b)
    assert abs(tx - 3) < 1e-3 and ty == 0
    tx, ty, _ = registration.least_squares(a.T, b.T)
    assert abs(ty - 3) < 1e-3 and tx == 0
    for shape in ((1, 1), (3, 3), (8, 8), (2, 40)):
        assert np.allclose(registration.least_squares(np.ones(shape), np.ones(shape))[:2], 0)


def test_spline_goes_through_the_pixels():
    image = np.random.default_rng(5).normal(size=(30, 21))
    error, _, _ = registration._difference(image, registration.spline_coefficients(image), 0.0, 0.0)
    assert error < 1e-20


@pytest.mark.parametrize("block", [1, 2, 5, 32])
def test_blocks_do_not_change_the_drift(spark, block):
    times = [0, 1, 2, 5, 9, 10, 11, 40]
    data = stack(spark, {(f, p, t): scene(40, 0.4 * t % 5, -0.3 * t % 4, seed=p) for p, f in enumerate("ab") for t in times})
    for mode in ("previous", "first", "last", "mean", 5):
        found = {(r.fov, r.t): (r.tx, r.ty) for r in registration.register_with_residuals(data, mode, block=block).collect()}
        assert len(found) == 2 * len(times)
        if mode != "mean":
            at = {"previous": 0, "first": 0, "last": 40, 5: 5}[mode]
            for (_, t), (tx, ty) in found.items():
                assert abs(tx - ((-0.3 * t % 4) - (-0.3 * at % 4))) < 0.1 and abs(ty - (0.4 * t % 5 - 0.4 * at % 5)) < 0.1, (mode, t)


def test_drift_without_a_reference(spark):
    data = spark.createDataFrame([("a", 0, 0, "x", 2, 2, [1.0] * 4), ("a", 0, 1, "x", 2, 2, None), ("b", 1, 3, "x", 2, 2, [1.0] * 4)], SCHEMA)
    assert [(r.fov, r.t, r.tx, r.residual) for r in registration.register_with_residuals(data, 0).orderBy("fov", "t").collect()] == [("a", 0, 0.0, 0.0), ("a", 1, 0.0, None), ("b", 3, 0.0, None)]
    assert registration.register(data.limit(0), "previous").collect() == []


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_products_of_matrices(spark, block):
    rng = np.random.default_rng(6)
    rows = [(f, t, *(np.array([1, 0, 0, 0, 1, 0]) + 0.1 * rng.normal(size=6)).tolist()) for f in "ab" for t in (*range(8), 12, 30)]
    rows[4] = ("a", 4, *[None] * 6)
    table = spark.createDataFrame(rows, "fov string, t int, " + ", ".join(f"{n} double" for n in geometry.NAMES))
    found = {(r.fov, r.t): [r[n] for n in geometry.NAMES] for r in geometry.cumulated_matrices(table, block).collect()}
    assert len(found) == len(rows)
    now = None
    for fov, t, *m in rows:
        if t == 0:
            now = np.eye(3)
        elif m[0] is not None:
            now = now @ np.array([m[:3], m[3:], [0, 0, 1]])
        assert np.allclose(found[fov, t], now[:2].ravel())
    moves = spark.createDataFrame([("a", t, 1.0, -2.0) for t in range(5)], "fov string, t int, tx double, ty double")
    assert sorted((r.t, r.m02, r.m12) for r in geometry.cumulated_matrices(moves, block).collect()) == [(t, float(t), -2.0 * t) for t in range(5)]


def plain_prominence(values, p):
    higher = np.flatnonzero(values > values[p])
    left, right = higher[higher < p], higher[higher > p]
    low, high = values[left[-1] + 1 if len(left) else 0 : p + 1].min(), values[p : right[0] if len(right) else len(values)].min()
    return values[p] - max(low, high)


def plain_apart(values, found, distance):
    kept = np.ones(len(found), bool)
    for k in np.argsort(values[found], kind="stable")[::-1]:
        if kept[k]:
            near = np.abs(found - found[k]) < distance
            near[k] = False
            kept &= ~near
    return found[kept]


def test_peaks_against_plain_versions():
    rng = np.random.default_rng(7)
    for n in (1, 2, 3, 5, 20, 60):
        for _ in range(60):
            values = rng.integers(0, 6, n).astype(float)
            found = signal.peaks_of(values, None, None, None)
            assert signal.prominences(values, found).tolist() == [plain_prominence(values, p) for p in found]
            assert signal.peaks_of(values, None, 4, None).tolist() == plain_apart(values, found, 4).tolist()


def test_long_profiles_are_fast():
    values = np.random.default_rng(8).normal(size=1_000_000)
    began = time.process_time()
    signal.peaks_of(values, None, 300, 1.0)
    signal.smooth_values(values, 400.0)
    assert time.process_time() - began < 5


def test_smoothing_by_spectra_equals_sums(spark, monkeypatch):
    rng = np.random.default_rng(9)
    for n, sigma in ((5, 9.0), (300, 4.0), (50, 40.0)):
        values = np.concatenate((rng.normal(size=n), np.full(n, 3.0)))
        direct = signal.smooth_values(values, sigma)
        with monkeypatch.context() as m:
            m.setattr(signal, "_DIRECT", 0)
            assert np.allclose(signal.smooth_values(values, sigma), direct, atol=1e-9)
            flat = signal.smooth_values(np.full(900, 3.0), sigma)
            assert (flat == flat[0]).all() and abs(flat[0] - 3) < 1e-9
    rows = spark.createDataFrame([([1.0, 2.0, 4.0], 0.0), ([1.0, 2.0, 4.0], 1.0), (None, 1.0), ([], 1.0), ([1.0, 2.0, 4.0], None)], "profile array<double>, sigma double")
    found = [r.s for r in rows.select(signal.gaussian_smooth(F.col("profile"), F.col("sigma")).alias("s")).collect()]
    assert found[0] == found[4] == [1, 2, 4] and np.allclose(found[1], signal.smooth_values(np.array([1.0, 2, 4]), 1.0)) and found[2] is None and found[3] == []


def test_overrides_are_applied(spark):
    image = np.zeros((200, 160))
    image[:, 40], image[:, 80], image[:, 120] = 100, 30, 60
    mean = spark.createDataFrame([("a", y, x, float(image[y, x])) for y in range(200) for x in range(160)], "fov string, y int, x int, v double")
    lanes = spark.createDataFrame([("a", 0, 100, 1), ("a", 1, 101, 1)], "fov string, lane_index int, y_center int, orientation int")
    own = {1: {"sigma": 0.0, "height": 50.0, "prominence": 5.0, "distance": 90.0, "trench_bottom_offset": 20.0}}
    found = trenches.detect_trenches(mean, lanes, sigma=2, distance=10, prominence=1, trench_width=4, trench_length=60, trench_bottom_offset=10, overrides=own).orderBy("trench_id").collect()
    assert [(r.lane_index, r.x_left + 2, r.y_top) for r in found] == [(0, 40, 30), (0, 80, 30), (0, 120, 30), (1, 40, 21)]
    assert [r.trench_id for r in found] == [0, 1, 2, 3]


def test_planes_of_bytes():
    rng = np.random.default_rng(10)
    for dtype in chunks.DTYPES:
        values = rng.normal(size=12) * 50 if dtype.startswith("float") else rng.integers(0, 200, 12)
        for shuffle in (True, False):
            assert (chunks.plane_values(chunks.plane_bytes(values, dtype, shuffle), dtype, shuffle) == values.astype(dtype)).all()
    assert chunks.plane_bytes(np.array([0x0102, 0x0304]), "uint16", True) == bytes([2, 4, 1, 3])


def test_extraction_to_chunks(spark, tmp_path):
    rng = np.random.default_rng(11)
    images = {(f"XYPos:{p}", p, t): rng.integers(0, 60000, (16, 20)) for p in range(3) for t in range(7)}
    data = stack(spark, images)
    boxes = [(3 * p + k, f"XYPos:{p}", 0, 4 * k, 4 * k + 5, 2, 10, 1, k == 1) for p in range(3) for k in range(3)]
    table = spark.createDataFrame(boxes, BOXES)
    moves = data.select("fov", "t", (F.col("t") * 0.5).alias("tx"), F.lit(0.25).alias("ty"))
    want = {(r.trench_id, r.t): r.pixels for r in trenches.crops(data, moves, table).collect()}
    path = f"{tmp_path}/store"
    fails = data.withColumn("pixels", F.when(F.col("p_index") == 1, F.raise_error(F.lit("crash")).cast("array<double>")).otherwise(F.col("pixels")))
    with pytest.raises(Exception, match="crash"):
        store.extract(fails, moves, table, path, time_chunk=3, batch=1)
    groups = {"events": spark.createDataFrame([(1,)], "event int")}
    assert store.extract(data, moves, table, path, time_chunk=3, batch=1, groups=groups, attributes={"who": "me"}) == ["XYPos:1", "XYPos:2"]
    assert store.extract(data, moves, table, path, time_chunk=3) == []
    with pytest.raises(RuntimeError):
        store.extract(data, moves, table, path, time_chunk=4)
    assert {(r.trench_id, r.t): r.pixels for r in chunks.read(spark, path).collect()} == want
    raw = spark.read.parquet(f"{path}/crops")
    assert {(r.chunk, r.n) for r in raw.collect()} == {(0, 3), (1, 3), (2, 1)} and raw.count() == 9 * 3
    some = chunks.read(spark, path, trench_ids=[4], fovs=["XYPos:1"], start=2, end=5)
    assert {(r.trench_id, r.t): r.pixels for r in some.collect()} == {(4, t): want[4, t] for t in (2, 3, 4)}
    plan = explained(some)
    assert all(f in plan for f in ("EqualTo(trench_id,4)", "GreaterThanOrEqual(t_last,2)", "LessThan(t_first,5)")) and "fov" in plan.split("PartitionFilters")[1].split("\n")[0]
    keep = store.Store(spark, path)
    assert keep.attributes()["who"] == "me" and keep.attributes()["extraction"]["time_chunk"] == 3 and store.read_group(spark, path, "events").count() == 1
    whole = store.extract(data, moves, table, path, dtype="float32", compression="none", byte_shuffle=False, resume=False)
    assert len(whole) == 3 and spark.read.parquet(f"{path}/crops").select("n").distinct().collect()[0].n == 7
    keep.wipe(everything=True)
    assert not keep.attributes() and store.read_group(spark, path, "events") is None and not keep._exists(f"{path}/crops")
    for bad in ({"time_chunk": 0}, {"time_chunk": 1.5}, {"dtype": "text"}):
        with pytest.raises(ValueError):
            chunks.pack(data, **bad)


def test_slots_in_blocks(spark):
    table = spark.createDataFrame([(i,) for i in (5, 900, 3, 70000, 12, 131073)], "trench_id int")
    for block in (1, 10, 1 << 16):
        assert [(r.trench_id, r.slot) for r in trenches.slots(table, block).orderBy("slot").collect()] == [(3, 0), (5, 1), (12, 2), (900, 3), (70000, 4), (131073, 5)]


@pytest.mark.parametrize("noise", [0.0, 0.01])
def test_phases_of_smooth_spots(noise):
    """Wide spots leave most frequencies to noise, whose phases must not count."""
    rng = np.random.default_rng(1)
    y, x = np.mgrid[:32, :32].astype(float)

    def image(dy, dx):
        return sum(v * np.exp(-((y - cy - dy) ** 2 + (x - cx - dx) ** 2) / 18) for cy, cx, v in ((9, 13, 60), (15, 18, 80), (21, 21, 100))) + noise * rng.standard_normal((32, 32))

    for dy, dx in ((-1, 0), (0.5, -0.5), (-0.5, 2), (1, 1)):
        assert np.allclose(registration.phase_translation(image(0, 0), image(dy, dx)), (dx, dy), atol=0.06)


@pytest.mark.parametrize("slope", [0.0, 3.0])
def test_phases_on_a_slope_of_light(slope):
    texture = np.random.default_rng(3).standard_normal((160, 160))
    for axis in (0, 1):
        texture = (np.roll(texture, 1, axis) + 2 * texture + np.roll(texture, -1, axis)) / 4
    light = slope * np.mgrid[:100, :100].sum(0)
    for dy, dx in ((3, -5), (10, 20), (25, -3)):
        found = registration.phase_translation(10 * texture[30:130, 30:130] + light, 10 * texture[30 - dy : 130 - dy, 30 - dx : 130 - dx] + light)
        assert np.allclose(found, (dx, dy), atol=0.15)


def test_phases_of_flat_and_tiny_images():
    for shape in ((1, 1), (1, 5), (4, 4)):
        assert registration.phase_translation(np.ones(shape), np.ones(shape)) == (0.0, 0.0)
