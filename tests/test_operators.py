"""Operators against closed forms on made-up frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.functions.names import canonical_json, snake_name
from strataframe.operators import geometry, means, metadata, registration, selection, signal, trenches
from strataframe.sources import frames, store

SCHEMA = "fov string, p_index int, t int, c string, h int, w int, pixels array<double>"


def stack(spark, images):
    return spark.createDataFrame([(f, p, t, "single", *im.shape, im.astype(float).ravel().tolist()) for (f, p, t), im in images.items()], SCHEMA)


def blob(h, w, cy, cx, s=3.0):
    y, x = np.mgrid[:h, :w]
    return 100 * np.exp(-((y - cy) ** 2 + (x - cx) ** 2) / (2 * s * s)) + 20 * np.exp(-((y - cy - 8) ** 2 + (x - cx + 6) ** 2) / 8)


def image_of(row):
    return np.array(row.pixels).reshape(row.h, row.w)


def test_translations_are_found(spark):
    true = {0: (0.0, 0.0), 1: (1.5, -0.75), 2: (-3.0, 2.0), 3: (4.25, 3.0)}
    data = stack(spark, {("a", 0, t): blob(48, 48, 22 + ty, 24 + tx) for t, (tx, ty) in true.items()})
    for mode, backend, off in (("first", "least_squares", 0.02), ("first", "phase", 0.3), ("previous", "least_squares", 0.05)):
        for r in registration.register(data, mode, backend).collect():
            assert abs(r.tx - true[r.t][0]) < off and abs(r.ty - true[r.t][1]) < off, (mode, backend, r)
    half = registration.register(data, "first", downsampled=2).where("t = 2").first()
    assert abs(half.tx + 6) < 0.1
    with pytest.raises(ValueError):
        registration.register(data, "previous", "phase")
    with pytest.raises(ValueError):
        registration.register(data, "first", "other")
    with pytest.raises(ValueError):
        means.reference(data, "median")


def test_warp_identity_integer_half_and_quarter_turn(spark):
    im = np.arange(16.0).reshape(4, 4)
    data = stack(spark, {("a", 0, 0): im})
    move = lambda tx, ty: spark.createDataFrame([("a", 0, tx, ty)], "fov string, t int, tx double, ty double")
    assert (image_of(geometry.warp(data, move(0.0, 0.0)).first()) == im).all()
    one = np.zeros((4, 4))
    one[:3, :3] = im[1:, 1:]
    assert (image_of(geometry.warp(data, move(1.0, 1.0)).first()) == one).all()
    half = image_of(geometry.warp(data, move(0.5, 0.0)).first())
    assert np.allclose(half[:, :3], (im[:, :3] + im[:, 1:]) / 2) and np.allclose(half[:, 3], im[:, 3] / 2)
    turned = image_of(geometry.warp(data, move(0.0, 0.0), 90.0).first())
    y, x = np.mgrid[:4, :4]
    assert np.allclose(turned, im[x, 3 - y], atol=1e-9)


def test_registered_frames_align(spark):
    data = stack(spark, {("a", 0, 0): blob(40, 40, 20, 20), ("a", 0, 1): blob(40, 40, 22, 17)})
    moved = geometry.warp(data, registration.register(data, "first"))
    a, b = (image_of(r) for r in moved.orderBy("t").collect())
    assert np.abs(a - b)[5:35, 5:35].max() < 2


def test_select_roi_slices_and_downsample_remainder(spark):
    im = np.arange(35.0).reshape(5, 7)
    data = stack(spark, {("a", 0, 0): im})
    assert (image_of(selection.select_roi(data, (1, -1), (None, 3)).first()) == im[1:-1, :3]).all()
    assert selection.select_roi(data, (4, 2)).first().pixels == []
    small = means.downsample(frames.pixels(data), 2).toPandas().pivot(index="y", columns="x", values="v").to_numpy()
    assert np.allclose(small, im[:4, :6].reshape(2, 2, 3, 2).mean(axis=(1, 3)))


def test_times_slice_like_python(spark):
    data = spark.range(10).select(F.col("id").cast("int").alias("t"))
    for a, b in ((2, 5), (None, -2), (-3, None), (0, 99), (5, 2), (-99, 3)):
        assert sorted(r.t for r in selection.select_times(data, a, b).collect()) == list(range(10))[a:b]


def test_rename_and_resolve(spark):
    data = spark.createDataFrame([("a", 0), ("b", 1), ("a", 2)], "label string, pos int")
    assert [r.label for r in selection.rename_duplicates(data, "label", "pos").orderBy("pos").collect()] == ["a-01", "b", "a-02"]
    assert selection.resolve(-1, ["x", "y"]) == "y"
    with pytest.raises(ValueError):
        selection.resolve("z", ["x"])
    assert selection.evenly_spaced(10, 4) == [0, 3, 6, 9]


def brute_smooth(p, sigma):
    r = int(4 * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(np.pad(p, r, "symmetric"), w / w.sum(), "valid")


@pytest.mark.parametrize("sigma", [0, 0.7, 3, 9])
def test_smoothing(spark, sigma):
    p = np.random.default_rng(3).normal(size=17)
    row = spark.createDataFrame([(p.tolist(),)], "profile array<double>").select(signal.gaussian_smooth(F.col("profile"), sigma).alias("s")).first()
    assert np.allclose(row.s, p if sigma == 0 else brute_smooth(p, sigma))


def test_convolution(spark):
    p = np.arange(6.0) ** 2
    row = spark.createDataFrame([(p.tolist(),)], "profile array<double>").select(signal.convolve(F.col("profile"), [1, 2, 3]).alias("s")).first()
    assert np.allclose(row.s, np.convolve(p, [1, 2, 3]) / 6)


def test_peaks():
    flat = np.array([0, 1, 1, 1, 0, 3, 0, 2, 2])
    assert signal.peaks_of(flat, None, None, None).tolist() == [2, 5]
    assert signal.peaks_of(np.array([0, 5, 0, 5, 0, 5, 0.0]), None, 3, None).tolist() == [1, 5]  # of equals the last goes first
    assert signal.peaks_of(np.array([0, 4, 3, 5, 0.0]), None, None, 2).tolist() == [3]
    assert signal.peaks_of(np.array([]), 0, 1, 1).tolist() == []
    assert signal.peaks_of(np.ones(5), None, None, None).tolist() == []
    assert signal.peaks_of(np.array([9, 1, 2, 1, 9.0]), 2, None, None).tolist() == [2]


@pytest.mark.parametrize("width", [32, 33])
def test_trench_shape_is_exact(spark, width):
    image = np.zeros((200, 160))
    image[:, 40] = image[:, 80] = 100
    mean = frames.pixels(stack(spark, {("a", 0, 0): image}))
    lanes = spark.createDataFrame([("a", 0, 100, 1)], "fov string, lane_index int, y_center int, orientation int")
    found = trenches.detect_trenches(mean, lanes, sigma=2, distance=10, prominence=1, trench_width=width, trench_length=60, trench_bottom_offset=10).orderBy("trench_id").collect()
    assert [(r.x_left, r.x_right, r.y_top, r.y_bottom, r.needs_flip) for r in found] == [(p - width // 2, p - width // 2 + width, 30, 90, False) for p in (40, 80)]
    for key in ("trench_width", "trench_length", "shrink_scale"):
        with pytest.raises(ValueError, match=key):
            trenches.detect_trenches(mean, lanes, overrides={0: {key: 1}})


def test_lanes(spark):
    image = np.zeros((120, 10))
    image[40] = image[90] = 1000.0
    image[20:40] = 50
    image[91:110] = 50
    mean = frames.pixels(stack(spark, {("a", 0, 0): image}))
    found = trenches.detect_lanes(mean, sigma=1, distance=20, height=100, window_um=10).orderBy("lane_index").collect()
    assert [(r.lane_index, r.y_center) for r in found] == [(0, 40), (1, 90)]
    assert found[1].orientation == -1


def test_crops_of_the_fixture(spark):
    images = {(f"XYPos:{p}", p, t): np.arange(12).reshape(3, 4) + 100 * t + 10 * p for p in (0, 1) for t in (0, 1)}
    data = stack(spark, images).where("p_index = 1 and t = 1")
    still = data.select("fov", "t", F.lit(0.0).alias("tx"), F.lit(0.0).alias("ty"))
    table = spark.createDataFrame([(7, "XYPos:1", 0, 1, 3, 0, 2, 1, False), (9, "XYPos:1", 1, 0, 2, 1, 3, -1, True)], "trench_id int, fov string, lane_index int, x_left int, x_right int, y_top int, y_bottom int, orientation int, needs_flip boolean")
    found = {r.trench_id: r.pixels for r in trenches.crops(data, still, table).collect()}
    assert found == {7: [111, 112, 115, 116], 9: [118, 119, 114, 115]}
    assert trenches.uniform_shape(table) == (2, 2)
    with pytest.raises(ValueError):
        trenches.uniform_shape(table.withColumn("x_right", F.col("x_right") + F.col("lane_index")))


def test_store_and_resume(spark, tmp_path):
    keep = store.Store(spark, f"{tmp_path}/s")
    assert not keep.has("registration")
    with pytest.raises(RuntimeError):
        keep.load("registration")
    keep.save("registration", spark.range(3), {"mode": "mean", "rotation": 0})
    keep.save("lanes", spark.range(2), {})
    assert keep.load("registration").count() == 3 and keep.matches("registration", {"rotation": 0, "mode": "mean"}) and not keep.matches("registration", {"mode": "first"})
    keep.reset("registration")
    assert not keep.has("lanes")

    crops = spark.createDataFrame([("a", 1), ("b", 2)], "fov string, v int")
    path = f"{tmp_path}/crops"
    store.write_crops(crops.where("fov = 'a'"), path, "f1")
    store.write_crops(crops, path, "f1")
    assert sorted((r.fov, r.v) for r in spark.read.parquet(f"{path}/crops").collect()) == [("a", 1), ("b", 2)]
    with pytest.raises(RuntimeError):
        store.write_crops(crops, path, "f2")


def test_metadata(spark):
    records = spark.createDataFrame([('{"Index": 3, "T Index": 1, "P Index": 1}',), ('{"Index": 1, "Z Index": 2}',), ('{"Time [s]": 1.5, "Events": "go"}',)], "json string")
    at = spark.createDataFrame([(1,)], "p_index int"), spark.createDataFrame([(1,)], "t int")
    kept, other = metadata.split_events(records, *at)
    assert kept.count() == 1 and other.count() == 1
    assert sorted(metadata.records_table(records.limit(2), "frame").columns) == ["frame_index", "frame_p_index", "frame_t_index", "frame_z_index"]
    kinds = spark.createDataFrame([('{"a": true, "b": 1, "c": 1.5, "d": "x", "e": null, "f": 1, "g": 1}',), ('{"a": null, "b": 2, "c": 1, "d": null, "e": null, "f": null, "g": "y"}',)], "json string")
    assert {r["key"]: r["type"] for r in metadata.key_types(kinds).collect()} == {"a": "object", "b": "int64", "c": "float64", "d": "string", "e": "object", "f": "float64", "g": "string"}
    doc = spark.createDataFrame([('{"metadata": {"channels": [{"name": "PC", "gain": "2", "box": "[1]"}, {"name": "mC"}]}}',)], "json string")
    assert [(r.channel, r.settings) for r in metadata.acquisition_channels(doc).collect()] == [("PC", {"gain": "2"}), ("mC", {})]
    assert [r.channel for r in metadata.acquisition_channels(doc, ["x", "y"]).collect()] == ["x", "y"]


def test_names():
    assert [snake_name(n) for n in ("Time [s]", "T Index", "PositionName", "a[3]", "[]", "2nd", "µm", "")] == ["time_s", "t_index", "position_name", "a_field_3", "value", "field_2nd", "um", "value"]
    assert canonical_json({"b": 1, "a": "é"}) == '{"a":"\\u00e9","b":1}'


def test_names_by_rule():
    cases = {"gain(3)": "gain_3", "x[]": "x_value", "a[b]c": "a_bc", "a[3]B": "a_field_3_b", "{mode}": "mode", "HTTPServer": "httpserver", "aB1C": "a_b1_c", "a[b[c]d]": "a_b_cd", "open[": "open", "é x": "x"}
    assert {n: snake_name(n) for n in cases} == cases


def test_edge_frames_of_a_subset(spark):
    data = stack(spark, {("a", 0, t): np.full((2, 2), 100.0 * t) for t in range(30)})
    value = lambda image: image.first().v
    assert value(means.mean_image(selection.select_times(data, 5, 20), 10, "start")) == 950
    assert value(means.mean_image(data.where("t % 5 = 0"), 2, "end")) == 2250
    assert means.edge_frames(data, 99, "end").count() == 30


def test_registration_takes_one_channel(spark):
    rows = [(t, c, shift) for t, shift in ((0, 0.0), (1, 2.0)) for c in ("gfp", "phase")]
    images = [("a", 0, t, c, 40, 40, (blob(40, 40, 20, 20 + s) if c == "phase" else blob(40, 40, 20, 20) * 0 + t).ravel().tolist()) for t, c, s in rows]
    data = spark.createDataFrame(images, SCHEMA)
    found = registration.register(data, "first", channel="phase").orderBy("t").collect()
    assert len(found) == 2 and abs(found[1].tx - 2) < 0.05
    assert registration.register(data, "first").count() == 2 and geometry.warp(data, registration.register(data, "previous", channel="phase")).count() == 4
    small = registration.prepared(data, "phase", (0, 36), None, 2)
    assert {(r.h, r.w, len(r.pixels)) for r in small.collect()} == {(18, 20, 360)}
    half = registration.register(small, "first", downsampled=2).orderBy("t").collect()
    assert abs(half[1].tx - 2) < 0.2


def test_trenches_follow_the_positions(spark):
    names = spark.createDataFrame([(f"XYPos:{i}", 0, 5) for i in (10, 2, 0, 11, 1)] + [("other", 0, 1)], "fov string, lane_index int, x_left int")
    assert [r.fov for r in trenches.numbered(names, [*trenches.position_order(), "lane_index"]).orderBy("trench_id").collect()] == ["XYPos:0", "XYPos:1", "XYPos:2", "XYPos:10", "XYPos:11", "other"]
    boxes = spark.createDataFrame([(0, "a", 0, 1, 3, 0, 2, 1, False)], "trench_id int, fov string, lane_index int, x_left int, x_right int, y_top int, y_bottom int, orientation int, needs_flip boolean")
    moved = spark.createDataFrame([("a", 0, 0.5, 0.0)], "fov string, t int, tx double, ty double")
    marks = {trenches.fingerprint(b, s, m).first()[0] for b, s, m in ((boxes, "s", None), (boxes, "s", moved), (boxes, "s", moved.withColumn("tx", F.lit(0.6))), (boxes, "u", moved), (boxes.withColumn("needs_flip", F.lit(True)), "s", moved))}
    assert len(marks) == 5


def test_a_crash_loses_one_batch(spark, tmp_path):
    path = f"{tmp_path}/s"
    crops = spark.createDataFrame([(f, k) for k, f in enumerate("abc")], "fov string, v int")
    fails = crops.withColumn("v", F.when(F.col("fov") == "b", F.raise_error(F.lit("crash")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="crash"):
        store.write_crops(fails, path, "f", batch=1)
    assert [r.fov for r in spark.read.parquet(f"{path}/manifest").collect()] == ["a"]
    store.write_crops(crops.withColumn("v", F.col("v") + 10), path, "f", batch=1)
    assert sorted((r.fov, r.v) for r in spark.read.parquet(f"{path}/crops").collect()) == [("a", 0), ("b", 11), ("c", 12)]
    store.write_crops(crops.where("fov = 'c'"), path, "other", resume=False)
    assert [(r.fov, r.v) for r in spark.read.parquet(f"{path}/crops").collect()] == [("c", 2)]
    store.write_groups(path, events=crops, acquisition=crops.select())
    assert store.read_group(spark, path, "events").count() == 3 and store.read_group(spark, path, "acquisition") is None
    with pytest.raises(ValueError):
        store.write_groups(path, other=crops)
    keep = store.Store(spark, f"{tmp_path}/t")
    keep.save("lanes", crops, {"a": 1})
    assert keep.params("lanes") == {"a": 1}
    keep.wipe()
    assert not keep.has("lanes")


def test_bad_numbers_in_metadata_are_null(spark):
    read = spark.createDataFrame([('{"channels":[{"time":{"relativeTimeMs":"n/a"}}]}',)], "json string").select(*metadata.frame_scalars(F.col("json"))).first()
    assert read.relative_time_ms is None
    bad = spark.createDataFrame([('{"Index": 1, "T Index": "x"}',)], "json string")
    at = spark.createDataFrame([(0,)], "p_index int"), spark.createDataFrame([(0,)], "t int")
    assert metadata.split_events(bad, *at)[0].count() == 1


def test_ingest_is_idempotent(spark, tmp_path):
    from strataframe.streaming.ingest import ingest_frames

    data = stack(spark, {("a", 0, 0): np.ones((2, 2)), ("a", 0, 1): np.ones((2, 2))})
    for k in (0, 1):
        data.coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        ingest_frames(spark, f"{tmp_path}/in/*", SCHEMA, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
