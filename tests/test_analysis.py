"""Stages of an analysis, and the source of raw frames."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.operators import trenches
from strataframe.sources import analysis, chunks, experiment, raw, store


def scene(shift, p):
    """A lane with three bright columns below it, moved sideways."""
    image = np.full((60, 80), 100.0)
    image[28:32] = 900
    for x in (15, 40, 62):
        image[5:30, x + shift - 2 + p : x + shift + 3 + p] = 700
    return image


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw"))
    raw.write({f"XYPos:{p}": np.stack([np.stack([scene(t, p), scene(t, p) / 2]) for t in range(4)]).astype(np.uint16) for p in range(2)}, f"{path}/frames", ["PC", "mC"], [0.0, 10.0, 20.0, 30.0])
    raw.read(spark, f"{path}/frames").write.parquet(f"{path}/table")
    return path


def test_raw_frames(spark, source):
    table = raw.read(spark, f"{source}/frames")
    assert table.count() == 16 and table.columns == ["fov", "p_index", "t", "t_ms", "c", "c_index", "h", "w", "pixels"]
    one = table.where("fov = 'XYPos:1' and t = 2 and c = 'mC'").collect()
    assert len(one) == 1 and (np.array(one[0].pixels).reshape(60, 80) == (scene(2, 1) / 2).astype(np.uint16)).all() and one[0].t_ms == 20
    some = raw.read(spark, f"{source}/frames", fovs=["XYPos:1"], start=1, end=-1, channels=["PC"]).where("pixels[0] > 0")
    assert sorted((r.p_index, r.t, r.c) for r in some.collect()) == [(1, 1, "PC"), (1, 2, "PC")]
    names = raw.read(spark, f"{source}/frames", ["t", "fov"], fovs=[0])
    assert names.columns == ["t", "fov"] and names.distinct().count() == 4
    assert table.where("t > 99").count() == 0 and table.where("t <= 0 or c = 'PC'").count() == 10 and table.where("t = 0").join(table.where("t = 3"), ["fov", "c"]).count() == 4
    assert raw.read(spark, f"{source}/frames", fovs=["no"]).count() == 0 and table.count() == 16
    with pytest.raises(FileNotFoundError):
        raw.read(spark, f"{source}/nothing")
    with pytest.raises(ValueError):
        raw.write({"a": np.zeros((1, 1, 2, 2)), "b": np.zeros((1, 1, 2, 3))}, f"{source}/bad", ["x"])


def test_one_frame_opens_one_file(source, monkeypatch):
    from pyspark.sql.types import StructType

    monkeypatch.setattr(raw, "RANGE_BYTES", 60 * 80 * 2 * 2 * 2)
    schema, choice = StructType.fromDDL(raw.SCHEMA), {"fovs": None, "start": None, "end": None, "channels": None}
    assert len(raw.RawReader(f"{source}/frames", schema, choice).partitions()) == 4
    reader = raw.RawReader(f"{source}/frames", schema, {"fovs": [1], "start": 3, "end": 4, "channels": ["PC"]})
    parts = reader.partitions()
    assert [(p.position, p.start, p.end) for p in parts] == [(1, 3, 4)]
    batches = list(reader.read(parts[0]))
    assert [b.num_rows for b in batches] == [1] and batches[0].column("pixels")[0].as_py() == scene(3, 1).ravel().tolist()


PARAMS = {
    "registration": {"channel": "PC", "mode": "first", "mean_n_frames": 2, "mean_from": "start"},
    "lanes": {"sigma": 1.0, "distance": 20, "height": 400, "window_um": 10.0},
    "trenches": {"sigma": 1.0, "distance": 8, "prominence": 50, "trench_width": 9, "trench_length": 20, "trench_bottom_offset": 3, "least_band": 2, "lane_params": {0: {"prominence": 40}}},
}


def made(spark, source, path, **changes):
    whole = experiment.load(spark, f"{source}/table")
    return analysis.Analysis(changes.pop("experiment", whole), store.Store(spark, path), **{k: v | changes.get(k, {}) for k, v in PARAMS.items()}, means=changes.get("means", {}))


def test_an_analysis_from_frames_to_crops(spark, source, tmp_path):
    path = f"{tmp_path}/s"
    run = made(spark, source, path)
    for stage in analysis.STAGES:
        with pytest.raises(RuntimeError, match="missing"):
            run.load(stage)
    assert "registration missing" in repr(run)
    written = run.extract(f"{path}/crops_of_all", time_chunk=2, discard=[1])
    assert written == ["XYPos:0", "XYPos:1"] and {run.state(s) for s in analysis.STAGES} == {"ready"}
    drift = {(r.fov, r.t): (r.tx, r.ty) for r in run.transforms().collect()}
    assert all(abs(tx - t) < 0.1 and abs(ty) < 0.1 for (_, t), (tx, ty) in drift.items())
    lanes, boxes = run.lane_table().collect(), run.trench_table().orderBy("trench_id").collect()
    assert len(lanes) == 2 and [r.trench_id for r in boxes] == list(range(6)) and [r.x_left + 4 for r in boxes[:3]] == [15, 40, 62]
    found = chunks.read(spark, f"{path}/crops_of_all")
    assert found.select("trench_id").distinct().count() == 5 and found.count() == 5 * 4 * 2
    crop = np.array(found.where("trench_id = 0 and t = 3 and c = 'PC'").first().pixels).reshape(20, 9)
    assert (crop[:, 3:6] == 700).mean() > 0.5
    about = store.Store(spark, f"{path}/crops_of_all").attributes()
    assert about["source"] == f"{source}/table" and about["extraction"]["time_chunk"] == 2
    again = made(spark, source, path)
    assert again.refresh() == [] and again.load("trenches").count() == 6
    assert json.loads(json.dumps(again.store.params("trenches")["lane_params"])) == {"0": {"prominence": 40}}


@pytest.mark.parametrize("changes, gone", [
    ({"registration": {"downsample": 2}}, ["registration", "means", "lanes", "trenches"]), ({"means": {"channel": "mC"}}, ["means", "lanes", "trenches"]), ({"lanes": {"sigma": 2.0}}, ["lanes", "trenches"]),
    ({"trenches": {"trench_width": 8}}, ["trenches"]), ({"trenches": {"lane_params": {1: {"height": 1.0}}}}, ["trenches"]), ({}, []),
])
def test_a_change_resets_what_lies_behind_it(spark, source, tmp_path, changes, gone):
    path = f"{tmp_path}/s"
    first = made(spark, source, path)
    for stage, schema in analysis.SCHEMAS.items():
        first.store.save(stage, spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in schema.items())), first.params(stage))
    other = made(spark, source, path, **changes)
    assert [s for s in analysis.STAGES if other.state(s) == "other"] == gone
    assert other.refresh() == gone and [s for s in analysis.STAGES if other.state(s) == "missing"] == gone


def test_older_parameters(spark, source, tmp_path):
    run = made(spark, source, f"{tmp_path}/s")
    empty = spark.createDataFrame([], "fov string, t int, tx double, ty double")
    older = {k: v for k, v in run.params("registration").items() if k not in ("backend", "transform_convention", "upstream")}
    run.store.save("registration", empty, older)
    assert run.state("registration") == "ready" and run.load("registration").count() == 0
    run.store.save("registration", empty, older | {"rotation": 3.0})
    turned = made(spark, source, f"{tmp_path}/s", registration={"rotation": 3.0})
    assert turned.state("registration") == "other"
    with pytest.raises(ValueError, match="convention"):
        turned.load("registration")
    part = made(spark, source, f"{tmp_path}/s", experiment=run.experiment.discard_fovs(["XYPos:0"]))
    assert part.state("registration") == "other"
    with pytest.raises(ValueError, match="speed"):
        made(spark, source, f"{tmp_path}/s", lanes={"speed": 1})
    with pytest.raises(ValueError, match="channel"):
        made(spark, source, f"{tmp_path}/s", registration={"channel": "no"}).params("registration")


def test_discarded_trenches_leave_gaps(spark):
    table = spark.range(4).select(F.col("id").cast("int").alias("trench_id"))
    assert [(r.trench_id, r.slot) for r in trenches.slots(trenches.discard(table, [1])).orderBy("slot").collect()] == [(0, 0), (2, 1), (3, 2)]


def test_previews_of_one_frame_and_one_trench(spark, source, tmp_path):
    run = made(spark, source, f"{tmp_path}/s")
    with pytest.raises(RuntimeError, match="missing"):
        run.warp_frame()
    run.trench_table()
    frame = run.warp_frame(-1, 3).collect()
    assert [(r.fov, r.t, r.c) for r in frame] == [("XYPos:1", 3, "PC")]
    still, moved = np.array(frame[0].pixels).reshape(60, 80), scene(3, 1).astype(float)
    assert np.abs(still[:, :70] - moved[:, 3:73]).max() < 70  # found to within a tenth of a pixel
    stack = run.trench_stack(4, "mC").orderBy("t").collect()
    box = run.load("trenches").where("trench_id = 4").first()
    assert [(r.fov, r.t, r.c, r.h, r.w) for r in stack] == [("XYPos:1", t, "mC", 20, 9) for t in range(4)]
    cut = np.array(run.warp_frame("XYPos:1", 2, "mC").first().pixels).reshape(60, 80)[box.y_top : box.y_bottom, box.x_left : box.x_right]
    assert np.allclose(np.array(stack[2].pixels).reshape(20, 9), cut[::-1] if box.needs_flip else cut)
    with pytest.raises(ValueError, match="trench 99"):
        run.trench_stack(99)
    with pytest.raises(ValueError, match="position"):
        run.warp_frame("no")
    with pytest.raises(IndexError):
        run.warp_frame(0, 4)


def test_stages_take_the_first_focus_plane(spark, source, tmp_path):
    flat = experiment.load(spark, f"{source}/table").raw
    noise = F.transform("pixels", lambda v: (v * 7 + 3).cast("int") % 500).cast(flat.schema["pixels"].dataType)
    deep = experiment.Experiment("deep", experiment.with_axes(flat.withColumn("z", F.lit(0)).unionByName(flat.withColumns({"z": F.lit(1), "pixels": noise}))))
    assert deep.has_z and deep.focus_planes == 2
    crops = {}
    for name, changes in {"flat": {}, "deep": {"experiment": deep}}.items():
        run = made(spark, source, f"{tmp_path}/{name}", **changes)
        run.extract(f"{tmp_path}/{name}/crops", time_chunk=2)
        crops[name] = sorted((r.trench_id, r.t, r.c, list(r.pixels)) for r in chunks.read(spark, f"{tmp_path}/{name}/crops").collect())
        assert run.transforms().count() == 8 and run.trench_stack(0).count() == 4
    assert crops["deep"] == crops["flat"] and len(crops["flat"]) == 6 * 4 * 2
