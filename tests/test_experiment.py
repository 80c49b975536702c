"""Experiments: optional axes, selections, acquisition documents and stores beside the frames."""

import collections
import dataclasses
import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataframe.functions.plain import plain, without_nan
from strataframe.sources import experiment as ex
from strataframe.sources import frames

SCHEMA = "fov string, p_index int, t int, t_ms double, c string, h int, w int, pixels array<double>, pixel_um double"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two positions of one name, two times, two channels of 3 x 4 pixels."""
    path = str(tmp_path_factory.mktemp("cube") / "run.frames")
    rows = [("XYPos:0", p, t, t * 30000.0, c, 3, 4, [float(i + 100 * t + 10 * p + 1000 * k) for i in range(12)], 0.108) for p in range(2) for t in range(2) for k, c in enumerate(["PC", "mCherry"])]
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    return path


def test_names_counts_and_calibration(spark, folder):
    e = ex.load(spark, folder)
    assert e.name == "run" and e.fov_names == ["XYPos:0-01", "XYPos:0-02"] and e.channel_names == ["PC", "mCherry"]
    assert (e.timepoints, e.pixel_size_um, e.time_interval_ms) == (2, 0.108, 30000.0)
    assert e.has_channels and not e.has_z and e.focus_planes is None
    assert "P=2, T=2, C=2" in repr(e)
    with pytest.raises(FileNotFoundError):
        ex.load(spark, folder + ".none")


def test_selections_give_new_experiments(spark, folder):
    e = ex.load(spark, folder)
    one = e.select_fovs([1]).select_times(0, 1).select_times(-1, None).select_roi(y=(0, 2)).select_roi(x=(1, -1))
    assert e.frames.count() == 8 and e.discarded == ()
    rows = one.frames.orderBy("c").collect()
    assert [(r.fov, r.t, r.c, r.h, r.w, r.pixels) for r in rows] == [
        ("XYPos:0-02", 1, "PC", 2, 2, [111.0, 112.0, 115.0, 116.0]), ("XYPos:0-02", 1, "mCherry", 2, 2, [1111.0, 1112.0, 1115.0, 1116.0]),
    ]
    assert one.subset == {
        "raw_fov_names": ["XYPos:0-01", "XYPos:0-02"], "active_fov_names": ["XYPos:0-02"], "discarded_fov_names": ["XYPos:0-01"],
        "time_slice": {"start": -1, "stop": None, "step": None},
        "roi": {"y": {"start": 0, "stop": 2, "step": None}, "x": {"start": 1, "stop": -1, "step": None}},
        "raw_timepoint_count": 2, "active_timepoint_count": 1,
    }
    assert one.select_fovs(["XYPos:0-01"]).fov_names == []


def test_missing_axes(spark, tmp_path):
    bare = spark.createDataFrame([(1, 2, [1.0, 2.0])], "h int, w int, pixels array<double>")
    row = ex.with_axes(bare).first()
    assert (row.fov, row.p_index, row.t, row.c) == ("single", 0, 0, "single")
    bare.write.parquet(str(tmp_path / "bare"))
    e = ex.load(spark, str(tmp_path / "bare"))
    assert (e.fov_names, e.timepoints, e.has_channels, e.pixel_size_um, e.time_interval_ms) == (["single"], 1, False, 1.0, 0.0)
    numbered = ex.with_axes(bare.withColumn("p_index", F.lit(3))).first()
    assert (numbered.fov, numbered.p_index) == ("XYPos:3", 3)
    named = ex.with_axes(bare.withColumn("fov", F.explode(F.array(F.lit("b"), F.lit("a"))))).orderBy("p_index").collect()
    assert [(r.fov, r.p_index) for r in named] == [("a", 0), ("b", 1)]
    empty = ex.Experiment("none", ex.with_axes(bare.limit(0)))
    assert empty.fov_names == [] and empty.timepoints == 1 and empty.frames.count() == 0
    planes = ex.Experiment("z", ex.with_axes(bare.withColumn("z", F.lit(4))))
    assert planes.has_z and planes.focus_planes == 5 and "Z=5" in repr(planes) and planes.plane_step_um == 1
    apart = bare.withColumn("z", F.explode(F.array(*map(F.lit, (0, 1, 2))))).withColumn("z_um", F.col("z") * 0.4 + 7)
    stack = ex.Experiment("z", ex.with_axes(apart))
    assert abs(stack.plane_step_um - 0.4) < 1e-9 and stack.select_times(0, 1).times_left == range(0, 1)


def test_acquisition_document_and_table(spark, folder, tmp_path):
    e = ex.load(spark, folder)
    channels = [{"name": "PC", "exposure": 10, "gain": float("nan"), "pos": [1, 2]}, {"name": "", "exposure": 20, "on": True}]
    custom = {"StreamDataV1_0": {"b": 1}, "AppInfo_V1_0": {"v": np.int64(3)}}
    document = ex.acquisition_document(e, {"metadata": {"channels": channels}}, custom, {"z": 1, "a": 2})
    assert document["file_summary"]["sizes"] == {"T": 2, "P": 2, "C": 2, "Y": 3, "X": 4} and document["file_summary"]["shape"] == [2, 2, 2, 3, 4]
    assert document["file_summary"]["pixel_size_um"] == 0.108 and document["file_summary"]["source_size_bytes"] > 0
    assert document["file_summary"]["voxel_size_um"] == {"x": 0.108, "y": 0.108, "z": 1.0} and document["file_summary"]["is_legacy"] is False
    assert document["custom"]["custom_data_keys"] == ["AppInfo_V1_0", "StreamDataV1_0"] and document["custom"]["selected"] == {"AppInfo_V1_0": {"v": 3}}
    assert document["custom"]["unstructured_metadata_keys"] == ["a", "z"] and document["structured"]["experiment"] == []
    rows = ex.acquisition_table(spark, document, ["first", "second"]).orderBy("channel_index").collect()
    assert [(r.c, r.exposure) for r in rows] == [("first", 10), ("second", 20)] and "pos" not in rows[0]
    assert json.loads(rows[0].raw_json) == document
    assert [r.acquisition_channel for r in ex.acquisition_table(spark, document, ["only"]).orderBy("channel_index").collect()] == ["PC", "channel_1"]
    assert ex.acquisition_table(spark, {}).columns == ["raw_json"]
    (tmp_path / "run.json").write_text(json.dumps(document))
    again = ex.load(spark, folder, str(tmp_path / "run.json"))
    again.acquisition_metadata["file_summary"].clear()
    assert again.document == document


def test_store_beside_the_frames(spark, folder):
    e = ex.load(spark, folder)
    store = ex.open_store(e)
    born = store.attributes()
    assert store.path == folder.replace("run.frames", "run.strataframe") and born["source"] == folder and born["fov_names"] == e.fov_names
    later = ex.open_store(e.select_fovs([0])).attributes()
    assert later["created"] == born["created"] and later["fov_names"] == ["XYPos:0-01"] and later["source_subset_metadata"]["discarded_fov_names"] == ["XYPos:0-02"]
    store.save("registration", spark.range(3).toDF("t"), {"mode": "mean"})
    assert repr(store) == f"Store at {store.path} (complete: registration)"
    store.wipe()
    assert store.attributes() == later and not store.has("registration")
    assert Path(ex.diagnostics_folder(e)).is_dir() and ex.diagnostics_folder(e).endswith("/run_diagnostics")
    assert ex.store_summary(e, {"rotation": np.float64(0.5)})["registration_params"] == {"rotation": 0.5}


def test_plain_values():
    point = collections.namedtuple("Point", "x y")

    @dataclasses.dataclass
    class Box:
        at: object
        name: object

    value = {1: Box(point(np.int32(2), np.float32(0.5)), b"ok"), "p": Path("/a/b"), "l": (np.arange(2), {3}, None, True), "o": range(2)}
    assert plain(value) == {"1": {"at": {"x": 2, "y": 0.5}, "name": "ok"}, "p": "/a/b", "l": [[0, 1], [3], None, True], "o": "range(0, 2)"}
    assert without_nan({"a": [float("nan"), 1.0], "b": float("nan")}) == {"a": [None, 1.0], "b": None}


def test_ranks_of_blocks_are_ranks_of_the_whole(spark):
    ids = [None, -9, -1, 0, 5, 5, 16, 1 << 60, -(1 << 63), (1 << 63) - 1]
    table = spark.createDataFrame([(v, label) for v in ids for label in (1, 2)], "vec_id long, label int")
    for block in (1, 8, 1 << 16):
        for label in (1, 2):
            rows = frames._ranked(table, block).where(F.col("label") == label).orderBy("rank").collect()
            assert [r["rank"] for r in rows] == list(range(len(ids)))
            assert [r.vec_id for r in rows] == [None, *sorted(v for v in ids if v is not None)]


def test_positions_without_numbers_follow_their_names(spark, tmp_path):
    names = [f"XYPos:{i}" for i in range(12)]
    spark.createDataFrame([(n, t, 1, 1, [1.0]) for n in names for t in (0, 1)], "fov string, t int, h int, w int, pixels array<double>").write.parquet(f"{tmp_path}/e")
    whole = ex.load(spark, f"{tmp_path}/e")
    assert whole.fov_names == names
    part = whole.select_fovs([2, "XYPos:10"]).select_times(1, 2)
    assert part.fov_names == ["XYPos:2", "XYPos:10"] and {(r.fov, r.p_index) for r in part.frames.collect()} == {("XYPos:2", 2), ("XYPos:10", 10)}
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(part.frames._jdf.queryExecution(), "formatted")
    assert all("(fov" in line for line in plan.splitlines() if "PushedFilters" in line)


def test_selected_numbers_reach_the_scan_and_names_are_asked_once(spark, tmp_path, monkeypatch):
    rows = [("a", p, t, 1, 1, [1.0]) for p in range(3) for t in (0, 1)]
    spark.createDataFrame(rows, "fov string, p_index int, t int, h int, w int, pixels array<double>").write.parquet(f"{tmp_path}/e")
    whole = ex.load(spark, f"{tmp_path}/e")
    part = whole.select_fovs(["a-01", "a-03"]).discard_fovs(["a-03"])
    plan = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(part.frames._jdf.queryExecution(), "formatted")
    assert any("p_index" in line and ("In(" in line or "EqualTo" in line) for line in plan.splitlines() if "PushedFilters" in line)
    assert {(r.fov, r.p_index) for r in part.frames.collect()} == {("a-01", 0)}
    monkeypatch.setattr(type(whole.raw), "distinct", lambda self: 1 / 0)
    assert part.select_times(0, 1).select_roi(y=(0, 1)).fov_names == ["a-01"]


def test_records_of_odd_keys(spark):
    from strataframe.operators import metadata

    records = ['{"a.b": 1, "it\'s": true, "q\\"x": 2.5, "x y": {"k": 1}, "l": [1, 2], "big": 123456789012345678, "OBJECT<": "o", "a\'b\\"c": 3, "`t`": 1, "m": 1, "e": null}', '{"m": "x", "a.b": 2, "e": null, "big": 5}', "not json", None, "[1]", "{}"]
    for some in (records, records[2:]):
        table = spark.createDataFrame([(t,) for t in some], "json string")
        kinds = {r["key"]: r["type"] for r in metadata.key_types(table).collect()}
        if some is records:
            assert kinds == {"a.b": "int64", "it's": "bool", 'q"x': "float64", "x y": "string", "l": "string", "big": "int64", "OBJECT<": "string", "a'b\"c": "int64", "`t`": "int64", "m": "string", "e": "object"}
            rows = metadata.records_table(table, "").collect()
            assert (rows[0].x_y, rows[0].l, rows[0].m, rows[0].t, rows[0].a_b, rows[0].it_s, rows[0].a_b_c, rows[1].m, rows[1].big, rows[2].m, rows[2].a_b) == ('{"k":1}', "[1,2]", "1", 1, 1, True, 3, "x", 5, "", None)
        else:
            assert kinds == {} and metadata.records_table(table, "p").columns == []
