"""Queries on references, registration by known shifts, channels, stores and experiments, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.names import canonical_json
from ..operators import geometry, means, registration, selection, trenches
from ..sources import analysis, chunks, experiment, frames, store
from .frames_plans import FRAMES_SQL, _PLAIN, _SHIFTS, _WARP, _pixels, _shifts, _stack
from .table_plans import BOXES_SQL, _boxes

#: The side of the frames made for registration, and the spread of their spots.
_SIDE, _SPREAD = 32, 3.0


def reference_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The images that frames are registered to: the mean of all, the first, the last, and one by its number."""
    stack, found = _stack(spark, sf_dir), None
    for mode in ("mean", "first", "last", 2):
        own = means.reference(stack, mode).select(F.lit(str(mode)).alias("mode"), "fov", F.lit(8).alias("w"), F.col("reference").alias("pixels"))
        found = own if found is None else found.unionByName(own)
    return frames.pixels(found).select("mode", "fov", "y", "x", (F.round("v", 6) + 0.0).alias("v"))


def _moved(stack: DataFrame) -> DataFrame:
    """Every frame as three spots of its position, moved by a known shift, with its own pixels as noise."""
    i = F.sequence(F.lit(0), F.lit(_SIDE * _SIDE - 1))
    dy, dx = F.col("t") % 3 * 0.5 - 0.5, F.col("t") % 5 * 0.5 - 1.0
    spots = [(9.0 + k * 6, 11 + (F.col("p_index") + k * 5) % 7 + 2 * k, 60.0 + 20 * k) for k in range(3)]

    def value(at: Column) -> Column:
        y, x = F.floor(at / _SIDE), at % _SIDE
        out = F.element_at("pixels", (y % 8 * 8 + x % 8 + 1).cast("int")) * 0.01
        for cy, cx, height in spots:
            out = out + height * F.exp(-((y - cy - dy) * (y - cy - dy) + (x - cx - dx) * (x - cx - dx)) / (2 * _SPREAD * _SPREAD))
        return out

    return stack.withColumn("pixels", F.transform(i, value)).withColumns({"h": F.lit(_SIDE), "w": F.lit(_SIDE)})


def known_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Translations found by every kind of reference and both backends, to the nearest half of a pixel."""
    moved, found = _moved(_stack(spark, sf_dir)), None
    for mode, backend in (("first", "least_squares"), ("last", "phase"), (3, "least_squares"), ("previous", "least_squares")):
        own = registration.register(moved, mode, backend).withColumn("mode", F.lit(str(mode)))
        found = own if found is None else found.unionByName(own)
    return found.select("mode", "fov", "t", *((F.round(F.col(c) * 2) / 2 + 0.0).alias(c) for c in ("tx", "ty")))


def drift_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drifts by the hour."""
    stack = _stack(spark, sf_dir)
    return registration.drift(_shifts(stack), stack).select("fov", "t", F.round("hours", 9).alias("hours"), "tx", "ty")


def channel_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of two channels in one table: those of the last channel by its place, and those that are registered where none is named."""
    phase = _stack(spark, sf_dir).withColumn("c", F.lit("phase"))
    both = phase.unionByName(phase.withColumns({"c": F.lit("green"), "pixels": geometry.flip_rows(F.col("pixels"), F.col("w"))}))
    last = selection.resolve(-1, experiment.Experiment("", experiment.with_axes(both)).channel_names)
    chosen = registration.one_channel(both, last).withColumn("which", F.lit("last")).unionByName(registration.one_channel(both).withColumn("which", F.lit("unnamed")))
    return frames.pixels(selection.existing(chosen, ["which", "fov", "t", "c", "z", "w", "pixels"])).select("which", "fov", "t", "c", "y", "x", (F.round("v", 6) + 0.0).alias("v"))


def spaced_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven times at equal distances over an experiment, of every position."""
    whole = experiment.Experiment("", experiment.with_axes(_stack(spark, sf_dir)))
    return whole.frames.where(F.col("t").isin(selection.evenly_spaced(whole.timepoints, 7))).select("fov", "t")


def subset_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an experiment's selections leave, as canonical JSON."""
    whole = experiment.Experiment(f"{sf_dir}/embeddings.parquet", experiment.with_axes(_stack(spark, sf_dir)))
    part = whole.discard_fovs(["XYPos:3", "none"]).select_times(1, -2).select_roi(y=(1, None))
    row = (part.name, part.time_interval_ms, part.pixel_size_um, part.has_z, part.has_channels, canonical_json(part.subset))
    return spark.createDataFrame([row], "name string, time_interval_ms double, pixel_size_um double, has_z boolean, has_channels boolean, subset string")


def _own_boxes(stack: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trenches of positions that have frames."""
    return _boxes(spark, sf_dir).join(stack.select("fov").distinct(), "fov", "left_semi")


def stored_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transforms and trenches saved as stages of a store with parameters, and read back; a stage behind a reset one is gone."""
    stack = _stack(spark, sf_dir)
    kept = store.Store(spark, store.scratch(spark))
    boxes, settings = _own_boxes(stack, spark, sf_dir), {"trench_width": 3, "lane_params": {1: {"sigma": 0.5}}}
    kept.save("registration", _shifts(stack), {"mode": "mean"})
    kept.save("means", stack.select("fov").distinct(), {})
    kept.save("trenches", boxes.where("trench_id < 0"), {})
    kept.reset("means")
    state = ",".join(s for s in store.SECTIONS if kept.has(s))
    kept.save("trenches", boxes, settings)
    state += f";{kept.matches('trenches', settings)};{kept.matches('trenches', {})}"
    moved = kept.load("registration").withColumn("mode", F.lit(kept.params("registration")["mode"]))
    found = kept.load("trenches").select("fov", "trench_id", F.lit(canonical_json(kept.params("trenches"))).alias("params"))
    return found.join(moved, "fov").select("trench_id", "t", "tx", "ty", "mode", "params", F.lit(state).alias("state"))


def extracted_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops of all trenches written to a store with the metadata of their frames, gone on with once it is whole, and a part of the times read back."""
    stack = _stack(spark, sf_dir)
    boxes, path = _own_boxes(stack, spark, sf_dir), store.scratch(spark)
    for _ in range(2):  # the second call finds every position written
        written = store.extract(stack, _shifts(stack), boxes, path, time_chunk=8, dtype="float64", groups={"source_frames": stack.select("fov", "t", "t_ms")}, settings={"rotation": 0})
    found = chunks.read(spark, path, start=6, end=43).join(store.read_group(spark, path, "source_frames"), ["fov", "t"])
    rows = frames.pixels(found.withColumn("missing", F.lit(len(written))))
    return rows.select("trench_id", "t", "t_ms", "missing", "y", "x", F.round("v", 6).alias("v"))


def analysis_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From an analysis whose stages are stored: the last position's fourth frame, the first and the last trench; and what another setting of lanes makes undone."""
    stack = _stack(spark, sf_dir)
    whole, kept = experiment.Experiment("", experiment.with_axes(stack)), store.Store(spark, store.scratch(spark))
    run, boxes = analysis.Analysis(whole, kept), _own_boxes(stack, spark, sf_dir)
    nothing = spark.createDataFrame([], ", ".join(f"{c} {kind}" for c, kind in (analysis.SCHEMAS["means"] | analysis.SCHEMAS["lanes"]).items()))
    for stage, table in {"registration": _shifts(stack), "means": nothing, "lanes": nothing, "trenches": boxes}.items():
        kept.save(stage, table, run.params(stage))
    ends = kept.load("trenches").agg(F.min("trench_id").alias("first"), F.max("trench_id").alias("last")).first()
    found = run.warp_frame(-1, 3).select(F.lit("frame").alias("which"), "t", "w", "pixels")
    for which, trench in ends.asDict().items():
        found = found.unionByName(run.trench_stack(trench).select(F.lit(which).alias("which"), "t", "w", "pixels"))
    other = analysis.Analysis(whole, kept, lanes={"sigma": 2.0})
    undone = ",".join(stage for stage in analysis.STAGES if other.state(stage) != "ready")
    return frames.pixels(found).select("which", "t", "y", "x", F.round("v", 6).alias("v"), F.lit(undone).alias("undone"))


def acquisition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of events as the channels of an acquisition document: a typed column a scalar, objects left out, names of the experiment."""
    kinds = spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("user_id").alias("last"))
    channels = [{"name": r.event_type, "frameCount": r.n, "last user": r.last, "half": r.n / 2, "isMany": r.n > 10, "optics": {"n": r.n}} for r in kinds.orderBy("event_type").collect()]
    channels[0]["mode"] = "first"
    table = experiment.acquisition_table(spark, {"structured": {"metadata": {"channels": channels}}}, [c["name"].upper() for c in channels])
    return table.drop("raw_json")


def cut_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bytes that the crops of each position take, from the shape that all trenches have."""
    boxes = _boxes(spark, sf_dir)
    height, width = trenches.uniform_shape(boxes)
    return boxes.groupBy("fov").agg((F.count(F.lit(1)) * height * width * 2).alias("n_bytes"))


_KNOWN = """, k AS (SELECT fov, t, t % 5 * 0.5::DOUBLE - 1 AS x, t % 3 * 0.5::DOUBLE - 0.5 AS y FROM fr),
rf AS (SELECT 'first' AS mode, fov, min(t) AS t FROM k GROUP BY fov UNION ALL SELECT 'previous', fov, min(t) FROM k GROUP BY fov UNION ALL SELECT 'last', fov, max(t) FROM k GROUP BY fov UNION ALL SELECT '3', fov, 3 FROM k GROUP BY fov)
SELECT rf.mode, k.fov, k.t, k.x - r.x AS tx, k.y - r.y AS ty FROM k JOIN rf USING (fov) JOIN k r ON r.fov = rf.fov AND r.t = rf.t"""
_CUT = "CASE WHEN needs_flip THEN y_bottom - 1 - y ELSE y - y_top END AS y, x - x_left AS x, round(v, 6) AS v FROM wp JOIN bx USING (fov) WHERE x >= x_left AND x < x_right AND y >= y_top AND y < y_bottom"
_ALL = "(SELECT max(t) + 1 AS n FROM fr)"

PLANS = {
    "reference_images": (reference_images, FRAMES_SQL + """, lt AS (SELECT fov, max(t) AS last FROM fr GROUP BY fov) SELECT 'mean' AS mode, fov, y, x, round(avg(v), 6) + 0.0::DOUBLE AS v FROM px GROUP BY fov, y, x
 UNION ALL SELECT m.mode, px.fov, y, x, round(v, 6) + 0.0::DOUBLE FROM px JOIN lt USING (fov) JOIN (VALUES ('first'), ('last'), ('2')) m(mode) ON px.t = CASE m.mode WHEN 'first' THEN 0 WHEN 'last' THEN last ELSE 2 END"""),
    "known_shifts": (known_shifts, FRAMES_SQL + _KNOWN),
    "drift_series": (drift_series, FRAMES_SQL + _SHIFTS + "SELECT fov, t, round(t * 30000.0::DOUBLE / 3600000.0::DOUBLE, 9) AS hours, tx, ty FROM sh"),
    "channel_frames": (channel_frames, FRAMES_SQL + "SELECT 'last' AS which, fov, t, 'phase' AS c, y, x, round(v, 6) + 0.0::DOUBLE AS v FROM px UNION ALL SELECT 'unnamed', fov, t, 'green', 7 - y, x, round(v, 6) + 0.0::DOUBLE FROM px"),
    "spaced_frames": (spaced_frames, FRAMES_SQL + f"SELECT fov, t FROM fr WHERE t IN (SELECT i * (n - 1) // 6 FROM {_ALL}, range(7) r(i))"),
    "subset_document": (subset_document, FRAMES_SQL + """, ps AS (SELECT p_index, '"' || fov || '"' AS name, max(t) AS last FROM fr GROUP BY fov, p_index)
 SELECT 'embeddings' AS name, 30000.0::DOUBLE AS time_interval_ms, 1.0::DOUBLE AS pixel_size_um, false AS has_z, false AS has_channels, '{"active_fov_names":[' || string_agg(name, ',' ORDER BY p_index) FILTER (p_index <> 3) || '],"active_timepoint_count":' || (max(last) - 2) || ',"discarded_fov_names":["XYPos:3","none"],"raw_fov_names":['
 || string_agg(name, ',' ORDER BY p_index) || '],"raw_timepoint_count":' || (max(last) + 1) || ',"roi":{"x":null,"y":{"start":1,"step":null,"stop":null}},"time_slice":{"start":1,"step":null,"stop":-2}}' AS subset FROM ps"""),
    "stored_stages": (stored_stages, FRAMES_SQL + _SHIFTS + BOXES_SQL + """SELECT trench_id, t, tx, ty, 'mean' AS mode, '{"lane_params":{"1":{"sigma":0.5}},"trench_width":3}' AS params, 'registration;True;False' AS state FROM bx JOIN sh USING (fov)"""),
    "extracted_store": (extracted_store, FRAMES_SQL + _SHIFTS + _PLAIN + _WARP + BOXES_SQL + f"SELECT trench_id, t, t * 30000.0::DOUBLE AS t_ms, 0 AS missing, {_CUT} AND t >= 6 AND t < 43"),
    "analysis_previews": (analysis_previews, FRAMES_SQL + _SHIFTS + _PLAIN + _WARP + BOXES_SQL + f""", own AS (SELECT * FROM bx WHERE fov IN (SELECT fov FROM fr)),
ends AS (SELECT 'first' AS which, min(trench_id) AS trench_id FROM own UNION ALL SELECT 'last', max(trench_id) FROM own)
SELECT which, t, {_CUT.replace("FROM wp JOIN bx USING (fov)", ", 'lanes,trenches' AS undone FROM wp JOIN own USING (fov) JOIN ends USING (trench_id)")}
UNION ALL SELECT 'frame', t, y, x, round(v, 6), 'lanes,trenches' FROM wp WHERE t = 3 AND fov = (SELECT 'XYPos:' || max(p_index) FROM fr)"""),
    "acquisition_columns": (acquisition_columns, """SELECT CAST(row_number() OVER (ORDER BY event_type) - 1 AS INT) AS channel_index, upper(event_type) AS c, count(*) AS frame_count, count(*) / 2 AS half, count(*) > 10 AS is_many,
 max(user_id) AS last_user, CASE WHEN row_number() OVER (ORDER BY event_type) = 1 THEN 'first' ELSE '' END AS mode FROM events GROUP BY event_type"""),
    "cut_shapes": (cut_shapes, "WITH " + BOXES_SQL.lstrip(", ") + "SELECT fov, count(*) * 18 AS n_bytes FROM bx GROUP BY fov"),
}
