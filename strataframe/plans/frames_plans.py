"""Queries on frame stacks and their SQL.

The stack is the ``embeddings`` table: see ``sources.frames``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators import geometry, means, registration, selection
from ..sources import experiment, frames

#: The frames of the twin, and their pixels, as a SQL prefix.
FRAMES_SQL = """WITH fr AS (
 SELECT 'XYPos:' || CAST(label AS VARCHAR) AS fov, label AS p_index, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS INT) AS t, embedding
 FROM embeddings WHERE label IS NOT NULL),
px AS (SELECT fov, p_index, t, CAST((i - 1) // 8 AS INT) AS y, CAST((i - 1) % 8 AS INT) AS x, CAST(embedding[i] AS DOUBLE) AS v
 FROM fr, range(1, 65) r(i))
"""


def _stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.from_embeddings(spark, sf_dir)


def _pixels(stack: DataFrame) -> DataFrame:
    return frames.pixels(stack).select("fov", "t", "y", "x", (F.round("v", 6) + 0.0).alias("v"))  # no -0.0


def mean_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    return means.mean_image(_stack(spark, sf_dir), 10, "end").select("fov", "y", "x", F.round("v", 6).alias("v"))


def mean_image_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return means.mean_image(_stack(spark, sf_dir), 5, "start").select("fov", "y", "x", F.round("v", 6).alias("v"))


def row_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return means.row_profile(means.mean_image(_stack(spark, sf_dir), 10, "end")).select("fov", "y", F.round("profile", 6).alias("profile"))


def mean_after_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first ten frames of a part of the times, and the last two of every fifth: places among the frames that are left."""
    first = means.mean_image(selection.select_times(_stack(spark, sf_dir), 5, 20), 10, "start").withColumn("which", F.lit("first"))
    last = means.mean_image(_stack(spark, sf_dir).where("t % 5 = 0"), 2, "end").withColumn("which", F.lit("last"))
    return first.unionAll(last).select("which", "fov", "y", "x", F.round("v", 6).alias("v"))


def block_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames as they are registered: a region, as block means."""
    return _pixels(registration.prepared(_stack(spark, sf_dir), None, (1, -1), (0, 7), 2))


def downsample_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    small = means.downsample(frames.pixels(_stack(spark, sf_dir)), 3)
    return small.select("fov", "t", "y", "x", F.round("v", 6).alias("v"))


def select_fovs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = selection.select_fovs(selection.select_fovs(_stack(spark, sf_dir), ["XYPos:1", "XYPos:2", 5]), ["XYPos:2", 5, "none"])
    return kept.groupBy("fov").agg(F.count(F.lit(1)).alias("n_frames"))


def discard_fovs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.discard_fovs(_stack(spark, sf_dir), ["XYPos:0", "none"]).groupBy("fov").agg(F.count(F.lit(1)).alias("n_frames"))


def select_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.select_times(_stack(spark, sf_dir), 2, -3).groupBy("fov").agg(F.min("t").alias("first_t"), F.max("t").alias("last_t"))


def experiment_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An experiment's frames under all four selections; of two selections of times the last counts."""
    whole = experiment.Experiment(f"{sf_dir}/embeddings.parquet", experiment.with_axes(_stack(spark, sf_dir)))
    part = whole.discard_fovs(["XYPos:0"]).select_times(0, 2).select_times(1, -2).select_fovs([1, 2, "XYPos:4"]).select_roi(y=(1, 3))
    return _pixels(part.frames)


def select_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(selection.select_roi(_stack(spark, sf_dir), (2, -1), (1, 5)))


def single_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pixels(_stack(spark, sf_dir).where((F.col("fov") == "XYPos:3") & (F.col("t") == 4)))


def strided_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.strided(_stack(spark, sf_dir), 0, 40, 20).select("fov", "t")


def sequence_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = selection.sequence_index({"T": 1000, "P": 10, "Z": 3}, {"T": F.col("t"), "P": F.col("p_index")})
    return _stack(spark, sf_dir).select("fov", "t", place.alias("seq"))


def previous_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("fov").orderBy("t")
    return _stack(spark, sf_dir).select("fov", "t", F.lag("t").over(order).alias("previous_t")).where("previous_t is not null")


def flipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = _stack(spark, sf_dir)
    return _pixels(stack.withColumn("pixels", geometry.flip_rows(F.col("pixels"), F.col("w"))))


def kymograph(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = geometry.kymograph(frames.pixels(_stack(spark, sf_dir)), 0, 30, 10)
    return rows.select("fov", "y", F.posexplode("row").alias("place", "v")).select("fov", "y", "place", F.round("v", 6).alias("v"))


def _shifts(stack: DataFrame) -> DataFrame:
    """Made-up drifts of known size."""
    return stack.select("fov", "t", (F.col("t") % 5 * 0.25 - 0.5).alias("tx"), (F.col("p_index") % 4 * 0.5 - 0.75).alias("ty"))


def warped(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = _stack(spark, sf_dir)
    return _pixels(geometry.warp(stack, _shifts(stack)))


def warped_rotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = _stack(spark, sf_dir)
    return _pixels(geometry.warp(stack, _shifts(stack), 10.0))


def _steps(stack: DataFrame) -> DataFrame:
    """Made-up matrices of small rotations, scales and shifts."""
    angle, scale = (F.col("t") % 5 - 2) * 0.01, 1 + (F.col("p_index") % 3 - 1) * 0.002
    six = scale * F.cos(angle), -F.sin(angle), F.col("t") % 3 - 1.0, F.sin(angle), scale * F.cos(angle), F.col("p_index") % 4 * 0.5
    return stack.select("fov", "t", *(c.alias(n) for c, n in zip(six, geometry.NAMES, strict=True)))


def warped_affine(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = _stack(spark, sf_dir)
    return _pixels(geometry.warp(stack, _steps(stack)))


def cumulative_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = geometry.cumulated_matrices(_steps(_stack(spark, sf_dir)), 16)
    return found.select("fov", "t", *((F.round(n, 6) + 0.0).alias(n) for n in geometry.NAMES))


def positions_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions without numbers, of which two are chosen by their place in the order of names."""
    named = _stack(spark, sf_dir).select(F.concat(F.lit("XYPos:"), F.col("p_index") + 5).alias("fov"), "t", "h", "w", "pixels")
    whole = experiment.Experiment(f"{sf_dir}/embeddings.parquet", experiment.with_axes(named))
    return whole.select_fovs([2, 7]).frames.groupBy("fov", "p_index").agg(F.count(F.lit(1)).alias("n_frames"))


def registered_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = means.edge_frames(_stack(spark, sf_dir), 10, "end")
    return means.mean_image(geometry.warp(stack, _shifts(stack)), 10, "end").select("fov", "y", "x", F.round("v", 6).alias("v"))


def rotation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = geometry.compose(geometry.translation(F.col("tx"), F.col("ty")), geometry.rotation(10.0, F.lit(8), F.lit(8)))
    names = ["m00", "m01", "m02", "m10", "m11", "m12"]
    return _shifts(_stack(spark, sf_dir)).select("fov", "t", *(F.round(c, 9).alias(n) for c, n in zip(m, names, strict=True)))


def alignment_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = _stack(spark, sf_dir)
    return geometry.unmatched(stack, _shifts(stack).where("t <> 3"))


def register_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registration.register(_stack(spark, sf_dir), "mean", "least_squares")


def register_phase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registration.register(_stack(spark, sf_dir), "first", "phase")


def register_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registration.register(_stack(spark, sf_dir), "previous", "least_squares")


_LAST = "(SELECT fov, max(t) AS last FROM fr GROUP BY fov)"
_SHIFTS = ", sh AS (SELECT fov, t, t % 5 * 0.25::DOUBLE - 0.5::DOUBLE AS tx, p_index % 4 * 0.5::DOUBLE - 0.75::DOUBLE AS ty FROM fr)"
#: Rotation by 10 degrees about (3.5, 3.5), after the translation.
_ROTATED = """, mt AS (SELECT fov, t, cos(radians(10)) AS m00, -sin(radians(10)) AS m01, 3.5 - cos(radians(10)) * 3.5 + sin(radians(10)) * 3.5 + tx AS m02,
 sin(radians(10)) AS m10, cos(radians(10)) AS m11, 3.5 - sin(radians(10)) * 3.5 - cos(radians(10)) * 3.5 + ty AS m12 FROM sh)"""
_PLAIN = ", mt AS (SELECT fov, t, 1.0::DOUBLE AS m00, 0.0::DOUBLE AS m01, tx AS m02, 0.0::DOUBLE AS m10, 1.0::DOUBLE AS m11, ty AS m12 FROM sh)"
_WARP = """, o AS (SELECT fov, t, y, x, m10 * x + m11 * y + m12 AS sy, m00 * x + m01 * y + m02 AS sx FROM mt, range(8) a(y), range(8) b(x)),
q AS (SELECT *, CAST(floor(sy) AS INT) AS y0, CAST(floor(sx) AS INT) AS x0, sy - floor(sy) AS fy, sx - floor(sx) AS fx FROM o),
wp AS (SELECT q.fov, q.t, CAST(q.y AS INT) AS y, CAST(q.x AS INT) AS x, (coalesce(a.v, 0) * (1 - fx) + coalesce(b.v, 0) * fx) * (1 - fy) + (coalesce(c.v, 0) * (1 - fx) + coalesce(d.v, 0) * fx) * fy AS v FROM q
 LEFT JOIN px a ON a.fov = q.fov AND a.t = q.t AND a.y = y0 AND a.x = x0 LEFT JOIN px b ON b.fov = q.fov AND b.t = q.t AND b.y = y0 AND b.x = x0 + 1
 LEFT JOIN px c ON c.fov = q.fov AND c.t = q.t AND c.y = y0 + 1 AND c.x = x0 LEFT JOIN px d ON d.fov = q.fov AND d.t = q.t AND d.y = y0 + 1 AND d.x = x0 + 1)
"""

_STEPS = """, st AS (SELECT fov, t, (1 + (p_index % 3 - 1) * 0.002::DOUBLE) * cos((t % 5 - 2) * 0.01::DOUBLE) AS m00, -sin((t % 5 - 2) * 0.01::DOUBLE) AS m01, t % 3 - 1.0::DOUBLE AS m02,
 sin((t % 5 - 2) * 0.01::DOUBLE) AS m10, (1 + (p_index % 3 - 1) * 0.002::DOUBLE) * cos((t % 5 - 2) * 0.01::DOUBLE) AS m11, p_index % 4 * 0.5::DOUBLE AS m12 FROM fr)"""
_SIX = ", ".join(f"round({n}, 6) + 0.0::DOUBLE AS {n}" for n in geometry.NAMES)
_PRODUCTS = """, cm(fov, t, m00, m01, m02, m10, m11, m12) AS (SELECT fov, t, 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM st WHERE t = 0
 UNION ALL SELECT s.fov, s.t, c.m00 * s.m00 + c.m01 * s.m10, c.m00 * s.m01 + c.m01 * s.m11, c.m00 * s.m02 + c.m01 * s.m12 + c.m02, c.m10 * s.m00 + c.m11 * s.m10, c.m10 * s.m01 + c.m11 * s.m11, c.m10 * s.m02 + c.m11 * s.m12 + c.m12
 FROM cm c JOIN st s ON s.fov = c.fov AND s.t = c.t + 1)"""

PLANS = {
    "mean_image": (mean_image, FRAMES_SQL + f"SELECT fov, y, x, round(avg(v), 6) AS v FROM px JOIN {_LAST} l USING (fov) WHERE t > last - 10 GROUP BY fov, y, x"),
    "mean_image_start": (mean_image_start, FRAMES_SQL + "SELECT fov, y, x, round(avg(v), 6) AS v FROM px WHERE t < 5 GROUP BY fov, y, x"),
    "row_profile": (row_profile, FRAMES_SQL + f", m AS (SELECT fov, y, x, avg(v) AS v FROM px JOIN {_LAST} l USING (fov) WHERE t > last - 10 GROUP BY fov, y, x) SELECT fov, y, round(avg(v), 6) AS profile FROM m GROUP BY fov, y"),
    "mean_after_subset": (mean_after_subset, FRAMES_SQL + "SELECT 'first' AS which, fov, y, x, round(avg(v), 6) AS v FROM px WHERE t >= 5 AND t < 15 GROUP BY fov, y, x UNION ALL SELECT 'last', fov, y, x, round(avg(v), 6) FROM px JOIN (SELECT fov, t, row_number() OVER (PARTITION BY fov ORDER BY t DESC) AS n FROM fr WHERE t % 5 = 0) l USING (fov, t) WHERE n <= 2 GROUP BY fov, y, x"),
    "block_means": (block_means, FRAMES_SQL + "SELECT fov, t, CAST((y - 1) // 2 AS INT) AS y, CAST(x // 2 AS INT) AS x, round(avg(v), 6) AS v FROM px WHERE y >= 1 AND y < 7 AND x < 6 GROUP BY fov, t, (y - 1) // 2, x // 2"),
    "downsample_mean": (downsample_mean, FRAMES_SQL + "SELECT fov, t, y // 3 AS y, x // 3 AS x, round(avg(v), 6) AS v FROM px WHERE y < 6 AND x < 6 GROUP BY fov, t, y // 3, x // 3"),
    "select_fovs": (select_fovs, FRAMES_SQL + "SELECT fov, count(*) AS n_frames FROM fr WHERE fov IN ('XYPos:2', 'XYPos:5') GROUP BY fov"),
    "discard_fovs": (discard_fovs, FRAMES_SQL + "SELECT fov, count(*) AS n_frames FROM fr WHERE fov <> 'XYPos:0' GROUP BY fov"),
    "select_times": (select_times, FRAMES_SQL + "SELECT fov, min(t) AS first_t, max(t) AS last_t FROM fr, (SELECT max(t) + 1 AS n FROM fr) WHERE t >= 2 AND t < n - 3 GROUP BY fov"),
    "experiment_frames": (experiment_frames, FRAMES_SQL + ", ps AS (SELECT fov, row_number() OVER (ORDER BY p_index) - 1 AS place FROM (SELECT DISTINCT fov, p_index FROM fr)) SELECT px.fov, t, y - 1 AS y, x, round(v, 6) AS v FROM px JOIN ps ON ps.fov = px.fov, (SELECT max(t) + 1 AS n FROM fr) WHERE (place IN (1, 2) OR px.fov = 'XYPos:4') AND px.fov <> 'XYPos:0' AND t >= 1 AND t < n - 2 AND y >= 1 AND y < 3"),
    "select_roi": (select_roi, FRAMES_SQL + "SELECT fov, t, y - 2 AS y, x - 1 AS x, round(v, 6) AS v FROM px WHERE y >= 2 AND y < 7 AND x >= 1 AND x < 5"),
    "single_frame": (single_frame, FRAMES_SQL + "SELECT fov, t, y, x, round(v, 6) AS v FROM px WHERE fov = 'XYPos:3' AND t = 4"),
    "strided_times": (strided_times, FRAMES_SQL + "SELECT fov, t FROM fr WHERE t IN (0, 20)"),
    "sequence_index": (sequence_index, FRAMES_SQL + "SELECT fov, t, CAST(t * 30 + p_index * 3 AS BIGINT) AS seq FROM fr"),
    "previous_pairs": (previous_pairs, FRAMES_SQL + "SELECT fov, t, t - 1 AS previous_t FROM fr WHERE t > 0"),
    "flipped": (flipped, FRAMES_SQL + "SELECT fov, t, 7 - y AS y, x, round(v, 6) AS v FROM px"),
    "kymograph": (kymograph, FRAMES_SQL + "SELECT fov, y, CAST(row_number() OVER (PARTITION BY fov, y ORDER BY t, x) - 1 AS INT) AS place, round(v, 6) AS v FROM px WHERE t IN (0, 10, 20)"),
    "warped": (warped, FRAMES_SQL + _SHIFTS + _PLAIN + _WARP + "SELECT fov, t, y, x, round(v, 6) + 0.0::DOUBLE AS v FROM wp"),
    "warped_rotated": (warped_rotated, FRAMES_SQL + _SHIFTS + _ROTATED + _WARP + "SELECT fov, t, y, x, round(v, 6) + 0.0::DOUBLE AS v FROM wp"),
    "warped_affine": (warped_affine, FRAMES_SQL + _STEPS.replace(", st AS", ", mt AS") + _WARP + "SELECT fov, t, y, x, round(v, 6) + 0.0::DOUBLE AS v FROM wp"),
    "cumulative_matrices": (cumulative_matrices, FRAMES_SQL.replace("WITH fr", "WITH RECURSIVE fr") + _STEPS + _PRODUCTS + f"SELECT fov, t, {_SIX} FROM cm"),
    "positions_by_name": (positions_by_name, FRAMES_SQL + ", o AS (SELECT p_index + 5 AS n, row_number() OVER (ORDER BY p_index) - 1 AS place, count(*) AS n_frames FROM fr GROUP BY p_index) SELECT 'XYPos:' || n AS fov, CAST(place AS INT) AS p_index, n_frames FROM o WHERE place IN (2, 7)"),
    "registered_mean": (registered_mean, FRAMES_SQL + _SHIFTS + _PLAIN + _WARP + f"SELECT fov, y, x, round(avg(v), 6) AS v FROM wp JOIN {_LAST} l USING (fov) WHERE t > last - 10 GROUP BY fov, y, x"),
    "rotation_matrix": (rotation_matrix, FRAMES_SQL + _SHIFTS + _ROTATED + "SELECT fov, t, round(m00, 9) AS m00, round(m01, 9) AS m01, round(m02, 9) AS m02, round(m10, 9) AS m10, round(m11, 9) AS m11, round(m12, 9) AS m12 FROM mt"),
    "alignment_errors": (alignment_errors, FRAMES_SQL + "SELECT fov, t FROM fr WHERE t = 3"),
    "register_mean": (register_mean, None),
    "register_phase": (register_phase, None),
    "register_previous": (register_previous, None),
}
