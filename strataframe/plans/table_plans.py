"""Queries on events, labels and trenches and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import names
from ..operators import geometry, means, metadata, selection, signal, trenches
from ..sources import chunks, frames, store
from .frames_plans import FRAMES_SQL, _SHIFTS, _PLAIN, _WARP, _shifts


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rename_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.rename_duplicates(_read(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_name", "p_partkey")


def ordered_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.ordered_distinct(_read(spark, sf_dir, "part"), "p_type", "p_partkey")


def intersect_roi(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = _read(spark, sf_dir, "part")
    a = (F.col("p_size") % 7, F.when(F.col("p_size") % 3 == 0, -1).otherwise(F.col("p_size") + 5))
    start, stop = selection.intersect_roi(F.lit(40), a, (F.lit(3), F.lit(None).cast("int")))
    return part.select("p_partkey", start.cast("int").alias("start"), stop.cast("int").alias("stop"))


def snake_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select("p_partkey", names.snake_column(F.concat(F.lit("2nd µ"), F.col("p_type"), F.lit("-maxSize "), F.col("p_brand"))).alias("name"))


def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    first = orders.orderBy("o_orderkey").limit(2)
    times = first.select((F.row_number().over(Window.orderBy("o_orderkey")) - 1).alias("i"), F.col("o_totalprice").alias("at"))
    return selection.calibration(times, "i", "at", 0.0).select(F.round("step", 6).alias("step"))


def time_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    out = _read(spark, sf_dir, "events").select("event_id", "user_id", (ms - F.lag(ms).over(order)).alias("step_ms"))
    return out.where("step_ms is not null")


def cumulative_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    steps = _read(spark, sf_dir, "events").select(F.col("user_id").alias("fov"), (F.row_number().over(order) - 1).alias("t"), F.col("value").alias("tx"), (-F.col("value")).alias("ty"))
    steps = steps.withColumns({k: F.when(F.col("t") > 0, F.col(k)) for k in ("tx", "ty")})
    return geometry.scaled(geometry.cumulated(steps), 4).select("fov", "t", F.round("tx", 4).alias("tx"), F.round("ty", 4).alias("ty"))


def event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.key_types(_read(spark, sf_dir, "events").select(F.col("props").alias("json")))


def events_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    is_frame = F.col("event_type") != "error"
    record = F.when(is_frame, F.to_json(F.struct(F.col("event_id").alias("Index"), (F.col("user_id") % 6).alias("P Index"), (F.col("event_id") % 9).alias("T Index")))).otherwise(F.to_json(F.struct(F.col("event_id").alias("Time"))))
    fovs = spark.range(2, 5).select(F.col("id").cast("int").alias("p_index"))
    times = spark.range(0, 4).select(F.col("id").cast("int").alias("t"))
    kept, other = metadata.split_events(events.select("event_id", record.alias("json")), fovs, times)
    return kept.select("event_id", F.lit("frame").alias("kind")).unionAll(other.select("event_id", F.lit("acquisition").alias("kind")))


def source_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = frames.from_embeddings(spark, sf_dir)
    times = stack.select("t").distinct()
    fovs = stack.select("fov", "p_index").distinct()
    document = F.format_string('{"channels":[{"time":{"relativeTimeMs":%d},"position":{"name":"%s","stagePositionUm":[%d,%d,%d]}}]}', F.col("t") * 30000 + F.col("p_index"), F.col("fov"), F.col("p_index") + 100, F.col("t") + 200, F.col("t") + F.col("p_index"))
    read = metadata.source_frames(fovs, times, stack.select("p_index", "t", document.alias("json")))
    return read.select("fov", "t", "relative_time_ms", F.col("stage_position_um.x").alias("stage_x"), F.col("stage_position_um.y").alias("stage_y"), "position_name")


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of events by bucket of 720 events, as profiles: one of each type in each 7,200 events."""
    name = F.concat_ws(":", "event_type", F.expr("event_id div 7200").cast("string"))
    events = _read(spark, sf_dir, "events").select(name.alias("fov"), F.floor(F.col("event_id") % 720 / 6).cast("int").alias("x"))
    counts = events.groupBy("fov", "x").agg(F.count(F.lit(1)).cast("double").alias("profile"))
    grid = counts.select("fov").distinct().withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(119))))
    full = grid.join(counts, ["fov", "x"], "left").fillna(0.0, ["profile"])
    return signal.as_array(full, ["fov"], "x")


def smoothed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _profile(spark, sf_dir).select("fov", F.posexplode(signal.gaussian_smooth(F.col("profile"), 3.0)).alias("x", "v"))
    return rows.select("fov", "x", F.round("v", 6).alias("v"))


def convolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _profile(spark, sf_dir).select("fov", F.posexplode(signal.convolve(F.col("profile"), [1.0, 2.0, 1.0])).alias("x", "v"))
    return rows.select("fov", "x", F.round("v", 6).alias("v"))


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal.find_peaks(_profile(spark, sf_dir), ["fov"], height=1.0, prominence=2.0)


def peaks_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    smooth = _profile(spark, sf_dir).withColumn("profile", signal.gaussian_smooth(F.col("profile"), 2.0))
    return signal.find_peaks(smooth, ["fov"], distance=8, prominence=0.1).withColumn("value", F.round("value", 6))


def user_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peaks of the values of every user's events, in their order."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    events = _read(spark, sf_dir, "events").select("user_id", (F.row_number().over(order) - 1).alias("x"), F.col("value").alias("profile"))
    return signal.find_peaks(signal.as_array(events, ["user_id"], "x"), ["user_id"], height=5, distance=4, prominence=10)


def event_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of different keys and types as columns."""
    tag = F.when(F.col("event_id") % 2 == 0, F.col("event_type"))
    whole = F.struct(F.col("event_id").alias("Index"), F.col("value").alias("Value [s]"), (F.col("user_id") > 7).alias("isOld"), F.col("props").alias("raw"), F.array("user_id").alias("users"), tag.alias("Tag"))
    record = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(F.col("event_id").alias("Index"), F.lit("none").alias("mixed"), F.lit(False).alias("isOld")))).otherwise(F.regexp_replace(F.to_json(whole), "}$", ',"mixed":7,"nothing":null}'))
    return metadata.records_table(_read(spark, sf_dir, "events").select("event_id", record.alias("json")), "frame")


def lane_orientation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _profile(spark, sf_dir).select("fov", "profile", F.explode(F.sequence(F.lit(0), F.lit(119))).alias("place"))
    return rows.select("fov", "place", trenches.orientation(F.col("profile"), F.col("place"), 5).alias("orientation"))


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trenches made up from the parts: 3 x 3 boxes in 8 x 8 images, a position for each 24 parts."""
    part = _read(spark, sf_dir, "part")
    peak = part.select(
        F.concat(F.lit("XYPos:"), F.expr("p_partkey div 24").cast("string")).alias("fov"), (F.col("p_partkey") % 2).cast("int").alias("lane_index"),
        (F.col("p_size") % 9).alias("peak"), F.lit(4).alias("y_center"), F.when(F.col("p_partkey") % 2 == 0, 1).otherwise(-1).alias("orientation"), (F.col("p_size") % 3).alias("trench_bottom_offset"),
    ).distinct()
    boxes = trenches.inside(trenches.trench_boxes(peak, 3, 3), F.lit(8), F.lit(8)).drop("peak", "y_center", "trench_bottom_offset")
    return trenches.numbered(boxes, [*trenches.position_order(), "lane_index", "x_left", "y_top"])


BOXES_SQL = """, pk AS (SELECT DISTINCT 'XYPos:' || CAST(p_partkey // 24 AS VARCHAR) AS fov, CAST(p_partkey % 2 AS INT) AS lane_index, p_size % 9 AS peak,
 CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE -1 END AS orientation, p_size % 3 AS o FROM part),
bx0 AS (SELECT fov, lane_index, orientation, CAST(peak - 1 AS INT) AS x_left, CAST(peak + 2 AS INT) AS x_right, CAST(CASE WHEN orientation > 0 THEN 4 - o - 3 ELSE 4 + o END AS INT) AS y_top FROM pk),
bx AS (SELECT CAST(row_number() OVER (ORDER BY CAST(fov[7:] AS INT), lane_index, x_left, y_top) - 1 AS INT) AS trench_id, *, y_top + 3 AS y_bottom, orientation <= 0 AS needs_flip FROM bx0
 WHERE x_left >= 0 AND x_right <= 8 AND y_top >= 0 AND y_top + 3 <= 8)
"""
_BOXES = "WITH " + BOXES_SQL.lstrip(", ")


def trench_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(spark, sf_dir)


def trench_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trenches.slots(trenches.discard(_boxes(spark, sf_dir), [1, 3])).select("trench_id", "slot")


def trench_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trenches.bands(_boxes(spark, sf_dir)).select("fov", "y_top", "y_bottom", F.concat_ws(",", F.transform("trench_ids", lambda i: i.cast("string"))).alias("trench_ids"))


def trench_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(spark, sf_dir).groupBy("fov").agg(F.count(F.lit(1)).alias("n_trenches"), F.countDistinct("lane_index").alias("n_lanes"))


def trench_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = frames.from_embeddings(spark, sf_dir)
    crops = trenches.crops(stack, _shifts(stack), _boxes(spark, sf_dir), integers=False)
    rows = frames.pixels(crops)
    return rows.select("trench_id", "t", "y", "x", F.round("v", 6).alias("v"))


def chunked_crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crops as chunks of four times, of which a part of the times is read back."""
    stack = frames.from_embeddings(spark, sf_dir)
    crops = trenches.crops(stack, _shifts(stack), _boxes(spark, sf_dir), integers=False)
    rows = frames.pixels(chunks.unpack(chunks.pack(crops, 4, "float64"), 6, 43))
    return rows.select("trench_id", "t", "y", "x", F.round("v", 6).alias("v"))


def trench_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = frames.from_embeddings(spark, sf_dir)
    return trenches.with_source(_boxes(spark, sf_dir), stack.select("fov", "p_index", "t", "t_ms")).select("trench_id", "p_index", "t", "t_ms")


def stored_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trenches.stored_bytes(_boxes(spark, sf_dir), 750, 2).select("n_bytes", names.human_size(F.col("n_bytes")).alias("size"))


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = frames.from_embeddings(spark, sf_dir)
    moved = _shifts(stack).select("fov", "t", F.round(F.col("tx") * 4).cast("int").alias("tx"), F.round(F.col("ty") * 4).cast("int").alias("ty"))
    return trenches.fingerprint(_boxes(spark, sf_dir), names.canonical_json({"codec": "zstd", "level": 3}), moved)


def pending_fovs(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = frames.from_embeddings(spark, sf_dir)
    done = stack.where("p_index % 3 = 0").select("fov").distinct()
    return store.pending(stack, done).groupBy("fov").agg(F.count(F.lit(1)).alias("n_frames"))


def _lanes(stack: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mean image and the lanes found in it, with a smoothing and a window that suit images of 8 x 8 pixels."""
    image = means.mean_image(stack, 10, "end")
    return image, trenches.detect_lanes(image, sigma=1.0, distance=1, height=-10, window_um=3.0)


def detected_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lanes(frames.from_embeddings(spark, sf_dir))[1]


def detected_trenches(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = frames.from_embeddings(spark, sf_dir)
    image, lanes = _lanes(stack)
    return trenches.detect_trenches(image, lanes, sigma=1.0, distance=1, prominence=0, height=-10, trench_width=2, trench_length=2, trench_bottom_offset=0, positions=stack, least_band=2)


def lane_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trenches where the second lane of a position has a height, an offset and no smoothing of its own."""
    stack = frames.from_embeddings(spark, sf_dir)
    image, lanes = _lanes(stack)
    own = {1: {"sigma": 0.0, "height": 0.05, "trench_bottom_offset": 1.0}}
    return trenches.detect_trenches(image, lanes, sigma=1.0, distance=1, prominence=0, height=-10, trench_width=2, trench_length=2, trench_bottom_offset=0, overrides=own, positions=stack, least_band=2)


def band_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    stack = frames.from_embeddings(spark, sf_dir)
    lanes = stack.select("fov", (F.col("p_index") % 8).alias("y_center"), F.lit(0).alias("lane_index")).distinct()
    profile = means.band_profile(means.mean_image(stack, 10, "end"), lanes, 2, least=2)
    return profile.select("fov", "lane_index", "x", F.round("profile", 6).alias("profile"))


#: Mean images, row profiles, smoothed ones (sigma 1, mirrored ends), their peaks, and which side of each is brighter.
_LANES = """, m AS (SELECT fov, p_index, y, x, avg(v) AS v FROM px JOIN (SELECT fov, max(t) AS last FROM fr GROUP BY fov) l USING (fov) WHERE t > last - 10 GROUP BY fov, p_index, y, x),
k0 AS (SELECT i, exp(-0.5::DOUBLE * i * i) AS w FROM range(-4, 5) r(i)), kw AS (SELECT i, w / (SELECT sum(w) FROM k0) AS w FROM k0),
pf AS (SELECT fov, p_index, y, avg(v) AS v FROM m GROUP BY fov, p_index, y),
sm AS (SELECT a.fov, a.y, sum(kw.w * b.v) AS v FROM pf a CROSS JOIN kw JOIN pf b ON b.fov = a.fov AND b.y = CASE WHEN (a.y + kw.i + 16) % 16 < 8 THEN (a.y + kw.i + 16) % 16 ELSE 15 - (a.y + kw.i + 16) % 16 END GROUP BY a.fov, a.y),
lp AS (SELECT fov, y AS y_center FROM (SELECT fov, y, v, lag(v) OVER o AS pv, lead(v) OVER o AS nv FROM sm WINDOW o AS (PARTITION BY fov ORDER BY y)) WHERE v > pv AND v > nv),
ln AS (SELECT lp.fov, CAST(row_number() OVER (PARTITION BY lp.fov ORDER BY y_center) - 1 AS INT) AS lane_index, y_center, CASE WHEN avg(CASE WHEN y < y_center THEN v END) > avg(CASE WHEN y >= y_center THEN v END) THEN 1 ELSE -1 END AS orientation
 FROM lp JOIN pf ON pf.fov = lp.fov AND y >= y_center - 3 AND y < y_center + 3 GROUP BY lp.fov, y_center)
"""
_TRENCHES = """, bp AS (SELECT ln.fov, lane_index, y_center, orientation, p_index, x, avg(v) AS v FROM ln JOIN m ON m.fov = ln.fov AND y >= y_center - 2 AND y < y_center + 2 GROUP BY ALL),
bs AS (SELECT a.fov, a.lane_index, a.y_center, a.orientation, a.p_index, a.x, sum(kw.w * b.v) AS v FROM bp a CROSS JOIN kw JOIN bp b ON b.fov = a.fov AND b.lane_index = a.lane_index AND b.x = CASE WHEN (a.x + kw.i + 16) % 16 < 8 THEN (a.x + kw.i + 16) % 16 ELSE 15 - (a.x + kw.i + 16) % 16 END GROUP BY ALL),
tp AS (SELECT *, x - 1 AS x_left, CASE WHEN orientation > 0 THEN y_center - 2 ELSE y_center END AS y_top FROM (SELECT *, lag(v) OVER o AS pv, lead(v) OVER o AS nv FROM bs WINDOW o AS (PARTITION BY fov, lane_index ORDER BY x)) WHERE v > pv AND v > nv)
SELECT CAST(row_number() OVER (ORDER BY p_index, lane_index, x_left) - 1 AS INT) AS trench_id, fov, lane_index, CAST(x_left AS INT) AS x_left, CAST(x_left + 2 AS INT) AS x_right, CAST(y_top AS INT) AS y_top, CAST(y_top + 2 AS INT) AS y_bottom, orientation, orientation < 0 AS needs_flip
 FROM tp WHERE x_left >= 0 AND x_left + 2 <= 8 AND y_top >= 0 AND y_top + 2 <= 8"""
_PROFILE = """WITH c AS (SELECT event_type || ':' || (event_id // 7200) AS fov, CAST((event_id % 720) // 6 AS INT) AS x, CAST(count(*) AS DOUBLE) AS v FROM events GROUP BY 1, 2),
g AS (SELECT f.fov, CAST(r.x AS INT) AS x, coalesce(c.v, 0) AS v FROM (SELECT DISTINCT fov FROM c) f CROSS JOIN range(120) r(x) LEFT JOIN c ON c.fov = f.fov AND c.x = r.x)
"""
_GAUSS = ", k AS (SELECT i, exp(-0.5::DOUBLE * i * i / 9.0::DOUBLE) AS w FROM range(-12, 13) r(i)), kw AS (SELECT i, w / (SELECT sum(w) FROM k) AS w FROM k)"
_PEAKS = """, ch AS (SELECT fov, x, v, lag(v) OVER (PARTITION BY fov ORDER BY x) AS p FROM g),
run AS (SELECT fov, x, v, lead(x) OVER (PARTITION BY fov ORDER BY x) AS nx, lag(v) OVER (PARTITION BY fov ORDER BY x) AS pv, lead(v) OVER (PARTITION BY fov ORDER BY x) AS nv FROM ch WHERE p IS NULL OR v <> p),
pk AS (SELECT fov, CAST((x + nx - 1) // 2 AS INT) AS peak, v AS value FROM run WHERE v > pv AND v > nv AND v >= 1),
ed AS (SELECT pk.*, coalesce((SELECT max(g.x) FROM g WHERE g.fov = pk.fov AND g.x < pk.peak AND g.v > pk.value), -1) AS l, coalesce((SELECT min(g.x) FROM g WHERE g.fov = pk.fov AND g.x > pk.peak AND g.v > pk.value), 120) AS r FROM pk),
pr AS (SELECT fov, peak, value, value - greatest((SELECT min(g.v) FROM g WHERE g.fov = ed.fov AND g.x > ed.l AND g.x <= ed.peak), (SELECT min(g.v) FROM g WHERE g.fov = ed.fov AND g.x >= ed.peak AND g.x < ed.r)) AS prominence FROM ed)
SELECT fov, peak, value FROM pr WHERE prominence >= 2"""

#: Peaks of the profiles in g, tallest first (of equals the last), of which each is kept if no kept one is nearer than the distance.
_APART = """, ch AS (SELECT fov, x, v, lag(v) OVER (PARTITION BY fov ORDER BY x) AS p FROM g),
run AS (SELECT fov, x, v, coalesce(lead(x) OVER o, (SELECT max(x) + 1 FROM g WHERE g.fov = ch.fov)) AS nx, lag(v) OVER o AS pv, lead(v) OVER o AS nv FROM ch WHERE p IS NULL OR v <> p WINDOW o AS (PARTITION BY fov ORDER BY x)),
pk AS (SELECT fov, CAST((x + nx - 1) // 2 AS INT) AS peak, v AS value, row_number() OVER (PARTITION BY fov ORDER BY v DESC, x DESC) AS nth FROM run WHERE v > pv AND v > nv AND v >= {height}),
kp(fov, nth, kept) AS (SELECT fov, 1, [peak] FROM pk WHERE nth = 1 UNION ALL SELECT kp.fov, kp.nth + 1, CASE WHEN len(list_filter(kp.kept, lambda k: abs(k - pk.peak) < {distance})) > 0 THEN kp.kept ELSE list_append(kp.kept, pk.peak) END FROM kp JOIN pk ON pk.fov = kp.fov AND pk.nth = kp.nth + 1),
ap AS (SELECT pk.* FROM pk JOIN (SELECT fov, unnest(kept) AS peak FROM (SELECT fov, kept FROM kp QUALIFY nth = max(nth) OVER (PARTITION BY fov))) k USING (fov, peak)),
ed AS (SELECT ap.fov, peak, value, coalesce(max(CASE WHEN g.x < peak AND g.v > value THEN g.x END), -1) AS l, coalesce(min(CASE WHEN g.x > peak AND g.v > value THEN g.x END), 1000000000) AS r FROM ap JOIN g ON g.fov = ap.fov GROUP BY ap.fov, peak, value),
pr AS (SELECT ed.fov, peak, value, value - greatest(min(CASE WHEN g.x > l AND g.x <= peak THEN g.v END), min(CASE WHEN g.x >= peak AND g.x < r THEN g.v END)) AS prominence FROM ed JOIN g ON g.fov = ed.fov GROUP BY ed.fov, peak, value)
"""
_SMOOTH = "WITH RECURSIVE " + _PROFILE[5:].replace("g AS (", "g0 AS (") + """, k AS (SELECT i, exp(-0.5::DOUBLE * i * i / 4.0::DOUBLE) AS w FROM range(-8, 9) r(i)), kw AS (SELECT i, w / (SELECT sum(w) FROM k) AS w FROM k),
g AS (SELECT a.fov, a.x, sum(kw.w * h.v ORDER BY kw.i) AS v FROM g0 a CROSS JOIN kw JOIN g0 h ON h.fov = a.fov AND h.x = CASE WHEN (a.x + kw.i + 240) % 240 < 120 THEN (a.x + kw.i + 240) % 240 ELSE 239 - (a.x + kw.i + 240) % 240 END GROUP BY a.fov, a.x)
"""
_USERS = "WITH RECURSIVE g AS (SELECT user_id AS fov, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS x, value AS v FROM events)"
#: As _TRENCHES, where lane 1 is not smoothed, needs a height and lies one row further off.
_OVERRIDES = _TRENCHES.replace("sum(kw.w * b.v) AS v FROM bp a", "sum(CASE WHEN a.lane_index <> 1 THEN kw.w * b.v WHEN kw.i = 0 THEN b.v ELSE 0 END) AS v FROM bp a").replace("CASE WHEN orientation > 0 THEN y_center - 2 ELSE y_center END", "CASE WHEN orientation > 0 THEN y_center - 2 - (lane_index = 1)::INT ELSE y_center + (lane_index = 1)::INT END").replace("WHERE v > pv AND v > nv)", "WHERE v > pv AND v > nv AND (lane_index <> 1 OR v >= 0.05))")

PLANS = {
    "rename_duplicates": (rename_duplicates, "SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_name) > 1 THEN p_name || '-' || CASE WHEN row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) < 10 THEN '0' ELSE '' END || CAST(row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS VARCHAR) ELSE p_name END AS p_name FROM part"),
    "ordered_distinct": (ordered_distinct, "SELECT p_type, min(p_partkey) AS p_partkey FROM part GROUP BY p_type"),
    "intersect_roi": (intersect_roi, "SELECT p_partkey, CAST(greatest(p_size % 7, 3) AS INT) AS start, CAST(least(CASE WHEN p_size % 3 = 0 THEN 40 ELSE p_size + 5 END, 40) AS INT) AS stop FROM part"),
    "snake_names": (snake_names, r"SELECT p_partkey, 'field_' || lower(regexp_replace(regexp_replace(regexp_replace('2nd u' || p_type || '-maxSize ' || p_brand, '([a-z0-9])([A-Z])', '\1_\2', 'g'), '[^0-9A-Za-z]+', '_', 'g'), '^_+|_+$', '', 'g')) AS name FROM part"),
    "calibration": (calibration, "SELECT round(abs(max(CASE WHEN i = 2 THEN o_totalprice END) - max(CASE WHEN i = 1 THEN o_totalprice END)), 6) AS step FROM (SELECT o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders) WHERE i <= 2"),
    "time_differences": (time_differences, "SELECT event_id, user_id, step_ms FROM (SELECT event_id, user_id, CAST(floor(epoch_us(ts) / 1000) AS BIGINT) - lag(CAST(floor(epoch_us(ts) / 1000) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step_ms FROM events) WHERE step_ms IS NOT NULL"),
    "cumulative_drift": (cumulative_drift, "SELECT user_id AS fov, t, round(4 * sum(CASE WHEN t > 0 THEN value ELSE 0 END) OVER w, 4) AS tx, round(4 * sum(CASE WHEN t > 0 THEN -value ELSE 0 END) OVER w, 4) AS ty FROM (SELECT user_id, value, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS t FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING)"),
    "event_keys": (event_keys, "SELECT key, CASE WHEN bool_and(kind = 'BOOLEAN') THEN 'bool' WHEN bool_and(kind IN ('UBIGINT', 'BIGINT')) THEN 'int64' WHEN bool_and(kind IN ('UBIGINT', 'BIGINT', 'DOUBLE', 'NULL')) THEN 'float64' ELSE 'string' END AS type FROM (SELECT key, json_type(props, '$.' || key) AS kind FROM (SELECT props, unnest(json_keys(props)) AS key FROM events)) GROUP BY key"),
    "events_by_kind": (events_by_kind, "SELECT event_id, CASE WHEN event_type = 'error' THEN 'acquisition' ELSE 'frame' END AS kind FROM events WHERE event_type = 'error' OR (user_id % 6 IN (2, 3, 4) AND event_id % 9 < 4)"),
    "source_frames": (source_frames, FRAMES_SQL + "SELECT a.fov, a.t, CAST(CASE WHEN fr.t IS NOT NULL THEN a.t * 30000 + a.p_index END AS DOUBLE) AS relative_time_ms, CAST(CASE WHEN fr.t IS NOT NULL THEN a.p_index + 100 END AS DOUBLE) AS stage_x, CAST(CASE WHEN fr.t IS NOT NULL THEN a.t + 200 END AS DOUBLE) AS stage_y, coalesce(fr.fov, '') AS position_name FROM (SELECT * FROM (SELECT DISTINCT fov, p_index FROM fr) CROSS JOIN (SELECT DISTINCT t FROM fr)) a LEFT JOIN fr ON fr.fov = a.fov AND fr.t = a.t"),
    "smoothed": (smoothed, _PROFILE + _GAUSS + " SELECT g.fov, g.x, round(sum(kw.w * h.v), 6) AS v FROM g CROSS JOIN kw JOIN g h ON h.fov = g.fov AND h.x = CASE WHEN (g.x + kw.i + 240) % 240 < 120 THEN (g.x + kw.i + 240) % 240 ELSE 239 - (g.x + kw.i + 240) % 240 END GROUP BY g.fov, g.x"),
    "convolved": (convolved, _PROFILE + "SELECT a.fov, CAST(a.x + k.i AS INT) AS x, round(sum(a.v * k.w) / 4, 6) AS v FROM g a CROSS JOIN (VALUES (0, 1.0::DOUBLE), (1, 2.0::DOUBLE), (2, 1.0::DOUBLE)) k(i, w) GROUP BY 1, 2"),
    "peaks": (peaks, _PROFILE + _PEAKS),
    "peaks_apart": (peaks_apart, _SMOOTH + _APART.format(height=-1, distance=8) + "SELECT fov, peak, round(value, 6) AS value FROM pr WHERE prominence >= 0.1"),
    "user_peaks": (user_peaks, _USERS + _APART.format(height=5, distance=4) + "SELECT fov AS user_id, peak, value FROM pr WHERE prominence >= 10"),
    "event_columns": (event_columns, "SELECT event_id, event_id AS frame_index, event_id % 3 <> 0 AND user_id > 7 AS frame_is_old, CASE WHEN event_id % 3 = 0 THEN 'none' ELSE '7' END AS frame_mixed, CAST(NULL AS VARCHAR) AS frame_nothing, CASE WHEN event_id % 3 = 0 THEN '' ELSE props END AS frame_raw, CASE WHEN event_id % 3 <> 0 AND event_id % 2 = 0 THEN event_type ELSE '' END AS frame_tag, CASE WHEN event_id % 3 = 0 THEN '' ELSE '[' || user_id || ']' END AS frame_users, CASE WHEN event_id % 3 <> 0 THEN value END AS frame_value_s FROM events"),
    "lane_overrides": (lane_overrides, FRAMES_SQL + _LANES + _OVERRIDES),
    "lane_orientation": (lane_orientation, _PROFILE + "SELECT a.fov, a.x AS place, CASE WHEN avg(CASE WHEN b.x < a.x THEN b.v END) > avg(CASE WHEN b.x >= a.x THEN b.v END) THEN 1 ELSE -1 END AS orientation FROM g a JOIN g b ON b.fov = a.fov AND b.x >= a.x - 5 AND b.x < a.x + 5 GROUP BY a.fov, a.x"),
    "detected_lanes": (detected_lanes, FRAMES_SQL + _LANES + "SELECT fov, lane_index, y_center, orientation FROM ln"),
    "detected_trenches": (detected_trenches, FRAMES_SQL + _LANES + _TRENCHES),
    "trench_table": (trench_table, _BOXES + "SELECT trench_id, fov, lane_index, orientation, x_left, x_right, y_top, y_bottom, needs_flip FROM bx"),
    "trench_slots": (trench_slots, _BOXES + "SELECT trench_id, CAST(row_number() OVER (ORDER BY trench_id) - 1 AS INT) AS slot FROM bx WHERE trench_id NOT IN (1, 3)"),
    "trench_bands": (trench_bands, _BOXES + "SELECT fov, y_top, y_bottom, string_agg(CAST(trench_id AS VARCHAR), ',' ORDER BY trench_id) AS trench_ids FROM bx GROUP BY fov, y_top, y_bottom"),
    "trench_counts": (trench_counts, _BOXES + "SELECT fov, count(*) AS n_trenches, count(DISTINCT lane_index) AS n_lanes FROM bx GROUP BY fov"),
    "trench_crops": (trench_crops, FRAMES_SQL + _SHIFTS + _PLAIN + _WARP + BOXES_SQL + "SELECT trench_id, t, CASE WHEN needs_flip THEN y_bottom - 1 - y ELSE y - y_top END AS y, x - x_left AS x, round(v, 6) AS v FROM wp JOIN bx USING (fov) WHERE x >= x_left AND x < x_right AND y >= y_top AND y < y_bottom"),
    "chunked_crops": (chunked_crops, FRAMES_SQL + _SHIFTS + _PLAIN + _WARP + BOXES_SQL + "SELECT trench_id, t, CASE WHEN needs_flip THEN y_bottom - 1 - y ELSE y - y_top END AS y, x - x_left AS x, round(v, 6) AS v FROM wp JOIN bx USING (fov) WHERE x >= x_left AND x < x_right AND y >= y_top AND y < y_bottom AND t >= 6 AND t < 43"),
    "trench_sources": (trench_sources, FRAMES_SQL + BOXES_SQL + "SELECT trench_id, p_index, t, t * 30000.0::DOUBLE AS t_ms FROM bx JOIN fr USING (fov)"),
    "stored_size": (stored_size, _BOXES + ", n AS (SELECT CAST(sum(9) * 750 * 2 * 2 AS DOUBLE) AS n_bytes FROM bx) SELECT n_bytes, CASE WHEN n_bytes < 1024 THEN format('{:.1f} B', n_bytes) WHEN n_bytes < 1048576 THEN format('{:.1f} KB', n_bytes / 1024) WHEN n_bytes < 1073741824 THEN format('{:.1f} MB', n_bytes / 1048576) ELSE format('{:.1f} GB', n_bytes / 1073741824) END AS size FROM n"),
    "fingerprint": (fingerprint, FRAMES_SQL + _SHIFTS + BOXES_SQL + """, e AS (SELECT fov, 0 AS kind, trench_id AS spot, '{"trench_id":' || trench_id || ',"fov":"' || fov || '","lane_index":' || lane_index || ',"x_left":' || x_left || ',"x_right":' || x_right || ',"y_top":' || y_top || ',"y_bottom":' || y_bottom || ',"orientation":' || orientation || ',"needs_flip":' || needs_flip || '}' AS line FROM bx
 UNION ALL SELECT fov, 1, t, '{"t":' || t || ',"tx":' || CAST(round(tx * 4) AS INT) || ',"ty":' || CAST(round(ty * 4) AS INT) || '}' FROM sh),
h AS (SELECT sha256(string_agg(line, chr(10) ORDER BY kind, spot)) AS hash FROM e GROUP BY fov) SELECT sha256(string_agg(hash, chr(10) ORDER BY hash) || chr(10) || '{"codec":"zstd","level":3}') AS fingerprint FROM h"""),
    "pending_fovs": (pending_fovs, FRAMES_SQL + "SELECT fov, count(*) AS n_frames FROM fr WHERE p_index % 3 <> 0 GROUP BY fov"),
    "band_profile": (band_profile, FRAMES_SQL + ", m AS (SELECT fov, p_index, y, x, avg(v) AS v FROM px JOIN (SELECT fov, max(t) AS last FROM fr GROUP BY fov) l USING (fov) WHERE t > last - 10 GROUP BY fov, p_index, y, x) SELECT fov, 0 AS lane_index, x, round(avg(v), 6) AS profile FROM m WHERE y >= p_index % 8 - 2 AND y < p_index % 8 + 2 GROUP BY fov, x"),
}
