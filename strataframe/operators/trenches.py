"""Feeding lanes and trenches from profiles, and the crops of trenches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from . import geometry, kernels, means, signal

#: Parameters that a lane may override; the shape must be equal for all.
LANE_PARAMS = ("sigma", "distance", "prominence", "height", "trench_bottom_offset")


def orientation(profile: Column, place: Column, window: int) -> Column:
    """1 if the mean of the window before the place is above that of the window from it on, else -1 (ties and empty windows too)."""

    def mean(low: Column, high: Column) -> Column:
        part = F.slice(profile, low + 1, F.greatest(F.lit(0), high - low))
        return F.aggregate(part, F.lit(0.0), lambda a, v: a + v) / F.nullif(F.size(part), F.lit(0))

    above = mean(F.greatest(F.lit(0), place - window), place)
    below = mean(place, F.least(F.size(profile), place + window))
    return F.when(above > below, 1).otherwise(-1)


def detect_lanes(image: DataFrame, sigma: float = 40.0, distance: float = 300, height: float = 5000, window_um: float = 20.0, pixel_um: float = 1.0) -> DataFrame:
    """fov, lane_index (from the top), y_center and orientation of every lane of mean images."""
    window = max(1, round(window_um / pixel_um))
    raw = signal.as_array(means.row_profile(image), ["fov"], "y")
    smooth = raw.withColumn("profile", signal.gaussian_smooth(F.col("profile"), sigma))
    found = signal.find_peaks(smooth, ["fov"], height=height, distance=distance)
    order = Window.partitionBy("fov").orderBy("peak")
    lanes = found.join(raw, "fov").select("fov", F.col("peak").alias("y_center"), orientation(F.col("profile"), F.col("peak"), window).alias("orientation"))
    return lanes.select("fov", (F.row_number().over(Window.partitionBy("fov").orderBy("y_center")) - 1).alias("lane_index"), "y_center", "orientation")


def lane_params(lanes: DataFrame, overrides: dict[int, dict[str, float]] | None, defaults: dict[str, float]) -> DataFrame:
    """Lanes with every parameter: a lane's own, else the default.  Shape parameters can't be overridden."""
    for params in (overrides or {}).values():
        if bad := sorted(set(params) - set(LANE_PARAMS)):
            raise ValueError(f"a lane can't override {', '.join(bad)}")
    out = lanes
    for name in LANE_PARAMS:
        value = F.lit(defaults[name]).cast("double")
        for lane, params in (overrides or {}).items():
            if name in params:
                value = F.when(F.col("lane_index") == lane, F.lit(float(params[name]))).otherwise(value)
        out = out.withColumn(name, value)
    return out


def trench_boxes(peaks: DataFrame, width: int, length: int) -> DataFrame:
    """x_left, x_right, y_top, y_bottom and needs_flip from peak, y_center, orientation and trench_bottom_offset."""
    if width < 1 or length < 1:
        raise ValueError("width and length must be positive")
    offset, up = F.col("trench_bottom_offset").cast("int"), F.col("orientation") > 0
    left = F.col("peak") - width // 2
    top = F.when(up, F.col("y_center") - offset - length).otherwise(F.col("y_center") + offset)
    return peaks.withColumns({"x_left": left, "x_right": left + width, "y_top": top, "y_bottom": top + length, "needs_flip": ~up})


def inside(boxes: DataFrame, h: Column, w: Column) -> DataFrame:
    """Boxes that lie in their image."""
    return boxes.where((F.col("x_left") >= 0) & (F.col("x_right") <= w) & (F.col("y_top") >= 0) & (F.col("y_bottom") <= h))


def position_order(fov: str = "fov") -> list[Column]:
    """Positions in order of their names' first part, then of the number at the end, so 10 comes after 2."""
    return [F.regexp_replace(fov, "[0-9]+$", ""), F.regexp_extract(fov, "([0-9]+)$", 1).try_cast("decimal(38,0)"), F.col(fov)]


def numbered(boxes: DataFrame, order: list[str | Column], lead: int = 3, groups: tuple[str, ...] = ("fov",)) -> DataFrame:
    """Ids from 0 over all positions, lanes and places.

    The first ``lead`` columns of the order must depend on ``groups`` alone: only positions, a row each, are
    brought together, for the running sum of their sizes; boxes are ranked in their own position.
    """
    before = Window.orderBy(*order[:lead]).rowsBetween(Window.unboundedPreceding, -1)
    begins = boxes.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n")).withColumn("__begin", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    own = F.row_number().over(Window.partitionBy(*groups).orderBy(*order[lead:])) - 1
    return boxes.withColumn("__own", own).join(begins, list(groups)).withColumn("trench_id", (F.col("__begin") + F.col("__own")).cast("int")).drop("__begin", "__own")


def detect_trenches(
    image: DataFrame, lanes: DataFrame, sigma: float = 4.0, distance: float = 100, prominence: float = 10, height: float = 0, trench_width: int = 32,
    trench_length: int = 160, trench_bottom_offset: float = 50, conv_filter: list[float] | None = None, overrides: dict[int, dict[str, float]] | None = None,
    positions: DataFrame | None = None, least_band: int = 100,
) -> DataFrame:
    """One row a trench: trench_id, fov, lane_index, box, orientation and needs_flip.

    Ids follow the order of positions: ``p_index`` of ``positions`` (fov, p_index) if given, else the names' (see ``position_order``).
    """
    defaults = {"sigma": sigma, "distance": distance, "prominence": prominence, "height": height, "trench_bottom_offset": trench_bottom_offset}
    tuned = lane_params(lanes, overrides, defaults)
    profiles = signal.as_array(means.band_profile(image, lanes, trench_length, least_band), ["fov", "lane_index"], "x")
    profiles = profiles.join(tuned, ["fov", "lane_index"])
    profiles = profiles.withColumn("profile", signal.gaussian_smooth(F.col("profile"), F.col("sigma")))
    if conv_filter:
        profiles = profiles.withColumn("profile", signal.convolve(F.col("profile"), conv_filter))
    found = signal.find_peaks(profiles, ["fov", "lane_index", "y_center", "orientation", "trench_bottom_offset"], height, distance, prominence) if not overrides else signal.find_peaks(profiles, ["fov", "lane_index", "y_center", "orientation", "trench_bottom_offset"])
    size = image.groupBy("fov").agg((F.max("y") + 1).alias("__h"), (F.max("x") + 1).alias("__w"))
    boxes = inside(trench_boxes(found, trench_width, trench_length).join(size, "fov"), F.col("__h"), F.col("__w"))
    kept = boxes.select("fov", "lane_index", "x_left", "x_right", "y_top", "y_bottom", "orientation", "needs_flip")
    if positions is None:
        return numbered(kept, [*position_order(), "lane_index", "x_left"])
    placed = kept.join(positions.select("fov", F.col("p_index").alias("__p")).distinct(), "fov")
    return numbered(placed, ["__p", "lane_index", "x_left"], 1, ("fov", "__p")).drop("__p")


def discard(trenches: DataFrame, ids: list[int]) -> DataFrame:
    return trenches.where(~F.col("trench_id").isin(ids))


def slots(trenches: DataFrame, block: int = 1 << 16) -> DataFrame:
    """The place of each trench in the output, in the order of the ids; ids are ranked in blocks, whose sizes add up."""
    rows = trenches.withColumn("__block", F.floor(F.col("trench_id") / block))
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)  # over one row a block
    begins = rows.groupBy("__block").agg(F.count(F.lit(1)).alias("__n")).select("__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__begin"))
    own = F.row_number().over(Window.partitionBy("__block").orderBy("trench_id")) - 1
    return rows.withColumn("__own", own).join(begins, "__block").withColumn("slot", (F.col("__begin") + F.col("__own")).cast("int")).drop("__block", "__begin", "__own")


def uniform_shape(trenches: DataFrame) -> tuple[int, int]:
    """Height and width that all trenches have; ValueError if they differ."""
    height, width = F.col("y_bottom") - F.col("y_top"), F.col("x_right") - F.col("x_left")
    r = trenches.agg(F.min(height), F.max(height), F.min(width), F.max(width)).first()
    if r[0] is None or r[0] != r[1] or r[2] != r[3]:
        raise ValueError("trenches differ in shape, or there are none")
    return r[0], r[2]


def bands(trenches: DataFrame) -> DataFrame:
    """The trenches that share rows of the image: fov, y_top, y_bottom and their ids."""
    return trenches.groupBy("fov", "y_top", "y_bottom").agg(F.array_sort(F.collect_list("trench_id")).alias("trench_ids"))


def crops(frames: DataFrame, transforms: DataFrame, trenches: DataFrame, degrees: float = 0.0, integers: bool = True) -> DataFrame:
    """trench_id, fov, t, c, h, w and pixels of every trench in every frame.

    A frame meets all boxes of its position (one array a position) at once; each band of rows is
    gathered once and then cut.  With ``integers`` values are cut as the source's type would.
    Filters on fov, t and c pass below the cutting.
    """
    fields = ("trench_id", "y_top", "y_bottom", "x_left", "x_right", "needs_flip")
    boxes = trenches.where("y_bottom > y_top and x_right > x_left").groupBy("fov").agg(F.collect_list(F.struct(*fields)).alias("__boxes"))
    joined, m = geometry.placed(frames, transforms, degrees)
    kind = trenches.schema["trench_id"].dataType.simpleString()
    cut = kernels.crops(F.col("pixels"), F.col("h"), F.col("w"), m, F.col("__boxes"), kind, integers)
    found = joined.join(boxes, "fov").select("fov", "t", "c", F.explode(cut).alias("__crop"))
    return found.select("__crop.trench_id", "fov", "t", "c", "__crop.h", "__crop.w", "__crop.pixels")


def with_source(trenches: DataFrame, source_frames: DataFrame) -> DataFrame:
    """Every trench at every time with the metadata of its position's frames."""
    return trenches.join(source_frames, "fov")


def stored_bytes(trenches: DataFrame, times: int, channels: int, item_bytes: int = 2) -> DataFrame:
    """One row: the uncompressed bytes of all crops."""
    area = (F.col("y_bottom") - F.col("y_top")) * (F.col("x_right") - F.col("x_left"))
    return trenches.agg((F.coalesce(F.sum(area), F.lit(0)) * times * channels * item_bytes).cast("double").alias("n_bytes"))


def fingerprint(trenches: DataFrame, settings: str, transforms: DataFrame | None = None) -> DataFrame:
    """One row: a hash of all trenches, of the transforms (fov, t, tx, ty) if given, and of the settings, to tell whether an extraction may go on.

    settings: rotation, times, channels, codec and whatever else the crops depend on, as canonical JSON.
    Each position is hashed by itself, so no task gets the rows of all; then the sorted hashes are.
    """
    box = F.to_json(F.struct("trench_id", "fov", "lane_index", "x_left", "x_right", "y_top", "y_bottom", "orientation", "needs_flip"))
    rows = trenches.select("fov", F.struct(F.lit(0).alias("kind"), F.col("trench_id").cast("long").alias("at"), box.alias("row")).alias("entry"))
    if transforms is not None:
        step = F.to_json(F.struct("t", "tx", "ty"))
        rows = rows.unionAll(transforms.select("fov", F.struct(F.lit(1).alias("kind"), F.col("t").cast("long").alias("at"), step.alias("row")).alias("entry")))
    own = rows.groupBy("fov").agg(F.sha2(F.concat_ws("\n", F.transform(F.array_sort(F.collect_list("entry")), lambda e: e["row"])), 256).alias("hash"))
    whole = own.agg(F.concat_ws("\n", F.array_sort(F.collect_list("hash"))).alias("hashes"))
    return whole.select(F.sha2(F.concat(F.col("hashes"), F.lit("\n" + settings)), 256).alias("fingerprint"))
