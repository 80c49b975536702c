"""Drift of frames: translations by least squares or by phase correlation.

A translation says where the moving content sits relative to the reference: tx
is positive if it sits at larger x.  Frames are dealt in short blocks of times, each headed by
its reference or by the frame before it, so a position's frames spread over tasks and no window holds pixels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import kernels
from .geometry import cumulated
from .means import block_means, reference
from .selection import first_plane, select_roi

BACKENDS = ("least_squares", "phase")
_FAINT = 1e-4


def shift(image: np.ndarray, tx: float, ty: float) -> np.ndarray:
    """The image read at places moved by (tx, ty), bilinear; edge pixels go on outside."""
    h, w = image.shape
    y, x = np.clip(np.arange(h) + ty, 0, h - 1), np.clip(np.arange(w) + tx, 0, w - 1)
    y0, x0 = np.minimum(y.astype(int), max(0, h - 2)), np.minimum(x.astype(int), max(0, w - 2))
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (y - y0)[:, None], x - x0
    rows = image[y0] * (1 - fy) + image[y1] * fy
    return rows[:, x0] * (1 - fx) + rows[:, x1] * fx


def _level(image: np.ndarray) -> np.ndarray:
    """The image without the plane that fits it best."""
    out = image - image.mean()
    for axis, n in enumerate(image.shape):
        place = np.arange(n) - (n - 1) / 2
        if n > 1:
            slope = (out.mean(axis=1 - axis) * place).sum() / (place**2).sum()
            out = out - slope * (place[:, None] if axis == 0 else place)
    return out


def phase_translation(ref: np.ndarray, mov: np.ndarray, rounds: int = 20) -> tuple[float, float]:
    """Peak of the phase correlation with a parabola through its neighbours, repeated on what is left.

    Frequencies that hold next to nothing have the phase of noise, so those under ``_FAINT`` of the strongest count in proportion to what they hold.
    So that a slope of the light isn't the strongest, the plane that fits an image best is taken off.
    """
    tx = ty = 0.0
    still = np.conj(np.fft.fft2(_level(ref)))
    for _ in range(rounds):
        now = shift(mov, tx, ty)
        cross = np.fft.fft2(_level(now)) * still
        size = np.abs(cross)
        corr = np.fft.ifft2(cross / np.maximum(size, max(size.max() * _FAINT, 1e-300))).real
        h, w = corr.shape
        py, px = np.unravel_index(corr.argmax(), corr.shape)

        def fine(a: float, b: float, c: float) -> float:
            return 0.0 if (d := a - 2 * b + c) >= 0 else 0.5 * (a - c) / d

        dy = (py + h // 2) % h - h // 2 + fine(corr[py - 1, px], corr[py, px], corr[(py + 1) % h, px])
        dx = (px + w // 2) % w - w // 2 + fine(corr[py, px - 1], corr[py, px], corr[py, (px + 1) % w])
        tx, ty = tx + dx, ty + dy
        if abs(dx) + abs(dy) < 1e-3:
            break
    return float(tx), float(ty)


def _halved(image: np.ndarray) -> np.ndarray:
    h, w = (n // 2 * 2 for n in image.shape)
    return image[:h, :w].reshape(h // 2, 2, w // 2, 2).mean(axis=(1, 3))


#: Fixed value: the pole of the cubic B-spline's inverse filter.
_POLE = math.sqrt(3) - 2


def spline_coefficients(image: np.ndarray) -> np.ndarray:
    """Coefficients of the cubic B-spline through the pixels, ends mirrored (the end pixel not repeated), by one filter each way along each axis."""
    out = image.astype(float)
    for _ in range(2):
        n = len(out)
        if n > 1:
            reach = min(n, 30)  # the filter forgets faster than doubles can tell
            powers = _POLE ** np.arange(reach)
            out[0] = np.tensordot(powers, out[:reach], 1)
            for k in range(1, n):
                out[k] += _POLE * out[k - 1]
            out[-1] = _POLE / (_POLE * _POLE - 1) * (out[-1] + _POLE * out[-2])
            for k in range(n - 2, -1, -1):
                out[k] = _POLE * (out[k + 1] - out[k])
            out *= 6
        out = out.T
    return out


def _weights(shift: float) -> tuple[int, list[float], list[float]]:
    """The whole part of a shift, less one, and the weights of the spline and of its slope for 4 neighbours from there on."""
    base = math.floor(shift)
    u = shift - base
    value = [(1 - u) ** 3 / 6, (4 - 6 * u**2 + 3 * u**3) / 6, (1 + 3 * u + 3 * u**2 - 3 * u**3) / 6, u**3 / 6]
    slope = [-((1 - u) ** 2) / 2, (3 * u**2 - 4 * u) / 2, (1 + 2 * u - 3 * u**2) / 2, u**2 / 2]
    return base - 1, value, slope


def _overlap(n: int, shift: float) -> tuple[int, int]:
    """The places that lie in the image, off its margin, before and after the shift."""
    margin = max(2, min(4, n // 8))
    return max(margin, math.ceil(margin - shift)), min(n - margin, math.floor(n - 1 - margin - shift) + 1)


def _difference(ref: np.ndarray, coefficients: np.ndarray, tx: float, ty: float):
    """The mean squared difference where the images overlap, and what a step needs; too small an overlap counts as infinitely bad."""
    (y0, y1), (x0, x1) = _overlap(ref.shape[0], ty), _overlap(ref.shape[1], tx)
    area = max(0, y1 - y0) * max(0, x1 - x0)
    if 8 * area < ref.size:
        return math.inf, None, None
    (dy, vy, sy), (dx, vx, sx) = _weights(ty), _weights(tx)
    rows = [coefficients[y0 + dy + k : y1 + dy + k, x0 + dx : x1 + dx + 3] for k in range(4)]
    down, steep = (sum(w * r for w, r in zip(ws, rows)) for ws in (vy, sy))
    across = lambda part, ws: sum(w * part[:, k : k + x1 - x0] for k, w in enumerate(ws))
    diff = (ref[y0:y1, x0:x1] - across(down, vx)).ravel()
    return float(diff @ diff) / area, diff, np.stack([across(down, sx).ravel(), across(steep, vx).ravel()])


def _climb(ref: np.ndarray, coefficients: np.ndarray, tx: float, ty: float, rounds: int) -> tuple[float, float, float]:
    """tx, ty and the error after damped steps, of which only those are taken that lower the error."""
    error, diff, slopes = _difference(ref, coefficients, tx, ty)
    damping = 1e-3
    for _ in range(rounds):
        if slopes is None:
            break
        normal, pull = slopes @ slopes.T, slopes @ diff
        # a direction in which nothing varies stays where it is
        dx, dy = np.linalg.pinv(normal + damping * np.diag(np.diag(normal)), rcond=1e-9) @ pull
        after = _difference(ref, coefficients, tx + dx, ty + dy)
        if after[0] < error:
            tx, ty, (error, diff, slopes) = float(tx + dx), float(ty + dy), after
            damping = max(damping / 10, 1e-9)
        else:
            damping *= 10
        if math.hypot(dx, dy) < 1e-4 or damping > 1e6:
            break
    return tx, ty, error


def _smoothed(image: np.ndarray) -> np.ndarray:
    """The image without its finest detail, whose noise would draw shifts to halves of pixels, where interpolation averages it away."""
    for _ in range(2):
        n = len(image)
        at = np.abs(np.arange(-2, n + 2)) % max(1, 2 * n - 2)
        padded = image[np.where(at >= n, 2 * n - 2 - at, at)]
        image = ((padded[:-4] + padded[4:]) + 4 * (padded[1:-3] + padded[3:-1]) + 6 * padded[2:-2]).T / 16
    return image


def whole_translation(ref: np.ndarray, mov: np.ndarray) -> tuple[int, int]:
    """The whole shift of highest correlation among all whose overlap is at least a quarter; of equals the shortest.

    Correlation coefficients over the overlap of every shift, by products of spectra.
    """
    h, w = ref.shape
    size = (2 * h - 1, 2 * w - 1)
    spectrum = lambda image: np.fft.rfft2(image, size)
    back = lambda product: np.fft.irfft2(product, size)
    ref, mov, ones = ref - ref.mean(), mov - mov.mean(), np.ones((h, w))
    r, m, one = spectrum(ref), spectrum(mov), spectrum(ones)
    area = np.maximum(np.rint(back(one * one.conj())), 1)
    r1, r2 = back(one.conj() * r).conj(), back(one.conj() * spectrum(ref * ref))
    m1, m2 = back(m * one.conj()), back(spectrum(mov * mov) * one.conj())
    # sums over ref at y go with mov at y + shift, so theirs run the other way
    turned = lambda sums: np.roll(sums[::-1, ::-1], (1, 1), (0, 1))
    r1, r2 = turned(r1), turned(r2)
    top = back(m * r.conj()) - r1 * m1 / area
    spread = np.maximum(r2 - r1**2 / area, 0) * np.maximum(m2 - m1**2 / area, 0)
    least = 1e-6 * float((ref**2).sum()) * float((mov**2).sum())
    score = np.where((4 * area >= h * w) & (spread > least), top / np.sqrt(np.maximum(spread, 1e-300)), -np.inf)
    if not np.isfinite(score).any():
        return 0, 0
    ys, xs = np.nonzero(score >= score.max() - 1e-6)
    shifts = [(int(x) if x < w else int(x) - size[1], int(y) if y < h else int(y) - size[0]) for y, x in zip(ys, xs)]
    return min(shifts, key=lambda s: (s[0] ** 2 + s[1] ** 2, s))


#: Images are halved until their longer side is at most so long; there all whole shifts are tried.
_COARSE = 128


def least_squares(ref: np.ndarray, mov: np.ndarray, rounds: int = 50) -> tuple[float, float, float]:
    """The translation of least mean squared difference, and that difference, of the smoothed images.

    A pyramid of cubic B-splines, coarse to fine, with Marquardt-Levenberg steps on slightly smoothed images; the coarsest level starts at the
    best whole shift.
    """
    levels = [(ref.astype(float), mov.astype(float))]
    while max(levels[-1][0].shape) > _COARSE and min(levels[-1][0].shape) >= 8:
        levels.append((_halved(levels[-1][0]), _halved(levels[-1][1])))
    tx, ty = whole_translation(*levels[-1])
    error = 0.0
    for level in range(len(levels) - 1, -1, -1):
        if level < len(levels) - 1:
            tx, ty = 2 * tx, 2 * ty
        r, m = map(_smoothed, levels[level])
        tx, ty, error = _climb(r, spline_coefficients(m), float(tx), float(ty), rounds)
    return tx, ty, error if math.isfinite(error) else 0.0


def least_squares_translation(ref: np.ndarray, mov: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """The translation of ``least_squares`` alone."""
    return least_squares(ref, mov, rounds)[:2]


#: Frames of a position that follow each other in one task.
BLOCK = 32


def _blocked(frames: DataFrame, mode: str | int, block: int) -> DataFrame:
    """Blocks of a position's frames, each headed by what its frames are compared with: the reference, or the frame before the block.

    A reference goes once to each block, not to each frame; of a block's frames the last one goes to the next block too. What is
    ranked are blocks, never pixels.
    """
    rows = frames.select("fov", "t", "h", "w", "pixels", F.floor(F.col("t") / block).cast("long").alias("block"), F.lit(False).alias("head"))
    blocks = rows.groupBy("fov", "block").agg(F.max("t").alias("t"))
    if mode == "previous":
        own = blocks.select("fov", "t", F.lead("block").over(Window.partitionBy("fov").orderBy("block")).alias("next")).where("next is not null")
        heads = rows.join(own, ["fov", "t"]).select("fov", "t", "h", "w", "pixels", F.col("next").alias("block"), F.lit(True).alias("head"))
    else:
        shapes = rows.groupBy("fov").agg(F.min("h").alias("h"), F.min("w").alias("w"))
        heads = blocks.select("fov", "block").join(reference(frames, mode).join(shapes, "fov"), "fov")
        heads = heads.select("fov", F.lit(None).cast(rows.schema["t"].dataType).alias("t"), "h", "w", F.col("reference").alias("pixels"), "block", F.lit(True).alias("head"))
    both = rows.withColumn("pixels", F.col("pixels").cast("array<double>")).unionByName(heads.withColumn("pixels", F.col("pixels").cast("array<double>")))
    spark = frames.sparkSession
    # an explicit number: pixels are few bytes for the work they make, so partitions must not be put together by size
    number = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return both.repartition(number, "fov", "block").sortWithinPartitions("fov", "block", F.desc("head"), "t")


def _translations(blocked: DataFrame, backend: str, moves: bool) -> DataFrame:
    """fov, t, tx, ty and residual of the frames of ``_blocked``, each against the head of its block or, if the reference ``moves``, the frame before."""

    def found(ref: np.ndarray | None, mov: np.ndarray | None) -> tuple[float, float, float | None]:
        if ref is None or mov is None or ref.shape != mov.shape:
            return 0.0, 0.0, None
        return least_squares(ref, mov) if backend == "least_squares" else (*phase_translation(ref, mov), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ref = None, None
        for batch in batches:
            rows, out = [], []
            keys = zip(*(batch.column(n).to_pylist() for n in ("fov", "block", "head")), strict=True)
            for k, ((*own, head), image) in enumerate(zip(keys, kernels.images(*(batch.column(n) for n in ("pixels", "h", "w"))), strict=True)):
                if own != block:
                    block, ref = own, None
                if not head:
                    rows.append(k)
                    out.append(found(ref, image))
                if head or (moves and image is not None):
                    ref = None if image is None else image.astype(float)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("fov").take(at), batch.column("t").take(at), *(pa.array([f[k] for f in out], pa.float64()) for k in range(3))], names=["fov", "t", "tx", "ty", "residual"])

    return blocked.mapInArrow(run, f"fov string, t {blocked.schema['t'].dataType.simpleString()}, tx double, ty double, residual double")


def one_channel(frames: DataFrame, channel: str | None = None) -> DataFrame:
    """The frames of a channel in the first focus plane; without a name, of the first channel of each position in order of names."""
    frames = first_plane(frames)
    if channel is not None:
        return frames.where(F.col("c") == channel)
    return frames.join(frames.groupBy("fov").agg(F.min("c").alias("c")), ["fov", "c"], "left_semi")


def prepared(frames: DataFrame, channel: str | None = None, y: tuple[int | None, int | None] | None = None, x: tuple[int | None, int | None] | None = None, downsample: int = 1) -> DataFrame:
    """Frames as they are registered: one channel, cut to a region, as block means; give ``downsample`` to ``register`` too."""
    kept = one_channel(frames, channel)
    return block_means(select_roi(kept, y, x) if y or x else kept, downsample)


def register(frames: DataFrame, mode: str | int = "mean", backend: str = "least_squares", downsampled: int = 1, channel: str | None = None) -> DataFrame:
    """fov, t, tx and ty of every position and time, in raw pixels if frames were downsampled by a factor.

    mode: the reference is the mean, the first, the last or a numbered frame of
    the position; or ``previous``, the frame before, and translations add up.
    One channel is registered: the named one, else the first of each position.
    """
    found = register_with_residuals(frames, mode, backend, channel)
    if downsampled < 1:
        raise ValueError("downsampled must be positive")
    return found.select("fov", "t", *((F.col(k) * downsampled).alias(k) for k in ("tx", "ty")))


def register_with_residuals(frames: DataFrame, mode: str | int = "mean", backend: str = "least_squares", channel: str | None = None, block: int = BLOCK) -> DataFrame:
    """As ``register`` without a factor, with residual: the mean squared difference that is left (least squares; null without a reference)."""
    if backend not in BACKENDS:
        raise ValueError(f"unknown backend {backend!r}")
    if backend == "phase" and mode == "previous":
        raise ValueError("the phase backend needs a fixed reference")
    frames = one_channel(frames, channel)
    found = _translations(_blocked(frames, mode, block), backend, mode == "previous")
    return cumulated(found) if mode == "previous" else found


def drift(transforms: DataFrame, times: DataFrame) -> DataFrame:
    """fov, t, hours, tx and ty for plotting."""
    return transforms.join(times.select("fov", "t", "t_ms"), ["fov", "t"]).select("fov", "t", (F.col("t_ms") / 3.6e6).alias("hours"), "tx", "ty")
