"""1-D profiles as arrays: smoothing, convolution and peaks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T


def as_array(profile: DataFrame, keys: list[str], place: str, value: str = "profile") -> DataFrame:
    """One row a profile: its values in the order of ``place``."""
    return profile.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct(place, value))), lambda s: s[value]).alias("profile"))


def gaussian_weights(sigma: float) -> list[float]:
    """Normalised weights that reach 4 sigma to both sides."""
    radius = int(4 * sigma + 0.5)
    w = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    return [float(x) for x in w / w.sum()]


#: Multiplications up to which a profile is convolved directly.
_DIRECT = 1 << 22


def smooth_values(values: np.ndarray, sigma: float) -> np.ndarray:
    """Smoothed values of one profile.  What is mirrored at both ends has a period of twice the length, so a long profile is
    smoothed by one product of spectra, whatever the sigma is."""
    n = len(values)
    if sigma <= 0 or not n:
        return values
    w = np.array(gaussian_weights(sigma))
    radius = len(w) // 2
    mirrored = np.concatenate((values, values[::-1]))
    if n * len(w) <= _DIRECT:
        return np.convolve(mirrored[np.arange(-radius, n + radius) % (2 * n)], w, "valid")
    kernel = np.bincount(np.arange(-radius, radius + 1) % (2 * n), weights=w, minlength=2 * n)
    found = np.fft.irfft(np.fft.rfft(mirrored) * np.fft.rfft(kernel), 2 * n)[:n]
    grain = 2.0 ** np.ceil(np.log2(max(np.abs(values).max(), 1e-300)) - 40)  # flat parts stay flat
    return np.round(found / grain) * grain


def _by_profile(change) -> Column:
    """An Arrow function that changes each profile; null ones stay null, and a null value counts as not a number."""

    @F.arrow_udf("array<double>")
    def run(profile: pa.Array, parameter: pa.Array) -> pa.Array:
        flat, bounds = profile.values.to_numpy(zero_copy_only=False), profile.offsets.to_numpy()
        parts = [change(flat[bounds[k] : bounds[k + 1]], p) if profile[k].is_valid else np.zeros(0) for k, p in enumerate(parameter.to_pylist())]
        ends = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32))
        values = pa.array(np.concatenate(parts) if parts else np.zeros(0))
        return pa.ListArray.from_arrays(ends, values, mask=profile.is_null()) if profile.null_count else pa.ListArray.from_arrays(ends, values)

    return run


def gaussian_smooth(profile: Column, sigma: float | Column) -> Column:
    """Smoothed values; beyond its ends the profile is mirrored, the end value repeated.  Sigma 0 (or null) changes nothing; a column gives each profile its own."""
    if not isinstance(sigma, Column):
        if sigma <= 0:
            return profile
        sigma = F.lit(float(sigma))
    return _by_profile(lambda values, s: smooth_values(values, s or 0.0))(profile.cast("array<double>"), sigma.cast("double"))


def convolve(profile: Column, kernel: list[float]) -> Column:
    """Full convolution divided by the kernel's sum; longer than the profile by the kernel's length less one."""
    weights = np.array(kernel, float) / float(sum(kernel))
    return _by_profile(lambda values, _: np.convolve(values, weights) if len(values) else values)(profile.cast("array<double>"), F.lit(0.0))


def _lowest_before(height: list[float], low: list[float]) -> list[float]:
    """Of each node the lowest value between it and the last higher node before it.

    low: the lowest between a node and the one before.  Nodes that are not higher are passed over together, so each is looked at once.
    """
    out, stack = [], []
    for h, least in zip(height, low, strict=True):
        while stack and stack[-1][0] <= h:
            least = min(least, stack.pop()[1])
        stack.append((h, least))
        out.append(least)
    return out


def prominences(values: np.ndarray, found: np.ndarray) -> np.ndarray:
    """How far each peak rises above the higher of the two lowest places that part it from higher ground (or an end)."""
    if not len(found):
        return np.zeros(0)
    # nodes: the peaks' plateaus and both ends, which may be higher than any peak
    change = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    level = values[change]
    rises, falls = np.append(True, level[1:] > level[:-1]), np.append(level[:-1] > level[1:], True)
    node = np.flatnonzero(rises & falls)
    height = level[node].tolist()
    cuts = np.unique(np.append(0, node))
    between = np.minimum.reduceat(level, cuts)
    if cuts[0] != node[0]:  # the start lies lower than the first node
        low, last = between, between[-1]
    else:
        low, last = np.append(level[0], between[:-1]), between[-1]
    left = _lowest_before(height, low.tolist()[: len(node)])
    right = _lowest_before(height[::-1], [last, *low.tolist()[1 : len(node)][::-1]])[::-1]
    of = np.searchsorted(change[node], found, side="right") - 1
    return values[found] - np.maximum(left, right)[of]


def peaks_of(values: np.ndarray, height: float | None, distance: float | None, prominence: float | None) -> np.ndarray:
    """Places of the peaks: local maxima, filtered by height, then distance (the tallest first), then prominence."""
    change = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, int)
    level, last = values[change], np.append(change[1:], len(values)) - 1
    inner = np.arange(1, len(change) - 1)
    top = inner[(level[inner] > level[inner - 1]) & (level[inner] > level[inner + 1])] if len(change) > 2 else inner[:0]
    found = (change[top] + last[top]) // 2  # the middle of a plateau
    if height is not None:
        found = found[values[found] >= height]
    if distance is not None and distance > 1:
        place, kept = found.tolist(), [True] * len(found)
        for k in np.argsort(values[found], kind="stable")[::-1].tolist():
            if kept[k]:
                # kept peaks lie apart, so a peak is passed at most from both sides
                for step in (-1, 1):
                    other = k + step
                    while 0 <= other < len(place) and abs(place[other] - place[k]) < distance:
                        kept[other] = False
                        other += step
        found = found[np.array(kept, bool)]
    if prominence is not None:
        found = found[prominences(values, found) >= prominence]
    return found


def find_peaks(profiles: DataFrame, keys: list[str], height: float | None = None, distance: float | None = None, prominence: float | None = None) -> DataFrame:
    """keys, ``peak`` (its place) and ``value``, a row a peak.

    A column of the name of a threshold overrides it for the profile, where it is not null.
    """
    limits = {"height": height, "distance": distance, "prominence": prominence}
    columns = [F.coalesce(F.col(k).cast("double") if k in profiles.columns else F.lit(None).cast("double"), F.lit(v).cast("double")).alias(f"__{k}") for k, v in limits.items()]
    rows = profiles.select(*keys, F.col("profile").cast("array<double>").alias("__profile"), *columns)
    schema = T.StructType([rows.schema[k] for k in keys]).add("peak", "integer").add("value", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, peak, value = [], [], []
            for i, r in enumerate(batch.select(["__profile", *(f"__{k}" for k in limits)]).to_pylist()):
                values = np.array(r["__profile"] or [], float)
                found = peaks_of(values, *(r[f"__{k}"] for k in limits))
                owner += [i] * len(found)
                peak += found.tolist()
                value += values[found].tolist()
            at = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(at) for k in keys), pa.array(peak, pa.int32()), pa.array(value, pa.float64())], names=schema.names)

    return rows.mapInArrow(run, schema)
