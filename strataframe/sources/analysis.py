"""The stages of an analysis over one store: drift, mean images, lanes, trenches, crops.

Every stage is a table with the parameters that it was made with, and with a mark of the
stages that it was made from.  What a store holds is taken if both still hold; if
not, the stage and all that lies behind it are made anew, and nothing else.  Parameters that older stores don't have
count as the values that were the only ones then.
"""

from __future__ import annotations

import dataclasses
import hashlib
from typing import Any

from pyspark.sql import DataFrame, functions as F

from ..functions.names import canonical_json
from ..functions.plain import plain
from ..operators import geometry, means, registration, selection, trenches
from . import frames as frame_tables, store as stores
from .experiment import Experiment, store_summary

#: Which way transforms map: from places of the output to places of the input.
CONVENTION = "output_to_input"
#: Of each stage the stages before it, its parameters, and those that older stores lack with what they were then.
STAGES: dict[str, tuple[tuple[str, ...], dict[str, Any], dict[str, Any]]] = {
    "registration": (
        (), {"channel": None, "backend": "least_squares", "mode": "mean", "rotation": 0.0, "roi": {}, "mean_n_frames": 10, "mean_from": "end", "downsample": 1, "transform_convention": CONVENTION},
        {"backend": "least_squares"},
    ),
    "means": (("registration",), {"channel": None}, {}),
    "lanes": (("means",), {"sigma": 40.0, "distance": 300, "height": 5000, "window_um": 20.0}, {}),
    "trenches": (
        ("means", "lanes"),
        {"sigma": 4.0, "distance": 100, "prominence": 10, "height": 0, "trench_width": 32, "trench_length": 160, "trench_bottom_offset": 50, "conv_filter": None, "lane_params": {}, "least_band": 100},
        {"conv_filter": None, "least_band": 100},
    ),
}
#: Of each stage's table the columns and their types.
SCHEMAS = {
    "registration": {"fov": "string", "t": "int", "tx": "double", "ty": "double"},
    "means": {"fov": "string", "c": "string", "h": "int", "w": "int", "pixels": "array<double>"},
    "lanes": {"fov": "string", "lane_index": "int", "y_center": "int", "orientation": "int"},
    "trenches": {"trench_id": "int", "fov": "string", "lane_index": "int", "x_left": "int", "x_right": "int", "y_top": "int", "y_bottom": "int", "orientation": "int", "needs_flip": "boolean"},
}


def _digest(params: dict[str, Any]) -> str:
    return hashlib.sha256(canonical_json(params).encode()).hexdigest()


@dataclasses.dataclass(repr=False)
class Analysis:
    """An experiment's stages in a store.  Parameters that aren't given have their defaults; unknown ones are refused."""

    experiment: Experiment
    store: stores.Store
    registration: dict[str, Any] = dataclasses.field(default_factory=dict)
    means: dict[str, Any] = dataclasses.field(default_factory=dict)
    lanes: dict[str, Any] = dataclasses.field(default_factory=dict)
    trenches: dict[str, Any] = dataclasses.field(default_factory=dict)

    def __post_init__(self) -> None:
        for stage, (_, defaults, _) in STAGES.items():
            if unknown := sorted(set(getattr(self, stage)) - set(defaults)):
                raise ValueError(f"{stage} has no parameters {unknown}")

    def params(self, stage: str) -> dict[str, Any]:
        """All parameters of a stage, as they are saved."""
        before, defaults, _ = STAGES[stage]
        known = defaults | getattr(self, stage)
        if stage == "registration":
            channel = known["channel"]
            known["channel"] = selection.resolve(channel, self.experiment.channel_names) if channel is not None else None
            known |= {"fov_names": self.experiment.fov_names, "source_subset_metadata": self.experiment.subset}
        if stage == "trenches":
            known["lane_params"] = {str(lane): values for lane, values in known["lane_params"].items()}
        return plain(known | {"upstream": {name: _digest(self.params(name)) for name in before}})

    def state(self, stage: str) -> str:
        """missing, other (made with other parameters, or from other stages) or ready."""
        if not self.store.has(stage):
            return "missing"
        return "ready" if self._as_now(stage) == self.params(stage) else "other"

    def _as_now(self, stage: str) -> dict[str, Any]:
        """The saved parameters, with those that an older store lacks; it has no mark of the stages before it either."""
        _, _, older = STAGES[stage]
        saved = older | self.store.params(stage)
        if stage == "registration" and saved.get("transform_convention") is None and not saved.get("rotation"):
            saved["transform_convention"] = CONVENTION  # without a rotation both ways are one
        if "upstream" not in saved:
            saved["upstream"] = self.params(stage)["upstream"]
        return saved

    def refresh(self) -> list[str]:
        """Delete the stages made with other parameters, and those behind them; their names."""
        gone: list[str] = []
        for stage, (before, _, _) in STAGES.items():
            behind = any(name in gone for name in before)
            if self.store.has(stage) and (behind or self.state(stage) == "other"):
                self.store.drop(stage)
                gone.append(stage)
            elif behind:
                gone.append(stage)
        return [stage for stage in STAGES if stage in gone]

    def load(self, stage: str) -> DataFrame:
        """The table of a stage that is ready; RuntimeError if it isn't, ValueError if its transforms run another way."""
        state = self.state(stage)
        if stage == "registration" and state != "missing" and self._as_now(stage).get("transform_convention") != CONVENTION:
            raise ValueError("the transforms were saved with another convention; register again")
        if state != "ready":
            raise RuntimeError(f"{stage} is not ready: {state}")
        return self.store.load(stage).select(*(F.col(c).cast(kind).alias(c) for c, kind in SCHEMAS[stage].items()))

    def _made(self, stage: str, make) -> DataFrame:
        self.refresh()
        if self.state(stage) != "ready":
            table = make()
            self.store.save(stage, table.select(*(F.col(c).cast(kind).alias(c) for c, kind in SCHEMAS[stage].items())), self.params(stage))
        return self.load(stage)

    def transforms(self) -> DataFrame:
        """fov, t, tx and ty, registered if the store doesn't have them."""

        def make() -> DataFrame:
            p = self.params("registration")
            region = {axis: tuple(p["roi"][axis]) if axis in p["roi"] else None for axis in "yx"}
            small = registration.prepared(self.experiment.frames, p["channel"], region["y"], region["x"], p["downsample"])
            return registration.register(small, p["mode"], p["backend"], p["downsample"])

        return self._made("registration", make)

    def mean_images(self) -> DataFrame:
        """fov, c, h, w and pixels: the mean of the first or last frames, without drift and rotated."""

        def make() -> DataFrame:
            p, channel = self.params("registration"), self.params("means")["channel"] or self.params("registration")["channel"]
            kept = means.edge_frames(registration.one_channel(self.experiment.frames, channel), p["mean_n_frames"], p["mean_from"])
            return means.mean_frames(geometry.warp(kept, moved, p["rotation"]))

        moved = self.transforms()
        return self._made("means", make)

    def lane_table(self) -> DataFrame:
        """One row a lane."""

        def make() -> DataFrame:
            p = self.params("lanes")
            return trenches.detect_lanes(frame_tables.pixels(image), p["sigma"], p["distance"], p["height"], p["window_um"], self.experiment.pixel_size_um)

        image = self.mean_images()
        return self._made("lanes", make)

    def trench_table(self) -> DataFrame:
        """One row a trench."""

        def make() -> DataFrame:
            p = {k: v for k, v in self.params("trenches").items() if k != "upstream"}
            overrides = {int(lane): values for lane, values in p.pop("lane_params").items()}  # JSON has made texts of the numbers
            positions = self.experiment.raw.select("fov", "p_index").distinct()
            return trenches.detect_trenches(frame_tables.pixels(image), lanes, overrides=overrides, positions=positions, **p)

        image, lanes = self.mean_images(), self.lane_table()
        return self._made("trenches", make)

    def extract(self, path: str, groups: dict[str, DataFrame] | None = None, discard: list[int] | None = None, **options: Any) -> list[str]:
        """Make what is missing of all stages and write the crops, but for the discarded trenches; the positions written."""
        boxes = self.trench_table()
        p = self.params("registration")
        boxes = trenches.discard(boxes, discard) if discard else boxes
        summary = store_summary(self.experiment, p)
        settings = {"stages": {stage: _digest(self.params(stage)) for stage in STAGES}}
        return stores.extract(selection.first_plane(self.experiment.frames), self.transforms(), boxes, path, p["rotation"], settings=settings, groups=groups, attributes=summary, **options)

    def _frames_of(self, fov: str, channel: str | int | None) -> DataFrame:
        """The frames of one position and channel (the registered one if none is named), by filters that reach the scan."""
        channel = self.params("registration")["channel"] if channel is None else selection.resolve(channel, self.experiment.channel_names)
        return registration.one_channel(self.experiment.select_fovs([fov]).frames, channel)

    def warp_frame(self, fov: str | int = 0, time: int = 0, channel: str | int | None = None) -> DataFrame:
        """One frame without drift and rotated, its values not cut to whole numbers. Numbers are places among what the selections leave."""
        moved, name, t = self.load("registration"), selection.resolve(fov, self.experiment.fov_names, "position"), self.experiment.times_left[time]
        own = moved.where((F.col("fov") == name) & (F.col("t") == t))
        return geometry.warp(self._frames_of(name, channel).where(F.col("t") == t), own, self.params("registration")["rotation"])

    def trench_stack(self, trench_id: int, channel: str | int | None = None) -> DataFrame:
        """One trench at all times, its values not cut to whole numbers, without writing; ValueError if there is no such trench."""
        moved, box = self.load("registration"), self.load("trenches").where(F.col("trench_id") == trench_id)
        place = box.select("fov").first()
        if place is None:
            raise ValueError(f"no trench {trench_id}")
        own = moved.where(F.col("fov") == place.fov)
        return trenches.crops(self._frames_of(place.fov, channel), own, box, self.params("registration")["rotation"], integers=False)

    def __repr__(self) -> str:
        return f"Analysis of {self.experiment.name!r} ({', '.join(f'{stage} {self.state(stage)}' for stage in STAGES)})"
