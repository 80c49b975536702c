"""An experiment: a table of frames of any axes, the selections made on it, and what is known of its source.

Frames come as Parquet, one row a position, time, channel and focus plane, of
which any axis may be missing.  Selections are kept as values and applied to
``frames`` when it is asked for, so they reach the scan as filters: positions both by
name and by number, whichever the source has.  Names and
counts are small aggregates over the columns of one axis, asked for once and passed on to
what is selected from an experiment; pixels are not read.
"""

from __future__ import annotations

import copy
import dataclasses
import json
from datetime import datetime, timezone
from functools import cached_property
from pathlib import PurePosixPath
from typing import Any

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.names import canonical_json
from ..functions.plain import is_scalar, plain, range_fields, without_nan
from ..operators import metadata, selection, trenches
from .store import Store

#: Fixed value: the name of the only position or channel of a table without that axis.
SINGLE = "single"
#: Versions of the layouts written here.
METADATA_VERSION, STORE_VERSION = 1, 1

Range = tuple[int | None, int | None]


def with_axes(raw: DataFrame) -> DataFrame:
    """The frames with fov, p_index, t and c, whatever of them the table has.

    Without positions or channels there is one, named ``single``; without times
    there is time 0.  Positions without numbers are numbered in the order of their names, 10 after 2; of
    these, equal names are one position.  Names of several numbered positions get
    ``-01``, ``-02``, ... in the order of the positions.
    """
    out = raw
    for name, value in (("t", F.lit(0)), ("c", F.lit(SINGLE))):
        if name not in raw.columns:
            out = out.withColumn(name, value)
    if "fov" not in raw.columns:
        number = F.col("p_index") if "p_index" in raw.columns else F.lit(0)
        name = F.concat(F.lit("XYPos:"), number.cast("string")) if "p_index" in raw.columns else F.lit(SINGLE)
        return out.withColumns({"fov": name, "p_index": number})
    out = out.withColumn("fov", F.col("fov").cast("string"))
    if "p_index" not in raw.columns:
        # one row a position: the window is as small as the axis
        names = out.select("fov").distinct().withColumn("p_index", (F.row_number().over(Window.orderBy(*trenches.position_order())) - 1).cast("int"))
        return out.join(names, "fov")
    names = selection.rename_duplicates(out.select("fov", "p_index").distinct(), "fov", "p_index")
    return out.drop("fov").join(names, "p_index")


@dataclasses.dataclass(frozen=True, repr=False)
class Experiment:
    """Frames of one source under selections; every selection gives a new experiment."""

    path: str
    raw: DataFrame
    document: dict[str, Any] = dataclasses.field(default_factory=dict)
    discarded: tuple[str, ...] = ()
    times: Range | None = None
    y: Range | None = None
    x: Range | None = None

    @property
    def frames(self) -> DataFrame:
        """The frames that the selections leave."""
        out = self.raw
        if self.discarded:
            gone = set(self.discarded)
            # one of the two is the source's own column, which the scan can filter
            out = selection.discard_fovs(out, list(self.discarded)).where(F.col("p_index").isin([p for p, name in self.raw_positions if name not in gone]))
        if self.times is not None:
            out = selection.select_times(out, *_resolved(self.times, self.raw_timepoints))
        return out if self.y is None and self.x is None else selection.select_roi(out, self.y, self.x)

    def _with(self, **changes: Any) -> Experiment:
        """An experiment of other selections that knows what this one knows of the source."""
        out = dataclasses.replace(self, **changes)
        out.__dict__.update({k: v for k, v in self.__dict__.items() if k in _KNOWN})
        return out

    def select_fovs(self, keep: list[str | int]) -> Experiment:
        """Keep the named positions, or those at the given places; of two calls, what both keep."""
        names = {name for name in self.raw_fov_names if name in keep} | {self.raw_fov_names[k] for k in keep if isinstance(k, int)}
        return self.discard_fovs([name for name in self.raw_fov_names if name not in names])

    def discard_fovs(self, drop: list[str]) -> Experiment:
        return self._with(discarded=tuple(dict.fromkeys([*self.discarded, *map(str, drop)])))

    def select_times(self, start: int | None, end: int | None) -> Experiment:
        """Times ``[start, end)`` of the source; the last call counts."""
        return self._with(times=(start, end))

    def select_roi(self, y: Range | None = None, x: Range | None = None) -> Experiment:
        """A region of the source's pixels; of each axis the last call counts."""
        return self._with(y=self.y if y is None else y, x=self.x if x is None else x)

    @property
    def name(self) -> str:
        return PurePosixPath(self.path).stem

    @cached_property
    def raw_positions(self) -> list[tuple[int, str]]:
        """Number and name of every position of the source."""
        return [(r.p_index, r.fov) for r in self.raw.select("p_index", "fov").distinct().orderBy("p_index").collect()]

    @property
    def raw_fov_names(self) -> list[str]:
        return [name for _, name in self.raw_positions]

    @property
    def fov_names(self) -> list[str]:
        return [name for name in self.raw_fov_names if name not in self.discarded]

    @cached_property
    def channel_names(self) -> list[str]:
        if "c_index" in self.raw.columns:
            return [r.c for r in selection.ordered_distinct(self.raw, "c", "c_index").orderBy("c_index").collect()]
        return [r.c for r in self.raw.select("c").distinct().orderBy("c").collect()]

    @cached_property
    def raw_timepoints(self) -> int:
        return (self.raw.agg(F.max("t")).first()[0] or 0) + 1

    @property
    def timepoints(self) -> int:
        return len(self.times_left)

    @property
    def times_left(self) -> range:
        """The source's times that the selection leaves."""
        return range(*_resolved(self.times or (None, None), self.raw_timepoints))

    @cached_property
    def focus_planes(self) -> int | None:
        """The number of focus planes, or None without that axis."""
        return self.raw.agg(F.max("z")).first()[0] + 1 if self.has_z else None

    @property
    def has_z(self) -> bool:
        return "z" in self.raw.columns

    @property
    def has_channels(self) -> bool:
        return self.channel_names != [SINGLE]

    @cached_property
    def time_interval_ms(self) -> float:
        """The distance of the first two times, 0 if there are none."""
        if "t_ms" not in self.raw.columns:
            return 0.0
        return float(selection.calibration(self.raw, "t", "t_ms", 0.0).first().step)

    @cached_property
    def pixel_size_um(self) -> float:
        """The distance of two pixels that the document or a column ``pixel_um`` gives, else 1."""
        known = self.document.get("file_summary", {}).get("pixel_size_um")
        if known is None and "pixel_um" in self.raw.columns:
            known = self.raw.agg(F.max("pixel_um")).first()[0]
        return 1.0 if known is None else float(known)

    @cached_property
    def plane_step_um(self) -> float:
        """The distance of the first two focus planes by a column ``z_um``, 1 without it, 0 if there are no two."""
        if not {"z", "z_um"} <= set(self.raw.columns):
            return 1.0
        return float(selection.calibration(self.raw, "z", "z_um", 0.0).first().step)

    @property
    def acquisition_metadata(self) -> dict[str, Any]:
        """A copy of the acquisition document."""
        return copy.deepcopy(self.document)

    # the names of the fields below are fixed values: stores of other programs that read them have the same
    @property
    def subset(self) -> dict[str, Any]:
        """What was selected of the source."""
        return {
            "raw_fov_names": self.raw_fov_names,
            "active_fov_names": self.fov_names,
            "discarded_fov_names": list(self.discarded),
            "time_slice": range_fields(self.times),
            "roi": {"y": range_fields(self.y), "x": range_fields(self.x)},
            "raw_timepoint_count": self.raw_timepoints,
            "active_timepoint_count": self.timepoints,
        }

    @property
    def attributes(self) -> dict[str, Any]:
        """What every store of this experiment says of its source."""
        return {"source_metadata_version": METADATA_VERSION, "source_acquisition_metadata": self.acquisition_metadata, "source_subset_metadata": self.subset}

    def __repr__(self) -> str:
        axes = {"P": len(self.fov_names), "T": self.timepoints, "C": len(self.channel_names)} | ({"Z": self.focus_planes} if self.has_z else {})
        sizes = ", ".join(f"{axis}={size}" for axis, size in axes.items())
        return f"Experiment {self.name!r} ({sizes}; {self.pixel_size_um:g} um a pixel, {self.time_interval_ms:g} ms a frame) at {self.path}"


#: What selections don't change.
_KNOWN = {name for name, value in vars(Experiment).items() if isinstance(value, cached_property)}


def _resolved(times: Range, n: int) -> Range:
    start, end, _ = slice(*times).indices(n)
    return start, end


def load(spark: SparkSession, path: str, document: str | None = None) -> Experiment:
    """The frames at a path and, if there is one, the acquisition document (one JSON file).

    A path where nothing is raises FileNotFoundError.
    """
    for wanted in filter(None, (path, document)):
        if not Store(spark, wanted).exists():
            raise FileNotFoundError(f"no frames or document at {wanted}")
    text = spark.read.text(document, wholetext=True).first() if document else None
    return Experiment(path.rstrip("/"), with_axes(spark.read.parquet(path)), json.loads(text.value) if text else {})


def acquisition_document(
    experiment: Experiment, structured: dict[str, Any], custom: dict[str, Any] | None = None, unstructured: dict[str, Any] | None = None, dtype: str = "uint16", legacy: bool = False,
) -> dict[str, Any]:
    """The acquisition document of an experiment: a summary of the file, its structured metadata, and its custom blocks.

    structured: metadata (with channels), experiment, attributes and text_info, as far as known.
    legacy: whether the frames come from a file of an old layout, which frame tables don't tell.
    """
    first = experiment.raw.select("h", "w").first()
    axes = {"T": experiment.raw_timepoints, "P": len(experiment.raw_fov_names)} | ({"Z": experiment.focus_planes} if experiment.has_z else {})
    axes |= {"C": len(experiment.channel_names), "Y": first.h if first else 0, "X": first.w if first else 0}
    blocks = plain(custom or {})
    return without_nan({
        "schema_version": METADATA_VERSION,
        "file_summary": {
            "source_file": experiment.path,
            "source_size_bytes": Store(experiment.raw.sparkSession, experiment.path).size(),
            "sizes": axes,
            "shape": list(axes.values()),
            "dtype": dtype,
            "is_legacy": legacy,
            "voxel_size_um": {"x": experiment.pixel_size_um, "y": experiment.pixel_size_um, "z": experiment.plane_step_um},
            "pixel_size_um": experiment.pixel_size_um,
            "time_interval_ms": experiment.time_interval_ms,
        },
        "structured": {part: plain(structured.get(part, [] if part == "experiment" else {})) for part in ("metadata", "experiment", "attributes", "text_info")},
        "custom": {
            "data": blocks,
            "selected": {k: v for k, v in blocks.items() if k in metadata.CUSTOM_BLOCKS},
            "custom_data_keys": sorted(blocks),
            "unstructured": plain(unstructured or {}),
            "unstructured_metadata_keys": sorted(unstructured or {}),
        },
    })


def acquisition_table(spark: SparkSession, document: dict[str, Any], channel_names: list[str] | None = None) -> DataFrame:
    """One row a channel: its place, its name, a typed column for each of its scalars, and the whole document as JSON.

    The column of names is ``c`` where they are the experiment's (the given ones,
    if they are as many as the document's channels), else ``acquisition_channel``.  A document without
    channels gives one row with the document alone.
    """
    whole = spark.createDataFrame([(canonical_json(plain(document)),)], "raw_json string")
    texts = F.from_json(F.get_json_object("raw_json", "$.structured.metadata.channels"), "array<string>")
    channels = whole.select("raw_json", F.posexplode(texts).alias("channel_index", "json"))
    count = channels.count()  # one document
    if not count:
        return whole
    ours = channel_names is None or len(channel_names) == count
    name = F.coalesce(F.nullif(F.get_json_object("json", "$.name"), F.lit("")), F.concat(F.lit("channel_"), F.col("channel_index")))
    if ours and channel_names:
        name = F.element_at(F.array(*(F.lit(str(n)) for n in channel_names)), F.col("channel_index") + 1)
    rows = channels.select("channel_index", name.alias("c" if ours else "acquisition_channel"), "json", "raw_json")
    found = metadata.records_table(rows, "", without=("name",), scalars=True)
    return found.select(*[c for c in found.columns if c != "raw_json"], "raw_json")


def open_store(experiment: Experiment) -> Store:
    """The store beside an experiment's frames; its source and birth are written once, names and metadata at every opening."""
    path = PurePosixPath(experiment.path)
    store = Store(experiment.raw.sparkSession, _beside(experiment.path, f"{path.stem}.strataframe"))
    known = store.attributes()
    birth = {"source": known.get("source", experiment.path), "created": known.get("created", datetime.now(timezone.utc).isoformat())}
    store.set_attributes(known | birth | {"fov_names": experiment.fov_names, "channel_names": experiment.channel_names} | experiment.attributes)
    return store


def diagnostics_folder(experiment: Experiment) -> str:
    """The folder for diagnostics beside an experiment's frames, made if it isn't there."""
    path = _beside(experiment.path, f"{experiment.name}_diagnostics")
    Store(experiment.raw.sparkSession, path).make()
    return path


def _beside(path: str, name: str) -> str:
    return f"{path.rpartition('/')[0]}/{name}" if "/" in path else name


def store_summary(experiment: Experiment, registration: dict[str, Any]) -> dict[str, Any]:
    """What a store of crops says of the run that made it."""
    return {
        "store_version": STORE_VERSION,
        "source": experiment.path,
        "experiment_name": experiment.name,
        "pixel_size_um": experiment.pixel_size_um,
        "registration_params": plain(registration),
        "source_metadata_version": METADATA_VERSION,
        "source_subset_metadata": experiment.subset,
    }
