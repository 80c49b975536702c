"""Stores of results: Parquet tables with a manifest each, complete only when the manifest says so.

All paths go through Spark's file systems, so a store may lie anywhere that Spark reads.
"""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.names import canonical_json
from ..operators import trenches
from . import chunks

SECTIONS = ("registration", "means", "lanes", "trenches")


def scratch(spark: SparkSession) -> str:
    """A new path for a store in the folder of ``spark.checkpoint.dir``; where none is set, in a local session as in tests, in a temporary one."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{(folder or tempfile.mkdtemp(prefix='spark-')).rstrip('/')}/store-{uuid.uuid4().hex}"


_MANIFEST = "params string, complete boolean"


class Store:
    """A checkpoint store with a section a stage: a table, its parameters, and a mark that it is complete."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _at(self, path: str):
        """A path and the file system that it lies in."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def _exists(self, path: str) -> bool:
        p, system = self._at(path)
        return system.exists(p)

    def _delete(self, path: str) -> None:
        p, system = self._at(path)
        system.delete(p, True)

    def _write_params(self, section: str, params: dict, complete: bool) -> None:
        row = [(canonical_json(params), complete)]
        self.spark.createDataFrame(row, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{section}/manifest")

    def save(self, section: str, table: DataFrame, params: dict) -> None:
        """Mark incomplete, replace the table, mark complete: a crash between leaves an incomplete section."""
        if section not in SECTIONS:
            raise ValueError(f"unknown section {section!r}")
        self._write_params(section, params, False)
        table.write.mode("overwrite").parquet(f"{self.path}/{section}/table")
        self._write_params(section, params, True)

    def has(self, section: str) -> bool:
        return self._manifest(section)["complete"]

    def _manifest(self, section: str) -> dict:
        """Parameters and mark of a section; one that is missing, or whose manifest was lost while it was written, is incomplete."""
        path = f"{self.path}/{section}/manifest"
        r = self.spark.read.schema(_MANIFEST).parquet(path).first() if self._exists(path) else None
        return {"params": r["params"], "complete": r["complete"]} if r else {"params": "{}", "complete": False}

    def load(self, section: str) -> DataFrame:
        if not self.has(section):
            raise RuntimeError(f"section {section!r} is not complete")
        return self.spark.read.parquet(f"{self.path}/{section}/table")

    def matches(self, section: str, params: dict) -> bool:
        """Whether a complete section was made with equal parameters."""
        return self._manifest(section) == {"params": canonical_json(params), "complete": True}

    def params(self, section: str) -> dict:
        """The parameters that a complete section was made with."""
        known = self._manifest(section)
        if not known["complete"]:
            raise RuntimeError(f"section {section!r} is not complete")
        return json.loads(known["params"])

    def attributes(self) -> dict:
        """What the store says of its source; empty before it is said."""
        path = f"{self.path}/attributes"
        return json.loads(self.spark.read.parquet(path).first()["attributes"]) if self._exists(path) else {}

    def set_attributes(self, attributes: dict) -> None:
        row = [(canonical_json(attributes),)]
        self.spark.createDataFrame(row, "attributes string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/attributes")

    def exists(self) -> bool:
        return self._exists(self.path)

    def make(self) -> None:
        """Make the folder if it isn't there."""
        path, system = self._at(self.path)
        system.mkdirs(path)

    def size(self) -> int:
        """The bytes of all files at the path."""
        path, system = self._at(self.path)
        return system.getContentSummary(path).getLength()

    def wipe(self, everything: bool = False) -> None:
        """Delete all sections; what the store says of its source, crops and metadata groups stay unless ``everything`` goes."""
        self.reset(SECTIONS[0])
        if everything:
            for part in ("crops", "manifest", "transforms", "metadata", "attributes"):
                self._delete(f"{self.path}/{part}")

    def __repr__(self) -> str:
        return f"Store at {self.path} (complete: {', '.join(s for s in SECTIONS if self.has(s)) or 'nothing'})"

    def drop(self, section: str) -> None:
        """Delete one section alone."""
        if section not in SECTIONS:
            raise ValueError(f"unknown section {section!r}")
        self._delete(f"{self.path}/{section}")

    def reset(self, section: str) -> None:
        """Delete a section and those of the stages after it."""
        for name in SECTIONS[SECTIONS.index(section) :]:
            self._delete(f"{self.path}/{name}")


def pending(frames: DataFrame, done: DataFrame) -> DataFrame:
    """Frames of positions that are not completed."""
    return frames.join(done.select("fov"), "fov", "left_anti")


def _open(spark: SparkSession, path: str, fingerprint: str, resume: bool) -> DataFrame | None:
    """The positions that a store of crops has, or None; what it holds is deleted without ``resume``, and another fingerprint refused."""
    store = Store(spark, path)
    if not resume:
        for part in ("crops", "manifest", "transforms"):
            store._delete(f"{path}/{part}")
    if not store._exists(f"{path}/manifest"):
        return None
    kept = spark.read.parquet(f"{path}/manifest")
    if kept.where(F.col("fingerprint") != fingerprint).limit(1).count():
        raise RuntimeError("the store was written with other trenches or settings")
    return kept


def _write_missing(names: DataFrame, kept: DataFrame | None, table, path: str, fingerprint: str, batch: int, options: dict[str, str]) -> list[str]:
    """Write ``table(names)`` of the missing positions, a batch at a time, and record each batch's positions once they are written."""
    spark = names.sparkSession
    missing = sorted(r.fov for r in (names if kept is None else pending(names, kept)).collect())
    for at in range(0, len(missing), batch):
        own = missing[at : at + batch]
        table(own).write.mode("overwrite").options(partitionOverwriteMode="dynamic", **options).partitionBy("fov").parquet(f"{path}/crops")
        spark.createDataFrame([(f, fingerprint) for f in own], "fov string, fingerprint string").coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return missing


def write_crops(crops: DataFrame, path: str, fingerprint: str, resume: bool = True, compression: str = "zstd", batch: int = 16, positions: DataFrame | None = None, level: int = 3) -> None:
    """Write crops with a folder a position, ``batch`` positions at a time; a run that goes on writes the missing positions only.

    A batch's positions are recorded once they are written, so a crash loses a
    batch at most.  A store of another fingerprint is refused with RuntimeError; without
    ``resume`` what the store holds is deleted first.  positions: a table with the names in ``fov``; without it they are read from the
    crops.  Every batch computes its crops anew, so what they are made of should be stored; see ``extract``.
    """
    names = (crops if positions is None else positions).select("fov").distinct()
    kept = _open(crops.sparkSession, path, fingerprint, resume)
    _write_missing(names, kept, lambda own: crops.where(F.col("fov").isin(own)), path, fingerprint, batch, chunks.write_options(compression, level))


def extract(
    frames: DataFrame, transforms: DataFrame, boxes: DataFrame, path: str, degrees: float = 0.0, time_chunk: int | None = None, dtype: str = "uint16", compression: str = "zstd", level: int = 3,
    byte_shuffle: bool = True, resume: bool = True, batch: int = 16, settings: dict | None = None, groups: dict[str, DataFrame] | None = None, attributes: dict | None = None,
) -> list[str]:
    """Cut all trenches from all frames and write them as chunks, with the metadata groups and attributes beside them; the positions written.

    Transforms are written to the store first, so no batch of positions computes them again; each batch reads its own
    frames only.  A run that goes on takes the transforms that the store has, so what they depend on belongs in ``settings``; with other
    trenches or settings it is refused.
    """
    trenches.uniform_shape(boxes)
    spark, path = frames.sparkSession, path.rstrip("/")
    known = {"degrees": degrees, "time_chunk": time_chunk, "dtype": dtype, "codec": compression, "level": level, "byte_shuffle": byte_shuffle, **(settings or {})}
    if not resume:
        _open(spark, path, "", False)
    if not Store(spark, path)._exists(f"{path}/transforms/_SUCCESS"):
        transforms.write.mode("overwrite").parquet(f"{path}/transforms")
    moved = spark.read.parquet(f"{path}/transforms")
    fingerprint = trenches.fingerprint(boxes, canonical_json(known), moved).first().fingerprint
    kept = _open(spark, path, fingerprint, True)
    options = chunks.write_options(compression, level)

    def table(own: list[str]) -> DataFrame:
        here = F.col("fov").isin(own)
        cut = trenches.crops(frames.where(here), moved.where(here), boxes.where(here), degrees, integers=not dtype.startswith("float"))
        return chunks.pack(cut, time_chunk, dtype, byte_shuffle)

    written = _write_missing(boxes.select("fov").distinct(), kept, table, path, fingerprint, batch, options)
    write_groups(path, **(groups or {}))
    store = Store(spark, path)
    store.set_attributes(store.attributes() | (attributes or {}) | {"extraction": known, "fingerprint": fingerprint})
    return written


GROUPS = ("source_frames", "events", "acquisition")


def write_groups(path: str, **groups: DataFrame) -> None:
    """Write the metadata tables that belong to crops beside them: source_frames, events and acquisition, each replaced whole.

    A table without columns (no records were found) is left out, and an old one of its name deleted.
    """
    if unknown := sorted(set(groups) - set(GROUPS)):
        raise ValueError(f"unknown groups {unknown}; there are {list(GROUPS)}")
    for name, table in groups.items():
        if table.columns:
            table.write.mode("overwrite").parquet(f"{path}/metadata/{name}")
        else:
            Store(table.sparkSession, path)._delete(f"{path}/metadata/{name}")


def read_group(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """A metadata table of a store, or None if it has none."""
    at = f"{path}/metadata/{name}"
    return spark.read.parquet(at) if Store(spark, path)._exists(at) else None
