"""A data source for raw files of frames: a folder with a file a position and one that describes them all.

``frames.json`` holds the sizes of the axes T, C, Y and X, the type of a pixel, the names of positions
and channels, and the times; the file of a position holds its frames as they come, times slowest, little-endian.
``read`` gives them as frame tables.  Work is planned in ranges of times of a position; the positions,
times and channels that ``read`` is asked for choose files and places in them, so what needs
one frame opens one file and reads the bytes of that frame; columns that aren't asked for are not made.  The choice
is made of options, not of the query's filters: Spark 4.1 keeps what filters left of a Python source with the table, where
another query on it, or the other side of a join, would find it.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

NAME = "rawframes"
DESCRIPTION = "frames.json"
SCHEMA = "fov string, p_index int, t int, t_ms double, c string, c_index int, h int, w int, pixels array<double>"
#: Most bytes of frames in a partition (one time at least).
RANGE_BYTES = 64 << 20


def write(frames_of: dict[str, np.ndarray], path: str, channels: list[str], times_ms: list[float] | None = None) -> None:
    """Write arrays (time, channel, y, x) of one shape and type by the name of their position."""
    system, at = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)
    system.create_dir(at, recursive=True)
    first = next(iter(frames_of.values()))
    files = []
    for p, stack in enumerate(frames_of.values()):
        if stack.shape != first.shape or stack.dtype != first.dtype:
            raise ValueError("all positions must have one shape and type")
        files.append(f"{p}.raw")
        with system.open_output_stream(f"{at}/{p}.raw") as out:
            out.write(np.ascontiguousarray(stack).astype(stack.dtype.newbyteorder("<")).tobytes())
    sizes = dict(zip("TCYX", first.shape, strict=True))
    about = {"sizes": sizes, "dtype": first.dtype.name, "positions": list(frames_of), "files": files, "channels": channels, "times_ms": times_ms or [0.0] * sizes["T"]}
    with system.open_output_stream(f"{at}/{DESCRIPTION}") as out:
        out.write(json.dumps(about).encode())


class Times(InputPartition):
    """Times from ``start`` to before ``end`` of one position."""

    def __init__(self, position: int, start: int, end: int):
        self.position, self.start, self.end = position, start, end


class RawReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, choice: dict):
        self.path, self.names, self.schema, self.choice = path, schema.names, schema, choice

    def _open(self):
        return pyarrow.fs.FileSystem.from_uri(self.path) if "://" in self.path else (pyarrow.fs.LocalFileSystem(), self.path)

    def _about(self) -> dict:
        system, at = self._open()
        with system.open_input_stream(f"{at}/{DESCRIPTION}") as f:
            return json.loads(f.read())

    def partitions(self) -> list[InputPartition]:
        about = self._about()
        sizes = about["sizes"]
        step = max(1, RANGE_BYTES // max(1, sizes["C"] * sizes["Y"] * sizes["X"] * np.dtype(about["dtype"]).itemsize))
        first, last, _ = slice(self.choice["start"], self.choice["end"]).indices(sizes["T"])
        fovs = self.choice["fovs"]
        wanted = [p for p, name in enumerate(about["positions"]) if fovs is None or name in fovs or p in fovs]
        return [Times(p, start, min(start + step, last)) for p in wanted for start in range(first, last, step)] or [Times(0, 0, 0)]

    def read(self, partition: Times) -> Iterator[pa.RecordBatch]:
        about = self._about()
        sizes, kind = about["sizes"], np.dtype(about["dtype"]).newbyteorder("<")
        h, w = sizes["Y"], sizes["X"]
        items = h * w
        channels = self.choice["channels"]
        wanted = [(t, c) for t in range(partition.start, partition.end) for c in range(sizes["C"]) if channels is None or about["channels"][c] in channels]
        if not wanted:
            return
        p = partition.position
        source = None
        if "pixels" in self.names:
            system, at = self._open()
            source = system.open_input_file(f"{at}/{about['files'][p]}")
        schema = pa.schema([(f.name, {"fov": pa.string(), "c": pa.string(), "t_ms": pa.float64(), "pixels": pa.list_(pa.float64())}.get(f.name, pa.int32())) for f in self.schema])
        for t, c in wanted:
            row = {"fov": about["positions"][p], "p_index": p, "t": t, "t_ms": float(about["times_ms"][t]), "c": about["channels"][c], "c_index": c, "h": h, "w": w}
            columns = []
            for field in schema:
                if field.name == "pixels":
                    data = source.read_at(items * kind.itemsize, (t * sizes["C"] + c) * items * kind.itemsize)
                    columns.append(pa.array([np.frombuffer(data, kind).astype(float)], field.type))
                else:
                    columns.append(pa.array([row[field.name]], field.type))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
        if source is not None:
            source.close()


class RawFrames(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> RawReader:
        return RawReader(self.options["path"].rstrip("/"), schema, json.loads(self.options["choice"]))


def read(
    spark: SparkSession, path: str, columns: list[str] | None = None, fovs: list[str | int] | None = None, start: int | None = None, end: int | None = None, channels: list[str] | None = None,
) -> DataFrame:
    """The frames of a folder; FileNotFoundError if it has no description.

    With names, only those columns are made; with positions (names or places), times ``[start, end)`` as a Python slice, or channels, only those are read.
    """
    system, at = pyarrow.fs.FileSystem.from_uri(path) if "://" in path else (pyarrow.fs.LocalFileSystem(), path)
    if system.get_file_info(f"{at.rstrip('/')}/{DESCRIPTION}").type == pyarrow.fs.FileType.NotFound:
        raise FileNotFoundError(f"no raw frames at {path}")
    spark.dataSource.register(RawFrames)
    kinds = dict(part.split(" ", 1) for part in SCHEMA.split(", "))
    choice = {"fovs": fovs, "start": start, "end": end, "channels": channels}
    return spark.read.format(NAME).schema(", ".join(f"{c} {kinds[c]}" for c in columns or kinds)).option("choice", json.dumps(choice)).load(path)
