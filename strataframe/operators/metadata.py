"""Acquisition metadata as tables: frames, events and channels."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.names import snake_name

#: The custom blocks that are kept where a file has them.
CUSTOM_BLOCKS = ["AcqTimeV1_0", "AppInfo_V1_0", "CustomDataV2_0", "GrabberCameraSettingsV1_0"]


def source_frames(fovs: DataFrame, times: DataFrame, frame_json: DataFrame) -> DataFrame:
    """One row a position and time with the scalars of its first channel; frames without metadata have nulls."""
    grid = fovs.crossJoin(times)  # the axes of one experiment
    read = grid.join(frame_json, ["p_index", "t"], "left")
    return read.select("fov", "p_index", "t", *frame_scalars(F.col("json")), F.coalesce("json", F.lit("")).alias("frame_metadata_json"))


def frame_scalars(text: Column) -> list[Column]:
    """Time, Julian day, stage position, focus offset and position name from a frame's JSON (channel 0)."""

    def number(path: str) -> Column:
        return F.get_json_object(text, f"$.channels[0].{path}").try_cast("double")

    stage = [F.coalesce(number(f"position.stagePositionUm.{axis}"), number(f"position.stagePositionUm[{k}]")).alias(axis) for k, axis in enumerate("xyz")]
    return [
        number("time.relativeTimeMs").alias("relative_time_ms"),
        number("time.absoluteJulianDayNumber").alias("absolute_julian_day_number"),
        F.struct(*stage).alias("stage_position_um"),
        number("position.pfsOffset").alias("pfs_offset"),
        F.coalesce(F.get_json_object(text, "$.channels[0].position.name"), F.lit("")).alias("position_name"),
    ]


def split_events(records: DataFrame, fovs: DataFrame, times: DataFrame, text: str = "json") -> tuple[DataFrame, DataFrame]:
    """Frame events of the given positions and times (first focus plane), and all other events.

    A record is a frame event if it has the key ``Index``; a missing place counts as 0.
    """
    record = F.from_json(text, "map<string,string>")
    rows = records.withColumn("__record", record)
    is_frame = F.coalesce(F.map_contains_key("__record", "Index"), F.lit(False))

    def place(key: str) -> Column:
        return F.coalesce(F.col("__record")[key].try_cast("int"), F.lit(0))

    frames = rows.where(is_frame).withColumns({"__p": place("P Index"), "__t": place("T Index"), "__z": place("Z Index")}).where("__z = 0")
    frames = frames.join(fovs.select(F.col("p_index").alias("__p")), "__p", "left_semi").join(times.select(F.col("t").alias("__t")), "__t", "left_semi")
    return frames.drop("__p", "__t", "__z", "__record"), rows.where(~is_frame).drop("__record")


def _fields(text: str) -> T.StructType:
    """The fields of a schema of variants; objects are structs."""
    parts = re.split("(`(?:[^`]|``)*`)", text)
    return T._parse_datatype_string("".join(p if k % 2 else p.replace("OBJECT<", "STRUCT<").replace("STRUCT<>", "STRING") for k, p in enumerate(parts)))


def _value(record: str, key: str, kind: str) -> Column:
    """The value of a record's key, or null if it isn't of the kind; paths know no escapes, so a key of both quotes goes by a map."""
    if "'" in key and '"' in key:
        return F.try_variant_get(F.try_variant_get(record, "$", "map<string,variant>")[key], "$", kind)
    quote = '"' if "'" in key else "'"
    return F.try_variant_get(record, f"$[{quote}{key}{quote}]", kind)


def _kinds(records: DataFrame, text: str) -> dict[str, tuple[str, bool]]:
    """Of every key of the records its type and whether its values are objects or lists.

    Records are parsed once a pass: one pass finds the schema that all share, one counts nulls.  Keys are column names, so they are few.
    """
    values = records.where(F.ltrim(text).startswith("{")).select(F.try_parse_json(text).alias("v"))
    found = values.agg(F.schema_of_variant_agg("v").alias("schema")).first().schema
    fields = _fields(found).fields if found and found.startswith("OBJECT<") and found != "OBJECT<>" else []
    if not fields:
        return {}
    present = [F.count(F.when(F.is_variant_null(_value("v", f.name, "variant")), 1)).alias(f"n{k}") for k, f in enumerate(fields)]
    nulls = values.agg(*present).first()
    kinds = {}
    for k, f in enumerate(fields):
        kind = f.dataType
        if isinstance(kind, T.BooleanType):
            name = "object" if nulls[k] else "bool"
        elif isinstance(kind, T.NullType):
            name = "object"
        elif isinstance(kind, T.LongType):
            name = "float64" if nulls[k] else "int64"
        elif isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
            whole = isinstance(kind, T.DecimalType) and kind.scale == 0 and not nulls[k]
            name = "int64" if whole and kind.precision < 19 else "float64"
        else:
            name = "string"
        kinds[f.name] = name, isinstance(kind, (T.StructType, T.ArrayType))
    return kinds


def key_types(records: DataFrame, text: str = "json") -> DataFrame:
    """Every key of the records, and the type of its column.

    bool, long or double if all values are; a null makes a bool an object and
    a long a double; strings stay; anything mixed is a string.  Texts that aren't JSON objects have no keys.
    """
    kinds = _kinds(records, text)
    return records.sparkSession.createDataFrame([(key, kind) for key, (kind, _) in sorted(kinds.items())], "key string, type string")


def records_table(records: DataFrame, prefix: str, text: str = "json", without: tuple[str, ...] = (), scalars: bool = False) -> DataFrame:
    """Records as columns: one for each key, sorted, named in snake case with a prefix (if not empty); the key is kept in the column's metadata.

    Of keys with equal names the last counts.  Objects and lists are kept as JSON, or with ``scalars`` left out; keys ``without`` are too.
    Every record is parsed once.
    """
    kinds = {k: kind for k, (kind, nested) in _kinds(records, text).items() if k not in without and not (scalars and nested)}
    cast = {"bool": "boolean", "int64": "bigint", "float64": "double", "string": "string", "object": "string"}
    columns = {}
    for key in sorted(kinds):
        value = _value("__record", key, cast[kinds[key]])
        if kinds[key] == "string":
            value = F.coalesce(value, F.lit(""))
        name = "_".join(filter(None, (prefix, snake_name(key))))
        columns[name] = value.alias(name, metadata={"source_name": key})
    return records.withColumn("__record", F.try_parse_json(text)).select(*[c for c in records.columns if c != text], *columns.values())


def acquisition_channels(document: DataFrame, names: list[str] | None = None, text: str = "json") -> DataFrame:
    """One row a channel: its place, its name, and its settings as a map; names replace the file's if they are as many."""
    channels = document.select(F.posexplode(F.from_json(F.get_json_object(text, "$.metadata.channels"), "array<map<string,string>>")).alias("channel_index", "settings"))
    name = F.col("settings")["name"]
    if names:
        count = document.select(F.size(F.from_json(F.get_json_object(text, "$.metadata.channels"), "array<map<string,string>>")).alias("__n"))
        channels = channels.crossJoin(F.broadcast(count))  # one document
        name = F.when(F.col("__n") == len(names), F.get(F.array(*map(F.lit, names)), F.col("channel_index"))).otherwise(name)
    return channels.select("channel_index", name.alias("channel"), F.map_filter("settings", lambda k, v: (k != "name") & ~v.startswith("{") & ~v.startswith("[")).alias("settings"))


def custom_blocks(blocks: Column) -> Column:
    """Those of the kept custom blocks that a map of blocks has."""
    return F.map_filter(blocks, lambda k, v: k.isin(CUSTOM_BLOCKS))
