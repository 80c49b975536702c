"""What several operators need from the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: A value is common from so many rows on, and at most so many common values are sent to all tasks.
COMMON, MOST_COMMON = 1_000, 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, set as the session's checkpoint folder.

    Only where none is set, in a local session as in tests, a temporary folder is.
    """
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        set_to = context.getConf().get("spark.checkpoint.dir")
        if not set_to and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(set_to or tempfile.mkdtemp(prefix="spark-"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


_kept: dict[str, list[str]] = {}


def stored(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder; see ``discard`` and ``clear``."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out._stored_at = path
    _kept.setdefault(spark.sparkContext.applicationId, []).append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
    _kept[spark.sparkContext.applicationId].remove(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` has written and nothing reads any more."""
    for df in tables:
        _delete(df.sparkSession, df._stored_at)


def clear(spark: SparkSession) -> None:
    """Delete all tables that operators stored in this application; results not yet written are lost."""
    for path in list(_kept.get(spark.sparkContext.applicationId, [])):
        _delete(spark, path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like the given ones that the table doesn't have, in any letter case."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        out.append(name)
    return out


def looked_up(rows: DataFrame, table: DataFrame, key: str, spread: list[str], common: int = COMMON) -> DataFrame:
    """The rows with the columns of ``table`` for their key; rows without one are left out.

    table: stored, one row a key, with the number of its rows in ``n``.  Keys of
    ``common`` rows or more, the ``MOST_COMMON`` most common ones, are sent to
    all tasks, so their rows need no task of their own; they are dealt by the
    columns of ``spread`` instead.  What other keys have is joined by key, where the
    adaptive join can split a large partition, for both sides come straight from a shuffle.
    """
    values = [c for c in table.columns if c not in (key, "n")]
    often = table.where(F.col("n") >= common).orderBy(F.desc("n"), key).limit(MOST_COMMON)
    often = often.select(F.col(key), F.struct(*values).alias("__often"))
    rest = table.select(F.col(key).alias("__key"), F.lit(False).alias("__is_often"), F.struct(*values).alias("__rest"))
    rows = rows.join(F.broadcast(often), key, "left")
    is_often = F.col("__often").isNotNull()
    rows = rows.withColumns({"__is_often": is_often, "__key": F.when(is_often, F.xxhash64(*spread)).otherwise(F.col(key))})
    found = rows.join(rest, ["__key", "__is_often"], "left").withColumn("__value", F.coalesce("__often", "__rest")).where("__value is not null")
    return found.select(*(c for c in rows.columns if not c.startswith("__")), *(F.col(f"__value.{c}").alias(c) for c in values))
