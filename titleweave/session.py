"""Spark session defaults and the two ways this package cuts lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "titleweave", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="titleweave-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def freeze(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later stages read files, so a lost executor replays nothing."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Cuts lineage as ``freeze`` does, with column pruning and statistics kept.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """Hadoop file system of ``path`` and a function turning text into its path objects."""
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), to_path


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A parquet table, or no rows when nothing has been written yet."""
    files, to_path = file_system(spark, path)
    if files.exists(to_path(path)):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


# Largest table that is sent to every executor; measured, not estimated.
MAX_BROADCAST_BYTES = 64 * 2**20


def _width(value: Column, kind: DataType) -> Column | None:
    """Bytes that a value takes, about; None for a type whose values cannot be sized."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, ArrayType):
        if isinstance(kind.elementType, (StringType, BinaryType)):
            inner = F.aggregate(value, F.lit(0), lambda s, x: s + F.coalesce(F.octet_length(x), F.lit(0)) + 16)
        elif isinstance(kind.elementType, (ArrayType, MapType, StructType)):
            return None
        else:
            inner = F.size(value) * 16
        return F.coalesce(inner, F.lit(0)) + 16
    if isinstance(kind, StructType):
        parts = [_width(value[f.name], f.dataType) for f in kind.fields]
        return None if None in [p if p is None else 0 for p in parts] else sum(parts, F.lit(16))
    return None if isinstance(kind, MapType) else F.lit(16)


def hint_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Measure a staged or checkpointed table and hint a broadcast only if it is within the bound.

    Above the bound the join stays a shuffle join.
    """
    widths = [_width(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields]
    if any(w is None for w in widths):
        return df  # what cannot be measured is not broadcast
    size = sum(widths, F.lit(32)).cast("bigint")
    total = df.agg(F.sum(size)).first()[0] or 0
    return F.broadcast(df) if total <= max_bytes else df


def broadcast_if_small(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Checkpoint a table and hint a broadcast if it is small.

    Worth it where the other side is much larger: adaptive execution alone would first
    shuffle that side and only then see that it need not have.
    """
    return hint_if_small(freeze(df), max_bytes)
