"""What several operators share: word expressions, staged tables, row digests."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleweave.session import file_system, new_folder

SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a narrow intermediate table to the shared folder and read it back.

    Cuts lineage with column pruning and statistics kept; a lost executor loses nothing of it.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_and_free(df: DataFrame, folder: str, label: str) -> DataFrame:
    """``stage`` below ``folder``, and Spark removes the shuffle files behind the table as soon as it is written.

    Else they stay until the driver's collector comes by them, beside those of the next job."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, path = conf.get(key, None), f"{folder}/{label}-{uuid.uuid4().hex}"
    conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of staged tables that nothing reads any more."""
    files, to_path = file_system(spark, path)
    files.delete(to_path(path), True)


def words(text: Column) -> Column:
    """The maximal runs of characters other than ASCII white space; null and blank give none."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE))


def word_count(text: Column) -> Column:
    """Number of words as bigint."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE))).cast("bigint")


def unit(*values: Column) -> Column:
    """A fixed pseudo-random number in [0, 1) for these values."""
    return F.shiftrightunsigned(F.xxhash64(*values), 11) / F.lit(float(2**53))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
