"""Published tables: a reader sees one whole version, whatever a writer is doing or died at.

A table's folder holds ``data/``, Parquet folders that never change once written, and ``versions/``,
one small numbered file for each version, which names the folders of all its parts. The largest
number is the current version. A writer puts its data in place, writes the version under a hidden
name and renames it to the next number; that rename is the only step a reader can see. Two writers
cannot take one number: the rename refuses to replace, and the second writer fails.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleweave.session import file_system, stage

WHOLE = ""  # the part of a table that is replaced as one


def _numbers(spark: SparkSession, path: str) -> list[int]:
    files, to_path = file_system(spark, path)
    folder = to_path(f"{path}/versions")
    if not files.exists(folder):
        return []
    names = [f.getPath().getName() for f in files.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if not n.startswith("."))


def _parts(spark: SparkSession, path: str, number: int) -> dict[str, str]:
    return json.loads(spark.read.text(f"{path}/versions/{number:08d}.json", wholetext=True).first()[0])


def current(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """Number of the current version and its folders (below ``path``) by part; 0 and none if there is none."""
    numbers = _numbers(spark, path)
    return (numbers[-1], _parts(spark, path, numbers[-1])) if numbers else (0, {})


def commit(spark: SparkSession, path: str, number: int, parts: dict[str, str]) -> None:
    """Make ``parts`` version ``number``; fails if that version exists."""
    files, to_path = file_system(spark, path)
    files.mkdirs(to_path(f"{path}/versions"))
    hidden = to_path(f"{path}/versions/.{uuid.uuid4().hex}")
    out = files.create(hidden, False)
    out.write(bytearray(json.dumps(parts, sort_keys=True).encode()))
    out.close()
    sc, fs = spark.sparkContext, spark.sparkContext._jvm.org.apache.hadoop.fs
    never = sc._gateway.new_array(getattr(fs, "Options$Rename"), 0)  # no option: refuse to replace
    context = fs.FileContext.getFileContext(files.getUri(), sc._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(hidden), files.makeQualified(to_path(f"{path}/versions/{number:08d}.json")), never)


def retire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the last ``keep`` versions and the data that only they name.

    A reader that has resolved a version may read it until ``keep`` newer ones are there. What a
    writer that died left in ``data/`` is named by no version and stays.
    """
    files, to_path = file_system(spark, path)
    numbers = _numbers(spark, path)
    kept = {f for n in numbers[-keep:] for f in _parts(spark, path, n).values()}
    for n in numbers[:-keep]:
        for folder in set(_parts(spark, path, n).values()) - kept:
            files.delete(to_path(f"{path}/{folder}"), True)
        files.delete(to_path(f"{path}/versions/{n:08d}.json"), False)


def publish(df: DataFrame, path: str, keep: int = 2) -> int:
    """Replace the whole table by ``df``; returns the new version's number."""
    spark = df.sparkSession
    number, _ = current(spark, path)
    folder = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    commit(spark, path, number + 1, {WHOLE: folder})
    retire(spark, path, keep)
    return number + 1


def publish_parts(df: DataFrame, path: str, part: Column, replaced: DataFrame, keep: int = 2) -> int:
    """Replace the parts that ``replaced`` lists (one text column) by the rows of ``df``, by their ``part``.

    A listed part without rows is gone in the new version; rows of parts that are not listed replace
    these too; all other parts are taken over as they are, without reading them. Part names reach
    the driver: they are few, such as months. A folder of ``name=value`` partitions written before
    the first version counts as version 0.
    """
    spark = df.sparkSession
    rows = stage(df.withColumn("_part", part), "parts")
    names = {r[0] for r in rows.select("_part").distinct().collect()}
    gone = {r[0] for r in replaced.distinct().collect()}
    number, parts = current(spark, path)
    if not number:
        parts = _plain_partitions(spark, path)
    folder = f"data/{uuid.uuid4().hex}"
    rows.hint("rebalance", "_part").write.partitionBy("_part").parquet(f"{path}/{folder}")
    kept = {name: place for name, place in parts.items() if name not in names | gone}
    commit(spark, path, number + 1, {**kept, **{name: f"{folder}/_part={name}" for name in names}})
    retire(spark, path, keep)
    return number + 1


def _plain_partitions(spark: SparkSession, path: str) -> dict[str, str]:
    files, to_path = file_system(spark, path)
    if not files.exists(to_path(path)):
        return {}
    names = [f.getPath().getName() for f in files.listStatus(to_path(path)) if f.isDirectory()]
    return {n.split("=", 1)[1]: n for n in names if "=" in n}


def read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The current version. With ``schema``, a table without version or parts has no rows."""
    _, parts = current(spark, path)
    if not parts:
        if schema is None:
            raise FileNotFoundError(f"no version published at {path}")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*[f"{path}/{folder}" for folder in sorted(parts.values())])
