"""Versions of inputs by what they hold: equal rows give equal versions, in any order and any files.

A version is the number of rows and two sums of row hashes. Sums add up over files, so a lake's
fingerprint table keeps them by file and only new files are read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleweave.session import hint_if_small, stage
from titleweave.sources import versions
from titleweave.sources.files import list_files

_SUMS = ["n_rows", "sum_a", "sum_b"]
FINGERPRINTS = (
    "file string, bytes bigint, modified timestamp, n_rows bigint, sum_a decimal(38,0), sum_b decimal(38,0)"
)


def _sums(columns: list[str]) -> list[Column]:
    values = [F.col(f"`{c}`") for c in columns]
    nulls = [v.isNull() for v in values]  # a hash passes over nulls, so where they stand is hashed too

    def total(*parts: Column) -> Column:
        return F.sum(F.xxhash64(*parts).cast("decimal(38,0)"))

    return [
        F.count(F.lit(1)).alias("n_rows"),
        total(*values, *nulls).alias("sum_a"),
        total(F.lit(1), *nulls, *values).alias("sum_b"),
    ]


def _version() -> Column:
    return F.concat_ws(":", *[F.coalesce(F.col(c), F.lit(0)).cast("string") for c in _SUMS])


def content_versions(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and the ``input_version`` of all rows of each; hashes are summed before the shuffle.

    Repeated rows count as often as they occur; a null, an empty text and a value moved to another
    column differ.
    """
    sums = rows.groupBy(*keys).agg(*_sums([c for c in rows.columns if c not in keys]))
    return sums.select(*keys, _version().alias("input_version"))


def lake_versions(
    spark: SparkSession, path: str, schema: str, keys: dict[str, Column], book: str
) -> DataFrame:
    """``input_version`` by ``keys`` (columns made of the partition columns) of the lake at ``path``.

    ``book`` is the published table of fingerprints by file. Files that it lists with this size
    and time are taken over unread; the partitions of all others are scanned, pruned by the partition
    columns. Files whose keys are null (no valid day) belong to no version. A lake without files
    gives no rows.
    """
    known = versions.read(spark, book, FINGERPRINTS)
    listed = list_files(spark, path)
    partitions = [c for c in listed.columns if c not in ("path", "file", "bytes", "modified")]
    same = ["file", "bytes", "modified"]
    state = F.when(F.col("sum_a").isNull() & F.col("n_rows").isNull(), "new").otherwise("known")
    files = stage(listed.drop("path").join(known, same, "left").withColumn("state", state), "lake-files")

    new = files.where("state = 'new'")
    rows = spark.read.schema(schema).parquet(path)
    digested = rows.columns
    touched = stage(new.select(*partitions).distinct().withColumn("state", F.lit("new")), "partitions")
    some = hint_if_small(touched).where("state = 'new'").drop("state")  # the filter lets the scan be pruned
    scanned = rows.select("*", F.col("_metadata.file_path").alias("file")).join(some, partitions, "left_semi")
    read = new.drop(*_SUMS).join(scanned.groupBy("file").agg(*_sums(digested)), "file", "left")
    book_now = files.where("state = 'known'").unionByName(read.fillna(0, _SUMS)).select(*same, *_SUMS)
    versions.publish(book_now, book)

    by_file = files.drop(*_SUMS).join(versions.read(spark, book, FINGERPRINTS), same)
    named = by_file.withColumns({f"_key_{name}": key for name, key in keys.items()}).dropna(
        subset=[f"_key_{name}" for name in keys]
    )
    sums = named.groupBy(*[f"_key_{name}" for name in keys]).agg(*[F.sum(c).alias(c) for c in _SUMS])
    return sums.select(*[F.col(f"_key_{name}").alias(name) for name in keys], _version().alias("input_version"))
