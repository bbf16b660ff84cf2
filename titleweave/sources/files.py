"""Files of a lake as rows: listed by Spark, Parquet footers read by tasks, data pages left alone."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

_OWN = ["path", "modificationTime", "length", "content"]


def list_files(spark: SparkSession, path: str, names: str = "*.parquet") -> DataFrame:
    """One row per file: ``path``, ``file`` (as ``_metadata.file_path`` writes it), ``bytes``,
    ``modified`` and the partition columns. No file is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).load(path)
    partitions = [c for c in files.columns if c not in _OWN]
    return files.select(
        "path", F.col("_metadata.file_path").alias("file"), F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"), *partitions,
    )


def open_file(path: str) -> pa.NativeFile:
    """Random access from a task: only the bytes asked for are fetched."""
    if path.startswith(("file:", "/")):
        return fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return system.open_input_file(inner)


def with_footers(files: DataFrame) -> DataFrame:
    """``files`` with ``n_rows`` and ``columns`` (top-level names) from each Parquet footer at ``path``.

    A task fetches the end of each file, whatever its size. A file that is no Parquet fails the job
    and is named.
    """
    found = [StructField("n_rows", LongType()), StructField("columns", ArrayType(StringType()))]
    schema = StructType([*files.schema.fields, *found])

    def footer(path: str) -> tuple[int, list[str]]:
        with open_file(path) as source:
            try:
                parquet = pq.ParquetFile(source)
            except pa.ArrowInvalid as error:
                raise ValueError(f"no Parquet footer in {path}") from error
            return parquet.metadata.num_rows, parquet.schema_arrow.names

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            footers = [footer(path) for path in batch.column("path").to_pylist()]
            n_rows = pa.array([n for n, _ in footers], pa.int64())
            columns = pa.array([names for _, names in footers], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, n_rows, columns], names=schema.names)

    return files.mapInArrow(read, schema)
