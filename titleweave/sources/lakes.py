"""Parquet tables of the engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleweave import schemas
from titleweave.functions.dates import nanos_to_timestamp


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """Title lake, partitioned by source/year/month/day."""
    return spark.read.schema(schemas.TITLES).parquet(path)


def read_web_titles(spark: SparkSession, path: str) -> DataFrame:
    """Web title lake, partitioned by year/month."""
    return spark.read.schema(schemas.WEB_TITLES).parquet(path)


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Reference feed; a nanosecond ``timestamp_utc`` is read as a long and converted."""
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    feed = spark.read.parquet(path)
    if feed.schema["timestamp_utc"].dataType.typeName() == "long":
        feed = feed.withColumn("timestamp_utc", nanos_to_timestamp(F.col("timestamp_utc")))
    return feed


def read_feed_by_year(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Yearly feed tables (``year=YYYY`` below ``path``) from start to end year.

    One partitioned scan: years that do not exist contribute nothing, unread years are pruned.
    """
    first, last = int(start[:4]), int(end[:4])
    return read_feed(spark, path).filter((F.col("year") >= first) & (F.col("year") <= last))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """URL inventory; files older than ``headline_from_slug`` yield null for it."""
    return spark.read.schema(schemas.INVENTORY).parquet(path)


def read_constituents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CONSTITUENTS).parquet(path)


def read_names_lookup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.NAMES_LOOKUP).parquet(path)


def filter_to_month(df: DataFrame, month: str) -> DataFrame:
    """``YYYY-MM`` by the partition columns, so other months are not even listed."""
    return df.filter((F.col("year") == int(month[:4])) & (F.col("month") == int(month[5:7])))
