"""Structured Streaming forms of the incremental work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from titleweave.functions.text import has_text


def ingest_available(
    source: DataFrame, path: str, checkpoint: str, partitions: list[str]
) -> StreamingQuery:
    """Append everything that has landed since the last run to a partitioned lake, then stop.

    The checkpoint remembers which files are done, and the file sink commits each batch
    atomically, so a run can be killed and repeated. Schedule it, or drop the trigger for a
    long-lived query.
    """
    return (
        source.filter(has_text(F.col("headline")))
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partitions)
        .trigger(availableNow=True)
        .start()
    )


def dedup_titles(stream: DataFrame, ts: str = "gkg_date", delay: str = "31 days") -> DataFrame:
    """First arrival per (month, title). State is bounded by the watermark delay.

    Arrival order decides here, not the timestamp; feed files in day order, or finish with
    the batch form, to get the earliest.
    """
    return (
        stream.withColumn(ts, F.col(ts).cast("timestamp"))
        .withWatermark(ts, delay)
        .withColumn("_month", F.date_format(ts, "yyyy-MM"))
        .dropDuplicatesWithinWatermark(["_month", "headline"])
        .drop("_month")
    )


def daily_counts(stream: DataFrame, ts: str, delay: str = "1 day", by: list[str] | None = None) -> DataFrame:
    """Rows per day (and ``by``), emitted when the watermark has passed the day."""
    day = F.window(ts, "1 day")
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    return (
        timed.withWatermark(ts, delay)
        .groupBy(day.alias("_day"), *(by or []))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_date("_day.start").alias("date"), *(by or []), "n")
    )


def with_open_days(closed: DataFrame, rows: DataFrame, ts: str, by: list[str] | None = None) -> DataFrame:
    """Closing batch pass: the stream's counts of closed days, and batch counts of all later days.

    ``closed`` is what ``daily_counts`` has written, ``rows`` the table behind the stream. A day
    is open until the watermark has passed it; here it is counted as it stands now.
    """
    last = closed.agg(F.max("date")).scalar()
    day = F.to_date(F.col(ts).cast("timestamp"))
    later = rows.where(last.isNull() | (day > last)).groupBy(day.alias("date"), *(by or []))
    return closed.unionByName(later.agg(F.count(F.lit(1)).alias("n")).select("date", *(by or []), "n"))


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what is there, write it to parquet and return when done."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stream_parquet(spark: SparkSession, path: str, schema, glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """File stream over a folder of parquet files."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
