"""Counts by day from a stream, and the rows that come after their day was closed.

Both are written by one batch function. A batch overwrites its own folders and is entered in a
ledger last, so a batch that is replayed after a crash changes nothing, and readers take only
batches that are in the ledger. A row is either counted or kept as late, never neither.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from titleweave.session import read_or_empty

LEDGER = "latest timestamp, n_counted bigint, n_late bigint, batch bigint"


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """One row per finished batch."""
    return read_or_empty(spark, f"{path}/ledger", LEDGER)


def _closed_before(entries: DataFrame, delay: str) -> Column:
    """The first day that is still open: the latest time seen less the delay."""
    return F.to_date(F.max("latest") - F.expr(f"interval {delay}"))


def _write_batch(batch: DataFrame, number: int, path: str, ts: str, by: list[str], delay: str) -> None:
    spark = batch.sparkSession
    entries = ledger(spark, path)
    if not entries.where(F.col("batch") == number).isEmpty():
        return
    open_from = entries.where(F.col("batch") < number).agg(_closed_before(entries, delay)).first()[0]
    rows = batch.withColumn(ts, F.col(ts).cast("timestamp")).withColumn("_day", F.to_date(ts))
    late = F.col("_day").isNull() if open_from is None else F.col("_day").isNull() | (F.col("_day") < F.lit(open_from))
    counts = rows.where(~late).groupBy(F.col("_day").alias("date"), *by).agg(F.count(F.lit(1)).alias("n"))
    counts.write.mode("overwrite").parquet(f"{path}/counts/batch={number}")
    rows.where(late).drop("_day").write.mode("overwrite").parquet(f"{path}/late/batch={number}")
    entry = rows.agg(F.max(ts).alias("latest"), F.count_if(~late).alias("n_counted"), F.count_if(late).alias("n_late"))
    entry.coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/batch={number}")


def count_days(stream: DataFrame, path: str, checkpoint: str, ts: str, by: list[str] | None = None, delay: str = "1 day") -> StreamingQuery:
    """Count what has landed since the last run by day (and ``by``), and keep late rows apart.

    A day is closed once a time ``delay`` after its end was seen in an earlier batch. Rows of a closed
    day, and rows without a time, go to the late rows.
    """
    return (
        stream.writeStream.foreachBatch(lambda batch, number: _write_batch(batch, number, path, ts, by or [], delay))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _finished(spark: SparkSession, path: str, kind: str) -> DataFrame:
    done = ledger(spark, path).select("batch")
    return spark.read.option("basePath", f"{path}/{kind}").parquet(f"{path}/{kind}").join(done, "batch", "left_semi")


def day_counts(spark: SparkSession, path: str, by: list[str] | None = None, delay: str = "1 day") -> DataFrame:
    """date, ``by``, n and ``closed`` as of the last finished batch."""
    entries = ledger(spark, path)
    open_from = entries.agg(_closed_before(entries, delay)).scalar()
    counts = _finished(spark, path, "counts").groupBy("date", *(by or [])).agg(F.sum("n").alias("n"))
    return counts.withColumn("closed", F.coalesce(F.col("date") < open_from, F.lit(False)))


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every late row with the batch it came in."""
    return _finished(spark, path, "late")
