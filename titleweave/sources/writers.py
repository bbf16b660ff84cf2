"""Sinks. Each is one partitioned write; the file committer makes it all-or-nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleweave.operators.ledger import ledger_entries
from titleweave.schemas import NEWSWIRE_CROSSWALK, WEB_CROSSWALK
from titleweave.session import file_system, read_or_empty, stage
from titleweave.sources import versions

TITLE_PARTITIONS = ["source", "year", "month", "day"]


def _overwrite_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace only the partitions present in ``df``. AQE's REBALANCE keeps one day in few
    files yet splits a day that is much larger than the rest."""
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_daily(df: DataFrame, path: str) -> None:
    """Titles by source/year/month/day of ``date`` (``YYYY-MM-DD`` text)."""
    day = F.to_date("date")
    parts = {"year": F.year(day), "month": F.month(day), "day": F.day(day)}
    rows = df.select("headline", "source_url", "date", "source").withColumns(parts)
    _overwrite_partitions(rows, path, TITLE_PARTITIONS)


def write_monthly(
    df: DataFrame, path: str, ts: str = "gkg_date", processed: DataFrame | None = None,
    ledger_path: str | None = None, source: str = "web",
) -> None:
    """Web titles by year/month of their timestamp.

    ``processed`` lists the months (``month``, a first of month) that were fetched without error. Each
    gets a row in the ledger with its count; one without rows loses what an earlier run wrote for it, so a
    month that turned out empty reads as empty and is not fetched again. Months are few: they reach the driver.
    """
    rows = df.withColumns({"year": F.year(ts), "month": F.month(ts)})
    _overwrite_partitions(rows, path, ["year", "month"])
    if processed is None:
        return
    written = df.select(F.lit(source).alias("source"), F.trunc(F.to_date(ts), "month").alias("day"))
    done = processed.select(F.lit(source).alias("source"), F.col("month").alias("day")).distinct()
    entries = ledger_entries(done, written).select(
        "source", F.col("day").alias("month"), "row_count", F.current_timestamp().alias("done_at")
    )
    entries = stage(entries, "months-done")
    files, to_path = file_system(df.sparkSession, path)
    for entry in entries.where("row_count = 0").collect():
        for month in {f"{entry.month.month}", f"{entry.month.month:02d}"}:
            files.delete(to_path(f"{path}/year={entry.month.year}/month={month}"), True)
    entries.write.mode("append").parquet(ledger_path)


def write_inventory(
    inventory: DataFrame, processed: DataFrame, path: str, ledger_path: str, source: str
) -> None:
    """Daily URL inventory, then one ledger row per processed day, empty days included.

    ``processed`` holds the days (column ``day``) that were enumerated without error; a
    failed day is simply not in it and stays pending.
    """
    day = F.to_date("date")
    parts = {"year": F.year(day), "month": F.month(day), "day": F.day(day)}
    _overwrite_partitions(inventory.withColumns(parts), path, ["year", "month", "day"])
    done = processed.select(F.lit(source).alias("source"), "day")
    rows = inventory.select(F.lit(source).alias("source"), day.alias("day"))
    # Version 2 files have the slug column; the ledger says what the file really holds.
    version = 2 if "headline_from_slug" in inventory.columns else 1
    entries = ledger_entries(done, rows, schema_version=version).withColumn("done_at", F.current_timestamp())
    entries.write.mode("append").parquet(ledger_path)


def write_crosswalk(crosswalk: DataFrame, path: str) -> None:
    """Crosswalk by month (``ym``), replacing only the months present; as a new version where the
    table is published."""
    spark = crosswalk.sparkSession
    if versions.current(spark, path)[0]:
        none = spark.createDataFrame([], "month date")
        replace_crosswalk_months(crosswalk, none, path)
        return
    _overwrite_partitions(crosswalk.withColumn("ym", F.date_format("date", "yyyy-MM")), path, ["ym"])


def replace_crosswalk_months(crosswalk: DataFrame, months: DataFrame, path: str) -> None:
    """Publish rebuilt months (``month``, first of month) in one step; one that no longer has any
    match is gone in the new version. Readers see the months of before until then."""
    month = F.date_format("date", "yyyy-MM")
    versions.publish_parts(crosswalk, path, month, months.select(F.date_format("month", "yyyy-MM")))


def combine_crosswalk(spark: SparkSession, path: str, url: str = "nw_source_url") -> DataFrame:
    """All months together, ordered by date and URL; no rows if no month has a match. The published
    version if there is one, else the months as ``write_crosswalk`` left them."""
    schema = NEWSWIRE_CROSSWALK if url == "nw_source_url" else WEB_CROSSWALK
    if versions.current(spark, path)[0]:
        return versions.read(spark, path, schema).orderBy("date", url)
    return read_or_empty(spark, path, f"{schema}, ym string").drop("ym").orderBy("date", url)


def write_merged(merged: DataFrame, path: str) -> None:
    """Publish the enriched feed as a new version; ``versions.read`` finds it."""
    versions.publish(merged, path)


def relayout_flat_to_hive(spark: SparkSession, flat: str, target: str) -> DataFrame:
    """Copy flat ``YYYY-MM.parquet`` files to year=/month= and return the row counts.

    Months already at the target are left alone. The result has one row per month with the
    source and target counts and ``ok``; source files are never removed.
    """
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{4})-(\d{2})\.parquet$", 1)
    month = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{4})-(\d{2})\.parquet$", 2)
    source = (
        spark.read.parquet(flat)
        .withColumns({"_y": name, "_m": month})
        .filter("_y != ''")
        .withColumns({"year": F.col("_y").cast("int"), "month": F.col("_m").cast("int")})
        .drop("_y", "_m")
    )
    keys = ["year", "month"]
    done = read_or_empty(spark, target, "year int, month int").distinct()
    todo = source.join(done, keys, "left_anti")
    todo.select(*source.columns).write.mode("append").partitionBy(*keys).parquet(target)
    before = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows"))
    after = spark.read.parquet(target).groupBy(*keys).agg(F.count(F.lit(1)).alias("target_rows"))
    return (
        before.join(after, keys, "left")
        .na.fill(0, ["target_rows"])
        .withColumn("ok", F.col("source_rows") == F.col("target_rows"))
    )
