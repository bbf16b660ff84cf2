"""Resumable batch work: which days are done, pending, late or due again.

The ledger is a table with one row per finished (source, day); a day without rows is still
recorded, because a partitioned write leaves nothing behind for it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleweave.functions.dates import days_in_month

# First month for which a source has usable sitemaps.
FIRST_COVERAGE = {"globenewswire": "2023-04", "newswireca": "2011-01"}


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Days of [start, end) as a DataFrame with one column, ``day``."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    days = F.explode(F.sequence(first, last, F.expr("interval 1 day")))
    return spark.range(1).select(days.alias("day")).filter(F.col("day") < last)


def ledger_entries(
    processed: DataFrame, data: DataFrame, schema_version: int = 1, input_version: str = ""
) -> DataFrame:
    """Ledger rows for the processed (source, day) list, with the row count of each."""
    counts = data.groupBy("source", "day").agg(F.count(F.lit(1)).alias("row_count"))
    return processed.join(counts, ["source", "day"], "left").select(
        "source",
        "day",
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
        F.lit(schema_version).alias("schema_version"),
        F.lit(input_version).alias("input_version"),
    )


def pending_days(days: DataFrame, ledger: DataFrame) -> DataFrame:
    """(source, day) to do: wanted and not in the ledger."""
    return days.join(ledger.select("source", "day").distinct(), ["source", "day"], "left_anti")


def pending_months(months: DataFrame, ledger: DataFrame) -> DataFrame:
    """(source, month) to do; a month recorded with no rows is done."""
    return months.join(ledger.select("source", "month").distinct(), ["source", "month"], "left_anti")


def first_incomplete_day(days: DataFrame, ledger: DataFrame) -> DataFrame:
    """Earliest pending day per source."""
    return pending_days(days, ledger).groupBy("source").agg(F.min("day").alias("day"))


def month_status(ledger: DataFrame, as_of: Column | str, marked: DataFrame | None = None) -> DataFrame:
    """Per (source, month): done and expected days, and whether the month is complete.

    A month is complete when all its days are done (up to ``as_of`` for the running month),
    or when it is listed in ``marked`` (source, month).
    """
    month = F.trunc("day", "month")
    done = ledger.groupBy("source", month.alias("month")).agg(F.countDistinct("day").alias("done_days"))
    if marked is not None:
        explicit = marked.select("source", "month").distinct().withColumn("_marked", F.lit(True))
        done = done.join(explicit, ["source", "month"], "full")
    else:
        done = done.withColumn("_marked", F.lit(False))
    expected = days_in_month(F.col("month"), as_of)
    count = F.coalesce("done_days", F.lit(0))
    return done.select(
        "source",
        "month",
        count.alias("done_days"),
        expected.alias("expected_days"),
        (F.coalesce("_marked", F.lit(False)) | (count >= expected)).alias("complete"),
    )


def latest_entries(ledger: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The value of ``column`` in the last entry of each key; entries without ``done_at`` are the oldest.

    An append-only ledger keeps what was true before; only the last entry says what is.
    """
    when = F.col("done_at") if "done_at" in ledger.columns else F.lit(None).cast("timestamp")
    place = F.struct(F.coalesce(when, F.lit(0).cast("timestamp")), column)
    return ledger.groupBy(*keys).agg(F.max(place)[column].alias(column))


def months_to_rebuild(inputs: DataFrame, ledger: DataFrame) -> DataFrame:
    """(source, month) whose input is new, gone, or of another version than the one last processed.

    A source that is gone has a last entry with a version; once its month is rebuilt its entry
    has none.
    """
    keys = ["source", "month"]
    done = latest_entries(ledger, keys, "input_version").withColumnRenamed("input_version", "_done")
    both = inputs.select(*keys, "input_version").join(done, keys, "full")
    return both.where(~F.col("input_version").eqNullSafe(F.col("_done"))).select(*keys)


def flag_late_rows(rows: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows with ``late`` set when their (source, day) was already finished.

    The plain re-run policy is to drop them: ``.filter("not late")``.
    """
    done = ledger.select("source", "day").distinct().withColumn("late", F.lit(True))
    return rows.join(done, ["source", "day"], "left").withColumn("late", F.coalesce("late", F.lit(False)))


def days_due_again(ledger: DataFrame, schema_version: int) -> DataFrame:
    """Days last written with an older schema: the ones a forced re-run must redo."""
    last = latest_entries(ledger, ["source", "day"], "schema_version")
    return last.filter(F.col("schema_version") < schema_version).select("source", "day")


def after_first_coverage(
    months: DataFrame, first: dict[str, str] = FIRST_COVERAGE
) -> DataFrame:
    """Drop (source, ``YYYY-MM``) before the source's first month; unlisted sources stay."""
    pairs = [F.lit(x) for item in first.items() for x in item]
    begins = F.try_element_at(F.create_map(*pairs), F.col("source"))
    return months.filter(begins.isNull() | (F.col("month") >= begins))


def in_month_prefix(rows: DataFrame, month: str, date: str = "date") -> DataFrame:
    """Entries of a monthly archive that really belong to its month (``YYYY-MM``)."""
    return rows.filter(F.col(date).startswith(month))
