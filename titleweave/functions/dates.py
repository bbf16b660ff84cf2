"""Calendar expressions and calendar DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _day(value: Column | str) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast("date")


def most_recent_quarter_end(d: Column) -> Column:
    """Last day before the quarter of ``d``; a quarter end maps to the one before it."""
    return F.date_sub(F.trunc(d, "quarter"), 1)


def next_quarter_start(d: Column) -> Column:
    return F.add_months(F.trunc(d, "quarter"), 3)


def end_of_month(d: Column) -> Column:
    return F.last_day(d)


def end_of_quarter(d: Column) -> Column:
    return F.date_sub(next_quarter_start(d), 1)


def parse_compact_timestamp(value: Column) -> Column:
    """``yyyyMMddHHmmss``, as text or as a number, to a timestamp (null when malformed)."""
    return F.try_to_timestamp(value.cast("string"), F.lit("yyyyMMddHHmmss"))


def nanos_to_timestamp(value: Column) -> Column:
    """Nanoseconds since the epoch, as read with ``nanosAsLong``, to a timestamp."""
    return F.timestamp_micros(F.call_function("div", value, F.lit(1000)))


def in_month(d: Column, month: str) -> Column:
    """Half-open test: first of ``YYYY-MM`` <= d < first of the next month."""
    first = F.to_date(F.lit(f"{month}-01"))
    return (d >= first) & (d < F.add_months(first, 1))


def days_in_month(month: Column, as_of: Column | str) -> Column:
    """Days a finished month must have; the month of ``as_of`` counts up to that day."""
    today = _day(as_of)
    running = F.trunc(month, "month") == F.trunc(today, "month")
    return F.when(running, F.day(today)).otherwise(F.day(F.last_day(month)))


def month_ranges(spark: SparkSession, start: str, end: str) -> DataFrame:
    """(month_start, month_end) pairs covering [start, end), half-open, clipped at both ends."""
    first, last = _day(start), _day(end)
    month = F.explode(F.sequence(F.trunc(first, "month"), last, F.expr("interval 1 month")))
    return (
        spark.range(1)
        .select(month.alias("m"))
        .select(
            F.greatest("m", first).alias("month_start"),
            F.least(F.add_months("m", 1), last).alias("month_end"),
        )
        .filter("month_start < month_end")
    )


def months_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Inclusive ``YYYY-MM`` list as a DataFrame with one column, ``month``."""
    first, last = _day(f"{start}-01"), _day(f"{end}-01")
    month = F.explode(F.sequence(first, last, F.expr("interval 1 month")))
    return spark.range(1).select(month.alias("m")).select(F.date_format("m", "yyyy-MM").alias("month"))


def quarter_ends_between(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Quarter ends within [start, end] as a DataFrame with one column, ``quarter_end``."""
    first, last = _day(start), _day(end)
    quarter = F.explode(F.sequence(F.trunc(first, "quarter"), last, F.expr("interval 3 month")))
    return (
        spark.range(1)
        .select(quarter.alias("q"))
        .select(end_of_quarter(F.col("q")).alias("quarter_end"))
        .filter((F.col("quarter_end") >= first) & (F.col("quarter_end") <= last))
    )
