"""Crosswalk from collected titles to the reference feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleweave.functions.text import has_text
from titleweave.operators.ledger import months_to_rebuild
from titleweave.operators.matching import fuzzy_best_match
from titleweave.schemas import TITLES
from titleweave.session import freeze, read_or_empty, stage
from titleweave.sources.contents import content_versions, lake_versions
from titleweave.sources.lakes import read_titles
from titleweave.sources.writers import replace_crosswalk_months

DEFAULT_MIN_SCORE = 80.0


def feed_titles(feed: DataFrame) -> DataFrame:
    """Feed columns the crosswalk carries, one row per non-blank title, dated by day."""
    return feed.filter(has_text(F.col("headline"))).select(
        F.to_date("timestamp_utc").alias("date"),
        "rp_story_id",
        "rp_entity_id",
        F.col("entity_name").alias("rp_entity_name"),
        F.col("headline").alias("rp_headline"),
        F.col("source_name").alias("rp_source_name"),
    )


def _match(titles: DataFrame, feed: DataFrame, title: str, columns: list[str], **options) -> DataFrame:
    matched = fuzzy_best_match(
        titles,
        feed_titles(feed),
        block="date",
        left_text=title,
        right_text="rp_headline",
        right_order=["rp_story_id", "rp_entity_id"],
        **options,
    )
    return matched.select(
        "date", *columns, "rp_story_id", "rp_entity_id", "rp_entity_name", "rp_headline",
        "rp_source_name", "fuzzy_score",
    )


def in_own_month(date: Column) -> Column:
    """Rows whose date lies in the month partition they were filed under."""
    return (F.year(date) == F.col("year")) & (F.month(date) == F.col("month"))


def newswire_crosswalk(
    titles: DataFrame, feed: DataFrame, min_score: float = DEFAULT_MIN_SCORE,
    month_scoped: bool = True, **options,
) -> DataFrame:
    """Same-day best feed title of each newswire title.

    ``month_scoped`` keeps the month-by-month semantics: a title filed under another month
    than its date never meets the feed rows of that date.
    """
    dated = titles.filter(has_text(F.col("headline"))).withColumn("date", F.to_date("date"))
    if month_scoped:
        dated = dated.filter(in_own_month(F.col("date")))
    left = dated.select(
        "date",
        F.col("source_url").alias("nw_source_url"),
        F.col("headline").alias("nw_headline"),
        F.col("source").alias("nw_source"),
    )
    return _match(
        left, feed, "nw_headline", ["nw_source_url", "nw_headline", "nw_source"],
        min_score=min_score, **options,
    )


def web_crosswalk(
    titles: DataFrame, feed: DataFrame, min_score: float = DEFAULT_MIN_SCORE, **options
) -> DataFrame:
    """Same-day best feed title of each web title."""
    left = titles.filter(has_text(F.col("headline"))).select(
        F.to_date("gkg_date").alias("date"),
        F.col("source_url").alias("gdelt_source_url"),
        F.col("headline").alias("gdelt_headline"),
        F.col("source_name").alias("gdelt_source_name"),
    )
    return _match(
        left, feed, "gdelt_headline", ["gdelt_source_url", "gdelt_headline", "gdelt_source_name"],
        min_score=min_score, **options,
    )


CROSSWALK_LEDGER = "source string, month date, input_version string, done_at timestamp"


def refresh_crosswalk(
    titles: DataFrame, feed: DataFrame, inputs: DataFrame, path: str, ledger_path: str, **options
) -> DataFrame:
    """Rebuild only the months whose inputs are new or changed, and return those months.

    ``inputs`` lists (source, month, input_version) as they are now. A month is rebuilt for
    all its sources together, so a source that arrives late or is gone is never missed. Titles
    are pruned by the month they are filed under, so matching across months is not offered.
    """
    if not options.get("month_scoped", True):
        raise ValueError("a month-wise refresh cannot match titles filed under other months")
    ledger = read_or_empty(titles.sparkSession, ledger_path, CROSSWALK_LEDGER)
    due = freeze(months_to_rebuild(inputs, ledger))
    months = freeze(due.select("month").distinct())
    # Partition columns of the title lake: the semi-join prunes the months not due.
    keys = months.select(F.year("month").alias("year"), F.month("month").alias("month"))
    due_titles = titles.join(F.broadcast(keys), ["year", "month"], "left_semi")  # months: bounded
    of_month = F.trunc(F.to_date("timestamp_utc"), "month")
    due_feed = feed.withColumn("_month", of_month).join(
        F.broadcast(months.withColumnRenamed("month", "_month")), "_month", "left_semi"
    )
    crosswalk = newswire_crosswalk(due_titles, due_feed.drop("_month"), **options)
    replace_crosswalk_months(crosswalk, months, path)
    now = inputs.join(months, "month", "left_semi").select("source", "month", "input_version")
    gone = due.join(inputs, ["source", "month"], "left_anti").withColumn("input_version", F.lit(None).cast("string"))
    done = now.unionByName(gone).withColumn("done_at", F.current_timestamp())
    done.write.mode("append").parquet(ledger_path)
    return months


def refresh_from_lake(
    titles_path: str, feed: DataFrame, path: str, ledger_path: str, book: str, **options
) -> DataFrame:
    """``refresh_crosswalk`` with versions taken from the inputs themselves; returns the months rebuilt.

    A month's version is that of its titles, read only from files not seen before (``book``), and of
    its feed rows. A changed or missing row rebuilds the month, equal rows in other files do not.
    """
    spark = feed.sparkSession
    month = F.make_date(F.col("year"), F.col("month"), F.lit(1))
    of_titles = lake_versions(spark, titles_path, TITLES, {"source": F.col("source"), "month": month}, book)
    dated = feed_titles(feed).withColumn("month", F.trunc("date", "month"))
    of_feed = content_versions(dated, ["month"]).withColumnRenamed("input_version", "_feed")
    both = of_titles.join(of_feed, "month", "left")  # months: bounded by the calendar
    version = F.concat_ws("/", "input_version", F.coalesce("_feed", F.lit("")))
    inputs = stage(both.select("source", "month", version.alias("input_version")), "inputs")
    return refresh_crosswalk(read_titles(spark, titles_path), feed, inputs, path, ledger_path, **options)
