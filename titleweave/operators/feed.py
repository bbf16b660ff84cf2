"""Selection of the reference feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


STORY = ["provider_id", "provider_story_id"]


def is_eligible(min_relevance: int = 90) -> Column:
    """Relevant rows about domestic companies."""
    return (
        (F.col("entity_type") == "COMP")
        & (F.col("country_code") == "US")
        & (F.col("relevance") >= min_relevance)
    )


def eligible_feed_rows(feed: DataFrame, start: str, end: str, min_relevance: int = 90) -> DataFrame:
    """Eligible rows with start <= timestamp <= end. A bare end date means its midnight, so
    the rest of that day is outside."""
    moment = F.col("timestamp_utc")
    inside = (moment >= F.lit(start).cast("timestamp")) & (moment <= F.lit(end).cast("timestamp"))
    return feed.filter(is_eligible(min_relevance) & inside)


def single_firm_stories(feed: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Stories whose eligible rows name exactly one entity.

    Smallest = largest entity is the same test as a distinct count of one, but it combines
    before the shuffle. Rows with a null story key never qualify. ``by`` adds keys, such as
    the year of a feed kept in yearly tables.
    """
    keys = [*(by or []), *STORY]
    entity = F.col("rp_entity_id")
    return (
        feed.filter(is_eligible())
        .dropna(subset=STORY)
        .groupBy(*keys)
        .agg(F.min(entity).alias("_low"), F.max(entity).alias("_high"))
        .filter("_low = _high")
        .select(*keys)
    )


def single_firm_only(feed: DataFrame, start: str, end: str, by: list[str] | None = None) -> DataFrame:
    """Eligible rows of single-firm stories; the story test looks at all dates."""
    keys = [*(by or []), *STORY]
    rows = eligible_feed_rows(feed, start, end)
    return rows.join(single_firm_stories(feed, by), keys, "left_semi").select(*feed.columns)
