"""Carrying feed metadata over the crosswalks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleweave.operators.rows import first_per_key
from titleweave.session import broadcast_if_small

# Label and column prefix of each kind of crosswalk.
KINDS = {"newswire": "nw", "gdelt": "gdelt"}


def unify_crosswalk(crosswalk: DataFrame, kind: str) -> DataFrame:
    """Common column names for one kind of crosswalk (``newswire`` or ``gdelt``)."""
    prefix = KINDS[kind]
    return crosswalk.select(
        F.col(f"{prefix}_headline").alias("headline"),
        F.lit(kind).alias("headline_source"),
        F.col(f"{prefix}_source_url").alias("headline_source_url"),
        "rp_headline",
        "fuzzy_score",
        "rp_story_id",
    )


def dedup_best_per_story(unified: DataFrame) -> DataFrame:
    """Best-scoring title per story; ties go by source, URL and title."""
    order = [
        F.col("fuzzy_score").desc(), F.col("headline_source"), F.col("headline_source_url"),
        F.col("headline"),
    ]
    return first_per_key(unified, ["rp_story_id"], order)


def enrich_feed(feed: DataFrame, unified: DataFrame) -> DataFrame:
    """Every feed row, with the best collected title of its story where there is one.

    The right side is unique per story, so the row count equals the feed's. The deduplicated
    crosswalk is measured: within the broadcast bound the wide feed is never shuffled, beyond
    it the join is by story key, with adaptive execution splitting skewed stories.
    """
    best = broadcast_if_small(dedup_best_per_story(unified).drop("rp_headline"))
    return feed.withColumnRenamed("headline", "rp_headline").join(best, "rp_story_id", "left").select(
        *["rp_headline" if c == "headline" else c for c in feed.columns],
        "headline", "headline_source", "headline_source_url", "fuzzy_score",
    )


def merged_summary(merged: DataFrame) -> DataFrame:
    """Rows, matched rows and share, and score statistics of the enriched feed, in one pass."""
    matched = F.col("headline").isNotNull()
    score = F.when(matched, F.col("fuzzy_score"))
    return merged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(matched).alias("n_matched"),
        F.avg(matched.cast("double")).alias("share_matched"),
        F.min(score).alias("min_score"),
        F.median(score).alias("median_score"),
        F.avg(score).alias("mean_score"),
        F.max(score).alias("max_score"),
    )


def matched_by_source(merged: DataFrame) -> DataFrame:
    matched = merged.filter(F.col("headline").isNotNull())
    return matched.groupBy("headline_source").agg(F.count(F.lit(1)).alias("n"))
