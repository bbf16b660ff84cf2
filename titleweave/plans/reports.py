"""End-to-end plans: enriched feed, coverage series and archive ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleweave.operators import coverage
from titleweave.operators.enrichment import enrich_feed, unify_crosswalk
from titleweave.operators.ledger import in_month_prefix
from titleweave.operators.panel import rolling_mean
from titleweave.sources.sitemaps import ENTRY_PARSERS, archive_urls


def merged_titles(feed: DataFrame, newswire: DataFrame | None, web: DataFrame | None) -> DataFrame:
    """Feed rows with the best collected title from either crosswalk."""
    kinds = {"newswire": newswire, "gdelt": web}
    parts = [unify_crosswalk(cw, kind) for kind, cw in kinds.items() if cw is not None]
    if not parts:
        raise ValueError("at least one crosswalk is needed")
    unified = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return enrich_feed(feed, unified)


def coverage_series(feed: DataFrame, newswire: DataFrame, web: DataFrame, window: int = 5) -> DataFrame:
    """Daily share of the feed matched by either source, with its moving average, over the
    newswire crosswalk's date range."""
    days = feed.select(F.to_date("timestamp_utc").alias("date"), "rp_story_id")
    clipped = coverage.clip_to_range_of(days, newswire)
    both = coverage.combined_stories(newswire, web)
    daily = coverage.daily_match_rate(clipped, {"combined": both}).select(
        "date",
        "rp_total",
        F.col("combined_matched").alias("matched"),
        F.col("combined_pct").alias("match_pct"),
    )
    return rolling_mean(daily, "date", {"match_pct_ma": "match_pct"}, window)


def archive_titles(files: DataFrame, source: str, month: str, ledger: DataFrame | None = None) -> DataFrame:
    """Titles of one source's landed monthly archive: decode, parse, keep its own month.

    Days that ``ledger`` (source, day) lists as done are left out.
    """
    entries = ENTRY_PARSERS[source](archive_urls(files))
    titles = in_month_prefix(entries, month).withColumn("source", F.lit(source))
    if ledger is None:
        return titles
    done = ledger.select("source", F.date_format("day", "yyyy-MM-dd").alias("date")).distinct()
    return titles.join(done, ["source", "date"], "left_anti").select(*titles.columns)
