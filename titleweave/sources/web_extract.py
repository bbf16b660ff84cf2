"""Titles from the raw web-page extract (one row per crawled page)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleweave.functions.dates import parse_compact_timestamp
from titleweave.functions.text import extract_page_title, has_text, html_unescape
from titleweave.operators.rows import first_per_key

# Web domains that carry the press releases of the reference feed.
PRESS_DOMAINS = [
    "prnewswire.com", "prnewswire.co.uk", "businesswire.com", "globenewswire.com",
    "marketwatch.com", "wsj.com", "barrons.com", "newswire.ca", "realwire.com",
]


def gkg_extract(
    pages: DataFrame, start: str, end: str, domains: list[str] | None = None, partition: str = "partition_time"
) -> DataFrame:
    """Distinct English pages with a title from the given domains, start <= partition < end.

    Every condition is a plain predicate, so the partition range prunes and the rest reaches
    the scan; only four columns are read.
    """
    first, last = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    return (
        pages.filter((F.col(partition) >= first) & (F.col(partition) < last))
        .filter(F.col("Extras").contains("<PAGE_TITLE>"))
        .filter(F.col("TranslationInfo").isNull())
        .filter(F.col("SourceCommonName").isin(domains or PRESS_DOMAINS))
        .select(
            parse_compact_timestamp(F.col("DATE")).alias("gkg_date"),
            F.col("DocumentIdentifier").alias("source_url"),
            F.col("SourceCommonName").alias("source_name"),
            "Extras",
        )
        .distinct()
    )


def dedup_earliest(titles: DataFrame) -> DataFrame:
    """Earliest row per exact title within a calendar month; ties go by URL."""
    monthly = titles.withColumn("_month", F.trunc("gkg_date", "month"))
    order = [F.col("gkg_date"), F.col("source_url"), F.col("source_name")]
    return first_per_key(monthly, ["_month", "headline"], order).drop("_month")


def clean_web_titles(extract: DataFrame) -> DataFrame:
    """Title text out of the extras: entities replaced, blanks dropped, earliest copy kept."""
    titled = extract.withColumn("headline", html_unescape(extract_page_title(F.col("Extras"))))
    return dedup_earliest(titled.drop("Extras").filter(has_text(F.col("headline"))))
