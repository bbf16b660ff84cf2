"""Titles and dates from landed HTML pages, with native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleweave.functions.text import (
    date_from_home_path,
    date_from_release_path,
    html_unescape,
    null_if_empty,
    strip,
)

# Heading classes tried before a plain h1, per source.
HEADING_CLASSES = {
    "prnewswire": ["release-header__title"],
    "globenewswire": ["article-headline", "main-title"],
    "newswireca": ["release-header__title"],
    "businesswire": [],
}


def _heading(html: Column, css_class: str | None) -> Column:
    """Text of the first h1 (with the class, if given); null when missing or empty."""
    if css_class is None:
        tag = r"<h1\b[^>]*>"
    else:
        tag = rf"""<h1\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{css_class}(?:\s[^"']*)?["'][^>]*>"""
    inner = F.regexp_extract(html, rf"(?is){tag}(.*?)</h1\s*>", 1)
    # Whitespace next to an inner tag goes with it.
    return F.regexp_replace(inner, r"(?sU)\s*<[^>]*>\s*", "")


def _meta(html: Column, attribute: str, name: str) -> Column:
    """First ten characters of a meta tag's content, whatever the attribute order."""
    quoted = rf"""["']{name}["']"""
    content = r"""\bcontent\s*=\s*["']([^"']+)["']"""
    after = F.regexp_extract(html, rf"(?is)<meta\b[^>]*\b{attribute}\s*=\s*{quoted}[^>]*{content}", 1)
    before = F.regexp_extract(html, rf"(?is)<meta\b[^>]*{content}[^>]*\b{attribute}\s*=\s*{quoted}", 1)
    value = F.coalesce(null_if_empty(after), null_if_empty(before))
    return F.substring(value, 1, 10)


def _meta_date(html: Column) -> Column:
    published = _meta(html, "property", "article:published_time")
    return F.coalesce(_meta(html, "name", "date"), published)


def read_html_titles(pages: DataFrame, source: str, url: str = "url", html: str = "html") -> DataFrame:
    """(headline, source_url, date) of each page; pages without a heading are dropped.

    ``source`` selects the heading classes and where the date comes from: the URL path, then
    the meta tags, or the meta tags alone.
    """
    body, address = F.col(html), F.col(url)
    tries = [_heading(body, c) for c in [*HEADING_CLASSES[source], None]]
    # Entities are replaced once, on the chosen heading; spaces alone count as empty.
    chosen = F.coalesce(*[F.when(strip(F.replace(t, F.lit("&nbsp;"), F.lit(" "))) != "", t) for t in tries])
    date = {
        "globenewswire": F.coalesce(date_from_release_path(address), _meta_date(body)),
        "businesswire": date_from_home_path(address),
    }.get(source, _meta_date(body))
    return (
        pages.select(chosen.alias("headline"), address.alias("source_url"), date.alias("date"))
        .withColumn("headline", strip(html_unescape(F.col("headline"))))
        .filter(F.col("headline") != "")
    )


def titles_from_inventory(inventory: DataFrame, pages: DataFrame) -> DataFrame:
    """Slug titles where the inventory has them; only the remaining URLs need their page.

    ``pages`` holds (url, html); a URL without a slug title and without a page yields nothing.
    """
    ready = inventory.filter("headline_from_slug is not null").select(
        F.col("headline_from_slug").alias("headline"),
        "source_url",
        date_from_home_path(F.col("source_url")).alias("date"),
    )
    rest = inventory.filter("headline_from_slug is null").select("source_url").distinct()
    needed = pages.join(rest, F.col("url") == F.col("source_url"), "left_semi")
    return ready.unionByName(read_html_titles(needed, "businesswire"))
