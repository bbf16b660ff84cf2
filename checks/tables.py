"""Logical inputs of the engine, derived by Spark from the parquet tables on disk.

Each function has a counterpart of the same name in ``checks.sql``; the two are written
independently, so every registered query is checked from the raw tables up.
"""

from __future__ import annotations

import gzip

import pandas as pd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _day(key: str) -> Column:
    """Thirty publication days, three calendar days apart, over one quarter."""
    return F.date_add(F.lit("2024-01-01").cast("date"), ((F.col(key) % 30) * 3).cast("int"))


def _host(url: Column) -> Column:
    return F.regexp_extract(url, "^https?://([^/?#]+)", 1)


def newswire_titles(spark: SparkSession, folder: str) -> DataFrame:
    """headline, source_url, date (text), source, year, month, day: one row per page.

    Titles are perturbed by page number so that fuzzy matching has work to do; every
    seventeenth page is filed under the month after its date.
    """
    h1 = F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1)
    kind = F.col("page_id") % 3
    headline = (
        F.when(kind == 0, h1)
        .when(kind == 1, F.concat(h1, F.lit(" Update")))
        .otherwise(F.regexp_replace(h1, "^[^ ]+ ", ""))
    )
    filed = F.when(F.col("page_id") % 17 == 0, F.add_months(_day("page_id"), 1)).otherwise(
        _day("page_id")
    )
    return table(spark, folder, "pages").select(
        headline.alias("headline"),
        F.col("url").alias("source_url"),
        F.date_format(_day("page_id"), "yyyy-MM-dd").alias("date"),
        F.element_at(F.split(_host(F.col("url")), r"\."), -1).alias("source"),
        F.year(filed).alias("year"),
        F.month(filed).alias("month"),
        F.day(filed).alias("day"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by line: every column, the line's number from 1 and its whole text; empty lines are left out."""
    docs = table(spark, folder, "documents")
    return docs.select("*", F.posexplode(F.split("text", "\n"))).select(
        *docs.columns, (F.col("pos") + 1).alias("line"), F.col("col").alias("line_text")
    ).where("line_text <> ''")


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """The entity-tagged feed: one row per line of a document, so that no text is left out."""
    entity = F.concat(F.lit("E"), ((F.col("doc_id") / 3).cast("bigint") % 50).cast("string"))
    hours = F.make_dt_interval(F.lit(0), (F.col("doc_id") % 24).cast("int"))
    number = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    return lines(spark, folder).select(
        (_day("doc_id").cast("timestamp") + hours).alias("timestamp_utc"),
        F.concat(number, F.lit("-"), F.lpad(F.col("line").cast("string"), 6, "0")).alias("rp_story_id"),
        entity.alias("rp_entity_id"),
        F.when(F.col("source").isin("src0", "src1"), "ORGA").otherwise("COMP").alias("entity_type"),
        F.concat(F.lit("Entity "), entity).alias("entity_name"),
        F.when(F.col("lang") == "en", "US").otherwise("XX").alias("country_code"),
        (70 + F.length("source") * 4 + F.col("doc_id") % 9).alias("relevance"),
        F.col("source").alias("source_name"),
        F.lit("P").alias("provider_id"),
        (F.col("doc_id") / 2).cast("bigint").cast("string").alias("provider_story_id"),
        F.col("line_text").alias("headline"),
    )


def _h1() -> Column:
    return F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1)


def _slug() -> Column:
    """URL slug of a page title: letters, digits and an encoded ampersand."""
    kept = F.trim(F.regexp_replace(_h1(), r"[^\p{L}\p{N}& ]", ""))
    return F.replace(F.replace(kept, F.lit("&"), F.lit("%26")), F.lit(" "), F.lit("-"))


def _moment(key: str) -> Column:
    return _day(key).cast("timestamp") + F.make_dt_interval(F.lit(0), (F.col(key) % 24).cast("int"))


def web_extract(spark: SparkSession, folder: str) -> DataFrame:
    """Raw page extract; pages served over plain http appear twice."""
    title = F.regexp_extract("html", r"(?s)<title[^>]*>(.*?)</title>", 1)
    titled = F.concat(F.lit("<LINKS>x</LINKS><PAGE_TITLE>"), title, F.lit("</PAGE_TITLE>"))
    pages = table(spark, folder, "pages")
    return pages.unionByName(pages.filter(F.col("url").startswith("http:"))).select(
        F.date_format(_moment("page_id"), "yyyyMMddHHmmss").cast("bigint").alias("DATE"),
        F.col("url").alias("DocumentIdentifier"),
        F.regexp_extract(_host(F.col("url")), r"([^.]+\.[^.]+)$", 1).alias("SourceCommonName"),
        F.when(F.col("url").contains("utm_source"), "<LINKS>x</LINKS>").otherwise(titled).alias("Extras"),
        F.when(~F.col("html").contains('lang="en"'), "srclc:xx").alias("TranslationInfo"),
        F.when(~F.col("url").contains("#top"), F.col("url")).otherwise("").alias("V2Organizations"),
        _day("page_id").cast("timestamp").alias("partition_time"),
    )


def cdx_responses(spark: SparkSession, folder: str) -> DataFrame:
    """One archive-index response per page: bare, slug, other-language and asset variants."""
    stamp = F.date_format(_moment("page_id"), "yyyyMMddHHmmss")
    base = F.concat(
        F.lit("https://www.example.com/news/home/"), F.date_format(_day("page_id"), "yyyyMMdd"),
        F.lpad(F.col("page_id").cast("string"), 6, "0"), F.lit("/en"),
    )
    status = F.when(F.col("page_id") % 5 == 0, "404").otherwise("200")
    ok = F.lit("200")
    rows = F.array(
        F.array(F.lit("timestamp"), F.lit("original"), F.lit("statuscode")),
        F.array(stamp, base, ok),
        F.array(stamp, F.concat(base, F.lit("/"), _slug()), status),
        F.array(stamp, F.concat(base, F.lit("/de/")), ok),
        F.array(stamp, F.concat(base, F.lit("/logo.png")), ok),
    )
    return table(spark, folder, "pages").select(
        "page_id", _day("page_id").alias("day"), F.to_json(rows).alias("body")
    )


def sitemaps(spark: SparkSession, folder: str) -> DataFrame:
    """One small sitemap per page: a release with news metadata (two in three) and a plain page."""

    def xml_text(text: Column) -> Column:
        return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    date = F.date_format(_day("page_id"), "yyyy-MM-dd")
    loc = F.concat(
        F.lit("https://www.example.com/news-releases/"), _slug(), F.lit("-8"),
        F.lpad(F.col("page_id").cast("string"), 8, "0"), F.lit(".html"),
    )
    news = F.concat(
        F.lit("<news:news><news:publication_date>"), date, F.lit("T08:00:00Z</news:publication_date><news:title>"),
        xml_text(_h1()), F.lit("</news:title></news:news>"),
    )
    body = F.concat(
        F.lit(
            '<?xml version="1.0"?><urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" '
            'xmlns:news="http://www.google.com/schemas/sitemap-news/0.9"><url><loc>'
        ),
        xml_text(loc), F.lit("</loc><lastmod>"), date, F.lit("T00:00:00Z</lastmod>"),
        F.when(F.col("page_id") % 3 != 0, news).otherwise(""),
        F.lit("</url><url><loc>https://www.example.com/about-us</loc><lastmod>"), date,
        F.lit("</lastmod></url></urlset>"),
    )
    path = F.concat(F.lit("sitemap-"), F.lpad(F.col("page_id").cast("string"), 9, "0"))
    return table(spark, folder, "pages").select(
        "page_id", date.alias("date"), path.alias("path"), body.alias("xml")
    )


@F.pandas_udf(BinaryType())
def _gzip(xml: pd.Series, damaged: pd.Series) -> pd.Series:
    packed = xml.map(lambda text: gzip.compress(text.encode()))
    return packed.where(~damaged, packed.map(lambda b: b[: len(b) // 2]))


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """The sitemaps as gzip bytes; every fifth one is cut off half way."""
    content = _gzip("xml", F.col("page_id") % 5 == 0)
    return sitemaps(spark, folder).select("path", content.alias("content"))


def marked_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The sitemaps, a byte order mark before each and NULs inside its elements, as two-member gzip bytes."""
    marked = F.concat(F.lit("\ufeff"), F.regexp_replace("xml", "<loc>", "<loc>\x00"), F.lit("\x00"))
    content = _gzip(marked, F.lit(False))
    again = _gzip(F.lit("<!-- end of the file -->"), F.lit(False))
    return sitemaps(spark, folder).select("path", F.concat(content, again).alias("content"))


def dated_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The pages as landed from three sources: a plain heading of the site before the article's, dates in
    the meta tags (in either attribute order) or in the address."""
    day = _day("page_id")
    dash, slash, bare = (F.date_format(day, form) for form in ("yyyy-MM-dd", "yyyy/MM/dd", "yyyyMMdd"))
    kind = F.col("page_id") % 4
    meta = (
        F.when(kind == 0, F.concat(F.lit('<meta name="date" content="'), dash, F.lit('T08:00:00Z"/>')))
        .when(kind == 1, F.concat(F.lit("<META content='"), dash, F.lit("' property='article:published_time'>")))
        .otherwise(F.lit('<meta name="date" content="1999-09-09">'))
    )
    heading = (
        F.when(kind == 0, F.lit('<h1>Site</h1><h1 id="t" class="wide release-header__title">'))
        .when(kind < 3, F.lit("<h1>Site</h1><H1 class='main-title'>"))
        .otherwise(F.lit("<h1>"))
    )
    before, behind = F.split_part("html", F.lit("<h1>"), F.lit(1)), F.split_part("html", F.lit("<h1>"), F.lit(2))
    head, rest = F.split_part(before, F.lit("<head>"), F.lit(1)), F.split_part(before, F.lit("<head>"), F.lit(2))
    host = F.regexp_extract("url", "^https?://[^/?#]+", 0)
    tail = F.substring(F.col("url"), F.length(host) + 1, F.length("url"))
    inside = (
        F.when(kind == 2, F.concat(F.lit("/news-release/"), slash, F.lit("/7")))
        .when(kind == 3, F.concat(F.lit("/news/home/"), bare, F.lit("004711")))
        .otherwise("")
    )
    return table(spark, folder, "pages").select(
        "page_id", F.concat(host, inside, tail).alias("url"),
        F.concat(head, F.lit("<head>"), meta, rest, heading, behind).alias("html"),
    )


def spells(spark: SparkSession, folder: str) -> DataFrame:
    """Membership spells: first to last order day of each customer."""
    day = F.to_date("o_orderdate")
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("permno"))
        .agg(F.min(day).alias("mbrstartdt"), F.max(day).alias("mbrenddt"))
    )


def name_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Name periods: one per customer and order priority."""
    day = F.to_date("o_orderdate")
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("permno"), F.col("o_orderpriority").alias("comnam"))
        .agg(F.min(day).alias("namedt"), F.max(day).alias("nameenddt"))
    )


def constituents(spark: SparkSession, folder: str) -> DataFrame:
    """Companies named after whole lines of the documents."""
    return lines(spark, folder).select(
        F.col("doc_id").alias("permno"),
        F.concat(F.col("line_text"), F.lit(" Inc")).alias("comnam"),
        F.upper("source").alias("ticker"),
    )


def event_days(spark: SparkSession, folder: str) -> DataFrame:
    """Events as (source, day, value)."""
    return table(spark, folder, "events").select(
        F.col("event_type").alias("source"), F.to_date("ts").alias("day"), "value", "event_id"
    )


def event_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger in which weekdays are done and weekends are not; early days have an old schema."""
    return (
        event_days(spark, folder)
        .filter(F.weekday("day") < 5)
        .groupBy("source", "day")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("schema_version", F.when(F.col("day") < "2024-01-15", 1).otherwise(2))
        .withColumn("input_version", F.lit("v1"))
    )


def month_map(spark: SparkSession, folder: str) -> DataFrame:
    """(month, snapshot_ts): last order of each month; months of high order keys are malformed."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    stamp = F.date_format(F.max("o_orderdate"), "yyyyMMddHHmmss")
    odd = F.max("o_orderkey") % 2 == 1
    return (
        table(spark, folder, "orders")
        .groupBy(month.alias("month"))
        .agg(F.when(odd, F.concat(F.lit("x"), stamp)).otherwise(stamp).alias("snapshot_ts"))
    )
