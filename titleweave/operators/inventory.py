"""URL inventories, archive snapshots and month maps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from titleweave.functions.dates import months_between
from titleweave.functions.text import has_text, is_asset_slug, title_from_release_slug
from titleweave.operators.rows import first_per_key
from titleweave.sources.files import list_files, with_footers

# Fixed value: shape of an English article URL; group 1 is the article id, group 2 the slug.
ARTICLE_URL = r"/news/home/(\d{14,})/en(?:/(.+))?\z"

# Months of the backfill range for which no archive exists.
MONTHS_WITHOUT_ARCHIVE = [
    "2012-07", "2012-08", "2012-09", "2015-03", "2015-04", "2016-10", "2018-02", "2018-06",
    "2019-02", "2019-10", "2019-11",
]


def english_articles(rows: DataFrame) -> DataFrame:
    """Index rows that are English articles, with ``article_id`` and ``slug`` (null if bare).

    Expects ``original``; drops deeper paths, bare locales and asset files.
    """
    url = F.regexp_replace("original", r"/+\z", "")
    slug = F.nullif(F.regexp_extract("source_url", ARTICLE_URL, 2), F.lit(""))
    unwanted = (
        F.col("slug").contains("/")
        | F.lower("slug").rlike(r"\A[a-z]{2}(?:-[a-z]{2})?\z")
        | is_asset_slug(F.col("slug"))
    )
    return (
        rows.withColumn("source_url", url)
        .filter(F.col("source_url").rlike(ARTICLE_URL))
        .withColumn("article_id", F.regexp_extract("source_url", ARTICLE_URL, 1))
        .withColumn("slug", slug)
        .filter(F.col("slug").isNull() | ~unwanted)
    )


def prefer_slug_variant(articles: DataFrame, position: list[str]) -> DataFrame:
    """One row per article: the first one with a slug title, else the first one."""
    titled = articles.withColumn("headline_from_slug", title_from_release_slug(F.col("slug")))
    order = [F.col("headline_from_slug").isNull(), *[F.col(c) for c in position]]
    return first_per_key(titled, ["article_id"], order)


def inventory_from_index(rows: DataFrame, date: Column, position: list[str]) -> DataFrame:
    """Inventory rows from archive-index rows (``timestamp``, ``original`` and positions)."""
    kept = prefer_slug_variant(english_articles(rows), position)
    return kept.select(
        "source_url",
        F.col("timestamp").alias("wayback_timestamp"),
        date.alias("date"),
        "headline_from_slug",
    )


def _slug_counts() -> list[Column]:
    with_slug = F.count_if(has_text(F.col("headline_from_slug")))
    total = F.count(F.lit(1))
    return [
        total.alias("total_urls"),
        with_slug.alias("slug_headline_count"),
        (total - with_slug).alias("missing_slug_count"),
        F.coalesce(F.try_divide(with_slug * 100.0, total), F.lit(0.0)).alias("slug_coverage_pct"),
    ]


def slug_coverage(inventory: DataFrame, by: list[str] | None = None) -> DataFrame:
    """URLs with and without a slug title, for the whole inventory or per ``by``."""
    return inventory.groupBy(*(by or [])).agg(*_slug_counts())


def slug_samples(inventory: DataFrame, with_slug: bool, n: int = 5) -> DataFrame:
    """First ``n`` URLs (by URL) that have, or lack, a slug title."""
    has = F.coalesce(has_text(F.col("headline_from_slug")), F.lit(False))
    return (
        inventory.filter(has if with_slug else ~has)
        .select("source_url", "headline_from_slug")
        .orderBy("source_url")
        .limit(n)
    )


def inventory_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per inventory file: path, day, bytes, rows and whether it has the slug column at all.

    After a schema merge a missing column and a null look alike, so each daily file's own schema
    counts; it stands in the footer, which is all that is read.
    """
    day = F.make_date(F.col("year"), F.col("month"), F.col("day"))
    return with_footers(list_files(spark, path)).select(
        "path", day.alias("date"), "bytes", "n_rows",
        F.array_contains("columns", "headline_from_slug").alias("has_slug_column"),
    )


def inventory_status(spark: SparkSession, path: str, inventory: DataFrame) -> DataFrame:
    """One row for the whole lake: files, legacy files and their days, URLs, slug coverage."""
    legacy = ~F.col("has_slug_column")
    days = inventory_files(spark, path).agg(
        F.count(F.lit(1)).alias("day_files"),
        F.count_if(~legacy).alias("slug_ready_day_files"),
        F.count_if(legacy).alias("legacy_day_files"),
        F.array_sort(F.collect_set(F.when(legacy, F.col("date")))).alias("legacy_dates"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
    coverage = slug_coverage(inventory)
    row = coverage.select(F.struct(*coverage.columns)).scalar()
    return days.withColumn("_urls", row).select(*days.columns, "_urls.*")


def available_months(index: DataFrame, url: str = "loc") -> DataFrame:
    """Distinct (year, month) of monthly child sitemaps; rolling ``latest`` files are skipped."""
    pattern = r"/(\d{4})-(\d{2})\.xml"
    return (
        index.filter(~F.col(url).contains("latest.xml") & F.col(url).rlike(pattern))
        .select(
            F.regexp_extract(url, pattern, 1).cast("int").alias("year"),
            F.regexp_extract(url, pattern, 2).cast("int").alias("month"),
        )
        .distinct()
    )


def pick_valid_snapshot(snapshots: DataFrame, max_candidates: int = 3) -> DataFrame:
    """Newest valid snapshot among the newest ``max_candidates`` of each month.

    Expects ``month``, ``timestamp``, ``valid``; months without one are left out.
    """
    newest = first_per_key(snapshots, ["month"], [F.col("timestamp").desc()], max_candidates)
    return newest.filter("valid").groupBy("month").agg(F.max("timestamp").alias("timestamp"))


def collapse_month_ranges(months: DataFrame) -> DataFrame:
    """Distinct ``YYYY-MM`` months as maximal runs: ``2012-07..2012-09`` or ``2015-03``.

    The window has no partition key; its input is a list of months, bounded by the calendar.
    """
    index = F.substring("month", 1, 4).cast("int") * 12 + F.substring("month", 6, 2).cast("int")
    island = index - F.row_number().over(Window.orderBy("month"))
    runs = (
        months.select("month")
        .distinct()
        .select("month", island.alias("_island"))
        .groupBy("_island")
        .agg(F.min("month").alias("start"), F.max("month").alias("end"))
    )
    label = F.when(F.col("start") == F.col("end"), F.col("start"))
    joined = F.concat_ws("..", "start", "end")
    return runs.select(F.coalesce(label, joined).alias("month_range"), "start", "end")


def is_month_key(key: Column) -> Column:
    """``YYYY-MM`` with a month of 1-12 and a year from 1900 on."""
    return key.rlike(r"\A(19|[2-9]\d)\d{2}-(0[1-9]|1[0-2])\z")


def validate_month_map(
    month_map: DataFrame, start: str, end: str, known_absent: list[str] = MONTHS_WITHOUT_ARCHIVE
) -> DataFrame:
    """Findings on a (month, snapshot_ts) map, one row each: ``finding``, ``month``, ``value``.

    Findings: in_range, malformed_timestamp, outside_range, missing, covered_no_archive.
    Months outside the range are reported, not checked.
    """
    spark = month_map.sparkSession
    expected = months_between(spark, start, end)
    # Lists of months: bounded by the calendar.
    absent = spark.createDataFrame([(m,) for m in known_absent], "month string")
    inside = month_map.join(expected, "month", "left_semi")
    bad = ~F.coalesce(F.col("snapshot_ts").rlike(r"\A\d{14}\z"), F.lit(False))

    def finding(name: str, df: DataFrame, value: Column | None = None) -> DataFrame:
        nothing = F.lit(None).cast("string")
        return df.select(
            F.lit(name).alias("finding"), "month", (nothing if value is None else value).alias("value")
        )

    stamp = F.col("snapshot_ts")
    parts = [
        finding("in_range", inside, stamp),
        finding("malformed_key", inside.filter(~is_month_key(F.col("month"))), stamp),
        finding("malformed_timestamp", inside.filter(bad), stamp),
        finding("outside_range", month_map.join(expected, "month", "left_anti")),
        finding("missing", expected.subtract(inside.select("month")).subtract(absent)),
        finding("covered_no_archive", inside.select("month").intersect(absent)),
    ]
    return reduce(DataFrame.unionByName, parts)


def lake_inventory(spark: SparkSession, path: str, by: list[str], day_columns: list[str]) -> DataFrame:
    """Per ``by``: day partitions, distinct months, files, bytes and rows of the lake at ``path``.

    ``by`` and ``day_columns`` are partition columns, year and month first; sizes come from the
    listing and rows from the footers, so the work follows the files, not their rows.
    """
    return with_footers(list_files(spark, path)).groupBy(*by).agg(
        F.countDistinct(*day_columns).alias("day_partitions"),
        F.countDistinct(*day_columns[:2]).alias("months"),
        F.count(F.lit(1)).alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum("n_rows").alias("n_rows"),
    )
