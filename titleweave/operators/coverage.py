"""Counts, match rates, gaps and score distributions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rows() -> Column:
    return F.count(F.lit(1))


def pct(part: Column, whole: Column) -> Column:
    """part / whole * 100; null when there is nothing to divide by."""
    return F.try_divide(part, whole) * 100


# --- date ranges -------------------------------------------------------------------------


def clip_to_range_of(df: DataFrame, other: DataFrame, date: str = "date", other_date: str = "date") -> DataFrame:
    """Rows dated within the other table's first and last date, both included."""
    first = other.agg(F.min(other_date)).scalar()
    last = other.agg(F.max(other_date)).scalar()
    return df.filter((F.col(date) >= first) & (F.col(date) <= last))


def overlap_window(a: DataFrame, b: DataFrame, date: str = "date") -> DataFrame:
    """One row: the date range covered by both tables."""
    ranges = a.agg(F.min(date).alias("low"), F.max(date).alias("high")).unionByName(
        b.agg(F.min(date).alias("low"), F.max(date).alias("high"))
    )
    return ranges.agg(F.max("low").alias("date_start"), F.min("high").alias("date_end"))


def within(df: DataFrame, window: DataFrame, date: str = "date") -> DataFrame:
    """Rows within a one-row (date_start, date_end) table."""
    first = window.select("date_start").scalar()
    last = window.select("date_end").scalar()
    return df.filter((F.col(date) >= first) & (F.col(date) <= last))


def shared_days(a: DataFrame, b: DataFrame, date: str = "date") -> DataFrame:
    """Days present on both sides: the blocks a match can run on."""
    return a.select(date).intersect(b.select(date))


def shared_months(a: DataFrame, b: DataFrame, date: str = "date") -> DataFrame:
    """(year, month) present on both sides."""

    def months(df: DataFrame) -> DataFrame:
        return df.select(F.year(date).alias("year"), F.month(date).alias("month"))

    return months(a).intersect(months(b))


# --- counts ------------------------------------------------------------------------------


def count_by_day(df: DataFrame, date: str = "date", name: str = "n") -> DataFrame:
    return df.groupBy(F.to_date(date).alias("date")).agg(_rows().alias(name))


def count_by_month(df: DataFrame, date: str = "date", count: str = "n", days: str | None = None) -> DataFrame:
    """Rows per calendar month and, with ``days``, the number of days that have any."""
    day = F.to_date(date)
    measures = [_rows().alias(count)]
    if days:
        measures.append(F.countDistinct(day).alias(days))
    return df.groupBy(F.trunc(day, "month").alias("month")).agg(*measures)


def distinct_sources_by_year(df: DataFrame, date: str, source: str) -> DataFrame:
    return df.groupBy(F.year(date).alias("year")).agg(F.countDistinct(source).alias("n_sources"))


def count_by_source(df: DataFrame, source: str, top: int | None = None) -> DataFrame:
    """Rows per source, largest first; ``top`` keeps that many, ties in name order."""
    counts = df.groupBy(source).agg(_rows().alias("n")).orderBy(F.col("n").desc(), source)
    return counts.limit(top) if top else counts


def table_profile(df: DataFrame, dates: list[str], ids: list[str]) -> DataFrame:
    """One row: size, columns, range of each date column and distinct count of each id."""
    measures = [_rows().alias("n_rows")]
    for c in dates:
        measures += [F.min(c).alias(f"earliest_{c}"), F.max(c).alias(f"latest_{c}")]
    measures += [F.countDistinct(c).alias(f"distinct_{c}") for c in ids]
    names = ",".join(df.columns)
    return df.agg(*measures).withColumns(
        {"n_columns": F.lit(len(df.columns)), "columns": F.lit(names)}
    )


# --- crosswalk quality -------------------------------------------------------------------


def score_stats(score: str = "fuzzy_score") -> list[Column]:
    """Exact statistics; the median folds equal scores first, of which there are few."""
    return [
        F.min(score).alias("min_score"),
        F.median(score).alias("median_score"),
        F.avg(score).alias("mean_score"),
        F.max(score).alias("max_score"),
    ]


def crosswalk_summary(crosswalk: DataFrame, url: str) -> DataFrame:
    return crosswalk.agg(
        _rows().alias("n_rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.countDistinct("date").alias("n_dates"),
        F.countDistinct(url).alias("n_urls"),
        F.countDistinct("rp_story_id").alias("n_stories"),
        F.countDistinct("rp_entity_id").alias("n_entities"),
        *score_stats(),
    )


def match_rates(
    newswire: DataFrame, web: DataFrame, titles: DataFrame, feed: DataFrame
) -> DataFrame:
    """Distinct matched over distinct total, in percent.

    One row per measure: feed stories matched by either source, by newswire, by web titles,
    and newswire URLs matched. Inputs must already share one date window.
    """

    def distinct(df: DataFrame, column: str, name: str) -> DataFrame:
        return df.agg(F.countDistinct(column).alias(name))

    both = newswire.select("rp_story_id").unionByName(web.select("rp_story_id"))
    stories = feed.agg(F.countDistinct("rp_story_id")).scalar()
    urls = titles.agg(F.countDistinct("source_url")).scalar()
    measures = [
        ("rp_combined", distinct(both, "rp_story_id", "matched"), stories),
        ("rp_newswire", distinct(newswire, "rp_story_id", "matched"), stories),
        ("rp_web", distinct(web, "rp_story_id", "matched"), stories),
        ("nw_titles", distinct(newswire, "nw_source_url", "matched"), urls),
    ]
    parts = [
        matched.select(F.lit(name).alias("metric"), "matched", total.alias("total"))
        for name, matched, total in measures
    ]
    rate = pct(F.col("matched"), F.col("total"))
    return reduce(DataFrame.unionByName, parts).withColumn("match_pct", rate)


def coverage_by_source(
    total: DataFrame, source: str, item: str, matched: DataFrame, matched_source: str, matched_item: str
) -> DataFrame:
    """Distinct items per source, how many were matched, and the share; 0 where none were."""
    totals = total.groupBy(F.col(source).alias("source")).agg(F.countDistinct(item).alias("total"))
    hits = matched.groupBy(F.col(matched_source).alias("source")).agg(
        F.countDistinct(matched_item).alias("matched")
    )
    hit = F.coalesce("matched", F.lit(0))
    return totals.join(hits, "source", "left").select(
        "source", "total", hit.alias("matched"), pct(hit, F.col("total")).alias("match_pct")
    )


def combined_stories(newswire: DataFrame, web: DataFrame) -> DataFrame:
    """Distinct (date, rp_story_id) matched by either source."""
    return newswire.select("date", "rp_story_id").union(web.select("date", "rp_story_id")).distinct()


def daily_match_rate(feed: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Per feed day: rows (``rp_total``) and, per source, distinct matched stories and percent.

    The denominator counts rows while the numerator counts distinct stories. Matched stories
    of all sources are counted in one grouped pass.
    """
    daily = count_by_day(feed, "date", "rp_total")
    parts = [
        df.select("date", "rp_story_id", F.lit(name).alias("_source")) for name, df in sources.items()
    ]
    pairs = reduce(DataFrame.unionByName, parts).distinct()
    counts = pairs.groupBy("date").agg(
        *[F.count(F.when(F.col("_source") == name, F.col("rp_story_id"))).alias(f"{name}_matched")
          for name in sources]
    )
    joined = daily.join(counts, "date", "left").na.fill(0)
    rates = {f"{n}_pct": pct(F.col(f"{n}_matched"), F.col("rp_total")) for n in sources}
    return joined.withColumns(rates)


def average_match_rate(daily: DataFrame) -> DataFrame:
    """Mean daily percentage per source, and what web titles add to newswire."""
    means = {n: F.avg(f"{n}_pct") for n in ("nw", "web", "combined")}
    return daily.agg(
        *[mean.alias(f"avg_{n}") for n, mean in means.items()],
        (means["combined"] - means["nw"]).alias("uplift"),
    )


def score_bands(crosswalk: DataFrame, score: str = "fuzzy_score") -> DataFrame:
    """Matches scoring 90 and above, and 80 to below 90, with their share."""
    s = F.col(score)
    high, middle = F.count_if(s >= 90), F.count_if((s >= 80) & (s < 90))
    return crosswalk.agg(
        high.alias("n_90_up"),
        pct(high, _rows()).alias("pct_90_up"),
        middle.alias("n_80_90"),
        pct(middle, _rows()).alias("pct_80_90"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins count 0."""
    low = df.agg(F.min(column).cast("double")).scalar()
    high = df.agg(F.max(column).cast("double")).scalar()
    width = (high - low) / bins
    place = F.try_divide(F.col(column).cast("double") - low, high - low) * bins
    index = F.least(F.floor(F.coalesce(place, F.lit(0.0))), F.lit(bins - 1)).cast("int")
    counts = df.filter(F.col(column).isNotNull()).groupBy(index.alias("bin")).agg(_rows().alias("_n"))
    spine = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counts, "bin", "left").select(
        "bin",
        (low + F.col("bin") * width).alias("bin_low"),
        (low + (F.col("bin") + 1) * width).alias("bin_high"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


# --- gaps --------------------------------------------------------------------------------


def monthly_gaps(titles: DataFrame, feed: DataFrame, extra: list[DataFrame] | None = None) -> DataFrame:
    """Every month from the first to the last date of all inputs, with both sides' volumes."""
    dates = titles.select("date").unionByName(feed.select("date"))
    for df in extra or []:
        dates = dates.unionByName(df.select("date"))
    months = F.sequence(
        F.trunc(F.min("date"), "month"), F.trunc(F.max("date"), "month"), F.expr("interval 1 month")
    )
    spine = dates.agg(months.alias("_m")).select(F.explode("_m").alias("month"))
    return (
        spine.join(count_by_month(titles, "date", "nw_count", "nw_days"), "month", "left")
        .join(count_by_month(feed, "date", "rp_count", "rp_days"), "month", "left")
        .na.fill(0)
    )


def sparse_months(gaps: DataFrame, fewer_than: int = 50) -> DataFrame:
    return gaps.filter((F.col("nw_count") < fewer_than) | (F.col("rp_count") < fewer_than))


def filter_funnel(df: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """Rows left after each further condition, with the percentage of the stage before.

    One scan counts all stages; each stage also requires the ones before it.
    """
    condition, counts = F.lit(True), [_rows().alias("_0")]
    for i, predicate in enumerate(stages.values(), 1):
        condition = condition & predicate
        counts.append(F.count_if(condition).alias(f"_{i}"))
    labels = ["all rows", *stages]
    entries = [
        F.struct(F.lit(i).alias("stage"), F.lit(label).alias("label"), F.col(f"_{i}").alias("n"))
        for i, label in enumerate(labels)
    ]
    rows = df.agg(*counts).select(F.explode(F.array(*entries)).alias("_e")).select("_e.*")
    # A handful of rows: one per stage.
    before = F.lag("n").over(Window.orderBy("stage"))
    return rows.withColumn("pct_of_previous", pct(F.col("n"), before))


def empty_weekdays(days: DataFrame, rows: DataFrame, date: str = "date") -> DataFrame:
    """Listed days, Monday to Friday, without a single row."""
    busy = rows.select(F.col(date).alias("date")).distinct()
    return days.filter(F.weekday("date") < 5).join(busy, "date", "left_anti")
