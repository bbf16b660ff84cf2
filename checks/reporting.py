"""Coverage, match rates, gaps, distributions and ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import matching, tables
from checks.matching import web_titles
from checks.registry import check
from titleweave.operators import coverage, ledger, rows
from titleweave.operators.panel import rolling_mean
from titleweave.plans import reports
from titleweave.session import freeze


def newswire(spark: SparkSession, folder: str) -> DataFrame:
    """The crosswalk as the reports see it: a table that has been written once."""
    return freeze(matching.newswire(spark, folder))


def web(spark: SparkSession, folder: str) -> DataFrame:
    return freeze(matching.web(spark, folder))


def feed_days(spark: SparkSession, folder: str) -> DataFrame:
    return tables.feed(spark, folder).withColumn("date", F.to_date("timestamp_utc"))


def title_days(spark: SparkSession, folder: str) -> DataFrame:
    titles = tables.newswire_titles(spark, folder)
    return titles.withColumn("date", F.to_date("date"))


class _Window:
    """Inputs of the quality report, cut to the date range both crosswalks cover."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        nw, gd = newswire(spark, folder), web(spark, folder)
        window = coverage.overlap_window(nw, gd)
        self.newswire, self.web = coverage.within(nw, window), coverage.within(gd, window)
        self.titles = coverage.within(title_days(spark, folder), window)
        self.feed = coverage.within(feed_days(spark, folder), window)


@check("count_by_day", "select timestamp_utc::date::varchar as date, count(*) as n from feed group by 1")
def _(spark, folder):
    return coverage.count_by_day(feed_days(spark, folder))


@check(
    "count_by_month",
    """select strftime(ts, '%Y-%m-01') as month, count(*) as n, count(distinct ts::date) as n_days
       from (select o_orderdate as ts from orders) group by 1""",
)
def _(spark, folder):
    orders = tables.table(spark, folder, "orders")
    return coverage.count_by_month(orders, "o_orderdate", "n", "n_days")


@check(
    "distinct_sources_by_year",
    "select year(gkg_date) as year, count(distinct source_name) as n_sources from web_titles group by 1",
)
def _(spark, folder):
    return coverage.distinct_sources_by_year(web_titles(spark, folder), "gkg_date", "source_name")


@check("count_by_source", "select rp_source_name, count(*) as n from nw_cw group by 1")
def _(spark, folder):
    return coverage.count_by_source(newswire(spark, folder), "rp_source_name")


@check(
    "top_sources",
    "select source_name, count(*) as n from feed group by 1 order by n desc, source_name limit 7",
)
def _(spark, folder):
    return coverage.count_by_source(tables.feed(spark, folder), "source_name", 7)


@check(
    "table_profile",
    """select count(*) as n_rows, min(mbrstartdt)::varchar as earliest_mbrstartdt,
              max(mbrstartdt)::varchar as latest_mbrstartdt, min(mbrenddt)::varchar as earliest_mbrenddt,
              max(mbrenddt)::varchar as latest_mbrenddt, count(distinct permno) as distinct_permno,
              3 as n_columns, 'permno,mbrstartdt,mbrenddt' as columns from spells""",
)
def _(spark, folder):
    return coverage.table_profile(tables.spells(spark, folder), ["mbrstartdt", "mbrenddt"], ["permno"])


@check(
    "clip_to_range",
    """select timestamp_utc::date::varchar as date, rp_story_id from feed
       where timestamp_utc::date between (select min(date) from nw_cw) and (select max(date) from nw_cw)""",
)
def _(spark, folder):
    clipped = coverage.clip_to_range_of(feed_days(spark, folder), newswire(spark, folder))
    return clipped.select("date", "rp_story_id")


@check("overlap_window", "select date_start::varchar as date_start, date_end::varchar as date_end from overlap")
def _(spark, folder):
    return coverage.overlap_window(newswire(spark, folder), web(spark, folder))


@check(
    "shared_days",
    """select distinct date::date::varchar as date from newswire_titles
       where date::date in (select gkg_date::date from web_titles)""",
)
def _(spark, folder):
    pages = web_titles(spark, folder).withColumn("date", F.to_date("gkg_date"))
    return coverage.shared_days(title_days(spark, folder), pages)


@check(
    "shared_months",
    """select distinct year(date::date) as year, month(date::date) as month from newswire_titles
       intersect select year(timestamp_utc), month(timestamp_utc) from feed""",
)
def _(spark, folder):
    return coverage.shared_months(title_days(spark, folder), feed_days(spark, folder))


@check(
    "crosswalk_summary",
    """select count(*) as n_rows, min(date)::varchar as first_date, max(date)::varchar as last_date,
              count(distinct date) as n_dates, count(distinct nw_source_url) as n_urls,
              count(distinct rp_story_id) as n_stories, count(distinct rp_entity_id) as n_entities,
              round(min(fuzzy_score), 6) as min_score, round(median(fuzzy_score), 6) as median_score,
              round(avg(fuzzy_score), 6) as mean_score, round(max(fuzzy_score), 6) as max_score from nw_cw""",
)
def _(spark, folder):
    return coverage.crosswalk_summary(newswire(spark, folder), "nw_source_url")


@check(
    "match_rates",
    """with s as (select count(distinct rp_story_id) as t from feed_in),
            u as (select count(distinct source_url) as t from titles_in)
       select metric, matched, total, round(matched * 100.0 / total, 6) as match_pct from (
         select 'rp_combined' as metric, (select count(distinct rp_story_id) from (
            select rp_story_id from nw_in union all select rp_story_id from gd_in)) as matched, t as total from s
         union all select 'rp_newswire', (select count(distinct rp_story_id) from nw_in), t from s
         union all select 'rp_web', (select count(distinct rp_story_id) from gd_in), t from s
         union all select 'nw_titles', (select count(distinct nw_source_url) from nw_in), t from u)""",
)
def _(spark, folder):
    w = _Window(spark, folder)
    return coverage.match_rates(w.newswire, w.web, w.titles, w.feed)


@check(
    "coverage_by_title_source",
    """select source, total, coalesce(matched, 0) as matched, round(coalesce(matched, 0) * 100.0 / total, 6) as match_pct
       from (select source, count(distinct source_url) as total from titles_in group by 1)
       left join (select nw_source as source, count(distinct nw_source_url) as matched from nw_in group by 1) using (source)""",
)
def _(spark, folder):
    w = _Window(spark, folder)
    return coverage.coverage_by_source(
        w.titles, "source", "source_url", w.newswire, "nw_source", "nw_source_url"
    )


@check(
    "coverage_by_feed_source",
    """select source, total, coalesce(matched, 0) as matched, round(coalesce(matched, 0) * 100.0 / total, 6) as match_pct
       from (select source_name as source, count(distinct rp_story_id) as total from feed_in group by 1)
       left join (select rp_source_name as source, count(distinct rp_story_id) as matched from nw_in group by 1)
         using (source)""",
)
def _(spark, folder):
    w = _Window(spark, folder)
    return coverage.coverage_by_source(
        w.feed, "source_name", "rp_story_id", w.newswire, "rp_source_name", "rp_story_id"
    )


@check(
    "combined_stories",
    "select date::varchar as date, rp_story_id from nw_cw union select date::varchar, rp_story_id from gd_cw",
)
def _(spark, folder):
    return coverage.combined_stories(newswire(spark, folder), web(spark, folder))


_DAILY = """
  select date, rp_total, coalesce(nw, 0) as nw_matched, coalesce(gd, 0) as web_matched, coalesce(b, 0) as combined_matched,
         coalesce(nw, 0) * 100.0 / rp_total as nw_pct, coalesce(gd, 0) * 100.0 / rp_total as web_pct,
         coalesce(b, 0) * 100.0 / rp_total as combined_pct
  from (select date, count(*) as rp_total from feed_in group by 1)
  left join (select date, count(distinct rp_story_id) as nw from nw_in group by 1) using (date)
  left join (select date, count(distinct rp_story_id) as gd from gd_in group by 1) using (date)
  left join (select date, count(distinct rp_story_id) as b from (select date, rp_story_id from nw_in
             union all select date, rp_story_id from gd_in) group by 1) using (date)"""


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    w = _Window(spark, folder)
    both = coverage.combined_stories(w.newswire, w.web)
    sources = {"nw": w.newswire, "web": w.web, "combined": both}
    return coverage.daily_match_rate(w.feed, sources)


@check(
    "daily_match_rate_by_source",
    f"""select date::varchar as date, rp_total, nw_matched, web_matched, combined_matched, round(nw_pct, 6) as nw_pct,
               round(web_pct, 6) as web_pct, round(combined_pct, 6) as combined_pct from ({_DAILY})""",
)
def _(spark, folder):
    return _daily(spark, folder)


@check(
    "average_match_rate",
    f"""select round(avg(nw_pct), 6) as avg_nw, round(avg(web_pct), 6) as avg_web,
               round(avg(combined_pct), 6) as avg_combined, round(avg(combined_pct) - avg(nw_pct), 6) as uplift
        from ({_DAILY})""",
)
def _(spark, folder):
    return coverage.average_match_rate(_daily(spark, folder))


@check(
    "coverage_series",
    """with d as (
         select date, rp_total, coalesce(m, 0) as matched, coalesce(m, 0) * 100.0 / rp_total as match_pct
         from (select timestamp_utc::date as date, count(*) as rp_total from feed
               where timestamp_utc::date between (select min(date) from nw_cw) and (select max(date) from nw_cw) group by 1)
         left join (select date, count(distinct rp_story_id) as m from (select date, rp_story_id from nw_cw
                    union all select date, rp_story_id from gd_cw) group by 1) using (date))
       select date::varchar as date, rp_total, matched, round(match_pct, 6) as match_pct,
              round(case when count(*) over w >= 5 then avg(match_pct) over w end, 6) as match_pct_ma
       from d window w as (order by date rows between 4 preceding and current row)""",
)
def _(spark, folder):
    return reports.coverage_series(
        tables.feed(spark, folder), newswire(spark, folder), web(spark, folder)
    )


@check(
    "rolling_mean_30",
    """select day::varchar as day, n, round(case when count(*) over w >= 30 then avg(n) over w end, 6) as ma,
              round(avg(n) over w, 6) as ma_partial
       from (select ts::date as day, count(*) as n from events group by 1)
       window w as (order by day rows between 29 preceding and current row)""",
)
def _(spark, folder):
    daily = tables.event_days(spark, folder).groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    full = rolling_mean(daily, "day", {"ma": "n"}, 30, slice_rows=20)
    return rolling_mean(full, "day", {"ma_partial": "n"}, 30, min_periods=1)


@check(
    "score_bands",
    """select count(*) filter (fuzzy_score >= 90) as n_90_up,
              round(count(*) filter (fuzzy_score >= 90) * 100.0 / count(*), 6) as pct_90_up,
              count(*) filter (fuzzy_score >= 80 and fuzzy_score < 90) as n_80_90,
              round(count(*) filter (fuzzy_score >= 80 and fuzzy_score < 90) * 100.0 / count(*), 6) as pct_80_90 from nw_cw""",
)
def _(spark, folder):
    return coverage.score_bands(newswire(spark, folder))


@check(
    "score_histogram",
    """with b as (select min(value) as lo, max(value) as hi from events),
            c as (select least(floor((value - lo) / (hi - lo) * 40), 39)::int as bin, count(*) as n from events, b group by 1)
       select s.bin, round(lo + s.bin * ((hi - lo) / 40), 6) as bin_low,
              round(lo + (s.bin + 1) * ((hi - lo) / 40), 6) as bin_high, coalesce(n, 0) as n
       from (select range::int as bin from range(40)) s left join c using (bin), b""",
)
def _(spark, folder):
    return coverage.histogram(tables.table(spark, folder, "events"), "value", 40)


_GAPS = """
  select m.month, coalesce(nw_count, 0) as nw_count, coalesce(nw_days, 0) as nw_days,
         coalesce(rp_count, 0) as rp_count, coalesce(rp_days, 0) as rp_days
  from (select range::date as month from range(
          (select date_trunc('month', least((select min(date::date) from newswire_titles), (select min(o_orderdate)::date from orders)))::date),
          (select greatest((select max(date::date) from newswire_titles), (select max(o_orderdate)::date from orders)) + 1),
          interval 1 month)) m
  left join (select date_trunc('month', date::date)::date as month, count(*) as nw_count,
                    count(distinct date) as nw_days from newswire_titles group by 1) using (month)
  left join (select date_trunc('month', o_orderdate)::date as month, count(*) as rp_count,
                    count(distinct o_orderdate::date) as rp_days from orders group by 1) using (month)"""


def _gaps(spark: SparkSession, folder: str) -> DataFrame:
    orders = tables.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("date"))
    return coverage.monthly_gaps(title_days(spark, folder), orders)


@check("monthly_gaps", f"select * replace (month::varchar as month) from ({_GAPS})")
def _(spark, folder):
    return _gaps(spark, folder)


@check(
    "sparse_months",
    f"select * replace (month::varchar as month) from ({_GAPS}) where nw_count < 50 or rp_count < 50",
)
def _(spark, folder):
    return coverage.sparse_months(_gaps(spark, folder))


@check(
    "map_source_names",
    """select source_url, case source when 'com' then 'Commercial' when 'org' then 'Organisation' else 'Unknown' end
         as source_name from newswire_titles""",
)
def _(spark, folder):
    names = {"com": "Commercial", "org": "Organisation"}
    titles = tables.newswire_titles(spark, folder)
    return titles.select("source_url", rows.map_values(F.col("source"), names).alias("source_name"))


@check(
    "blank_titles_dropped",
    r"""select doc_id, len(lines) as n_lines from (
          select doc_id, list_filter(string_split(text, chr(10)), lambda t: regexp_matches(t, '[^\s\p{Z}]')) as lines
          from documents) where len(lines) > 0""",
)
def _(spark, folder):
    from titleweave.functions.text import has_text

    lines = tables.table(spark, folder, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("t"))
    return lines.filter(has_text(F.col("t"))).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


# --- ledgers -----------------------------------------------------------------------------


def _wanted(spark: SparkSession, folder: str) -> DataFrame:
    """Every (source, day) of January 2024 for the sources seen in the events."""
    first, last = F.lit("2024-01-01").cast("date"), F.lit("2024-01-31").cast("date")
    sources = tables.event_days(spark, folder).select("source").distinct()
    return sources.withColumn("day", F.explode(F.sequence(first, last)))


_PENDING = """
  select source, range::date as day from (select distinct source from event_days),
         range(date '2024-01-01', date '2024-02-01', interval 1 day)
  where (source, range::date) not in (select (source, day) from event_ledger)"""


@check("pending_days", f"select source, day::varchar as day from ({_PENDING})")
def _(spark, folder):
    return ledger.pending_days(_wanted(spark, folder), tables.event_ledger(spark, folder))


@check("first_incomplete_day", f"select source, min(day)::varchar as day from ({_PENDING}) group by 1")
def _(spark, folder):
    return ledger.first_incomplete_day(_wanted(spark, folder), tables.event_ledger(spark, folder))


@check(
    "month_status",
    """select source, '2024-01-01' as month, count(distinct day) as done_days, 20 as expected_days,
              (count(distinct day) >= 20)::int as complete from event_ledger group by source""",
)
def _(spark, folder):
    return ledger.month_status(tables.event_ledger(spark, folder), "2024-01-20")


@check(
    "months_to_rebuild",
    """select source, '2024-01-01' as month from (select distinct source from event_days) where source not in ('click', 'view')""",
)
def _(spark, folder):
    """Two sources are unchanged, the others have a new input version."""
    done = tables.event_ledger(spark, folder).withColumn("month", F.trunc("day", "month"))
    version = F.when(F.col("source").isin("click", "view"), "v1").otherwise("v2")
    inputs = (
        tables.event_days(spark, folder)
        .select("source", F.trunc("day", "month").alias("month"))
        .distinct()
        .withColumn("input_version", version)
    )
    return ledger.months_to_rebuild(inputs, done)


_STATES = """(select source, 'v1' as now, case source when 'view' then 'v2' when 'click' then null else 'v1' end as last
              from (select distinct source from event_days))"""


@check(
    "months_to_rebuild_after_changes",
    f"""select source, '2024-01-01' as month from {_STATES}
        where (case when source = 'purchase' then null else now end) is distinct from last""",
)
def _(spark, folder):
    """One source went back to an earlier version, one was never built, one is gone: the last state counts."""
    sources = tables.event_days(spark, folder).select("source", F.trunc("day", "month").alias("month")).distinct()
    entry = lambda version, day: (F.lit(version).alias("input_version"), F.lit(day).cast("timestamp").alias("done_at"))
    past = sources.select("*", *entry("v1", "2024-02-01")).where("source <> 'click'")
    past = past.unionByName(sources.select("*", *entry("v2", "2024-02-02")).where("source = 'view'"))
    inputs = sources.where("source <> 'purchase'").withColumn("input_version", F.lit("v1"))
    return ledger.months_to_rebuild(inputs, past)


@check(
    "days_redone_are_settled",
    "select source, day::varchar as day from event_ledger where schema_version < 2 and source <> 'view'",
)
def _(spark, folder):
    """Days that were written again with the newer schema are no longer due."""
    old = tables.event_ledger(spark, folder).withColumn("done_at", F.lit("2024-02-01").cast("timestamp"))
    again = old.where("source = 'view'").withColumns({"schema_version": F.lit(2), "done_at": F.lit("2024-02-02").cast("timestamp")})
    return ledger.days_due_again(old.unionByName(again), 2)


@check(
    "late_rows",
    """select event_id, ((source, day) in (select (source, day) from event_ledger))::int as late from event_days""",
)
def _(spark, folder):
    flagged = ledger.flag_late_rows(tables.event_days(spark, folder), tables.event_ledger(spark, folder))
    return flagged.select("event_id", "late")


@check(
    "days_due_again",
    "select source, day::varchar as day from event_ledger where schema_version < 2",
)
def _(spark, folder):
    return ledger.days_due_again(tables.event_ledger(spark, folder), 2)


@check(
    "ledger_entries",
    """select w.source, w.day::varchar as day, coalesce(n, 0) as row_count, 3 as schema_version
       from (select source, range::date as day from (select distinct source from event_days),
             range(date '2024-01-01', date '2024-02-01', interval 1 day)) w
       left join (select source, day, count(*) as n from event_days group by 1, 2) d
         on w.source = d.source and w.day = d.day""",
)
def _(spark, folder):
    entries = ledger.ledger_entries(_wanted(spark, folder), tables.event_days(spark, folder), 3)
    return entries.drop("input_version")


@check(
    "empty_weekdays",
    """select d::varchar as date from (select range::date as d from range(date '2024-01-01', date '2024-02-15', interval 1 day))
       where isodow(d) < 6 and d not in (select ts::date from events)""",
)
def _(spark, folder):
    days = ledger.calendar(spark, "2024-01-01", "2024-02-15").withColumnRenamed("day", "date")
    return coverage.empty_weekdays(days, tables.event_days(spark, folder).withColumnRenamed("day", "date"))


@check(
    "after_first_coverage",
    """select source, month from (
         select case o_orderpriority when '5-LOW' then 'globenewswire' when '1-URGENT' then 'newswireca' else 'other' end
                  as source, strftime(o_orderdate + interval 25 year, '%Y-%m') as month from orders)
       where (source = 'other' or (source = 'globenewswire' and month >= '2023-04')
              or (source = 'newswireca' and month >= '2011-01'))
       group by all""",
)
def _(spark, folder):
    source = (
        F.when(F.col("o_orderpriority") == "5-LOW", "globenewswire")
        .when(F.col("o_orderpriority") == "1-URGENT", "newswireca")
        .otherwise("other")
    )
    month = F.date_format(F.add_months("o_orderdate", 300), "yyyy-MM")
    months = tables.table(spark, folder, "orders").select(source.alias("source"), month.alias("month"))
    return ledger.after_first_coverage(months).distinct()


@check("in_month_prefix", "select source_url, date from newswire_titles where date like '2024-03%'")
def _(spark, folder):
    titles = tables.newswire_titles(spark, folder)
    return ledger.in_month_prefix(titles, "2024-03").select("source_url", "date")
