"""Weighted statistics, lags, identifiers, calendars and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import tables
from checks.matching import web_titles
from checks.registry import check
from titleweave.functions import dates, identifiers
from titleweave.operators import panel, rows
from titleweave.session import new_folder
from titleweave.sources import web_extract
from titleweave.streaming import days, earliest
from titleweave.streaming import titles as streams


def items(spark: SparkSession, folder: str) -> DataFrame:
    return tables.table(spark, folder, "lineitem")


@check(
    "weighted_average",
    "select round(sum(l_extendedprice * l_quantity) / sum(l_quantity), 6) as weighted_average from lineitem",
)
def _(spark, folder):
    return panel.weighted_average(items(spark, folder), "l_extendedprice", "l_quantity")


@check(
    "group_weighted_average",
    """select l_returnflag, round(sum(x * l_quantity) / sum(l_quantity) filter (x is not null), 6) as weighted_average
       from (select *, case when l_discount > 0.02 then l_extendedprice end as x from lineitem) group by 1""",
)
def _(spark, folder):
    rows_ = items(spark, folder).withColumn("x", F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")))
    return panel.group_weighted_average(rows_, "x", "l_quantity", ["l_returnflag"])


@check(
    "weighted_average_on_rows",
    """select l_orderkey, l_linenumber, l_partkey, round(sum(l_tax * l_quantity) over w / sum(l_quantity) over w, 6) as avg_tax
       from lineitem window w as (partition by l_suppkey)""",
)
def _(spark, folder):
    result = panel.with_group_weighted_average(
        items(spark, folder), "l_tax", "l_quantity", ["l_suppkey"], "avg_tax"
    )
    return result.select("l_orderkey", "l_linenumber", "l_partkey", "avg_tax")


@check(
    "group_weighted_std",
    """select l_returnflag, l_linestatus,
              round(sqrt(sum(l_quantity * (l_discount - m) ** 2) / ((count(*) - 1) / count(*) * sum(l_quantity))), 6) as weighted_std
       from (select *, sum(l_discount * l_quantity) over w / sum(l_quantity) over w as m from lineitem
             window w as (partition by l_returnflag, l_linestatus)) group by 1, 2""",
)
def _(spark, folder):
    return panel.group_weighted_std(
        items(spark, folder), "l_discount", "l_quantity", ["l_returnflag", "l_linestatus"]
    )


def _quantile_sql(source: str, by: str, value: str, weight: str, quantiles: dict[str, float], old_style: bool, digits: int = 6) -> str:
    """Every row as one point of the curve, interpolated between its neighbours."""
    part = f"partition by {by}" if by else ""
    group = f"{by}, " if by else ""
    p = "(c - h) / nullif(t - tl / 2 - h, 0)" if old_style else "c / t"
    parts = []
    for name, q in quantiles.items():
        below = f"max(case when p <= {q} then {{'p': p, 'v': v}} end)"
        above = f"min(case when p > {q} then {{'p': p, 'v': v}} end)"
        inner = f"{below}.v + ({q} - {below}.p) / ({above}.p - {below}.p) * ({above}.v - {below}.v)"
        parts.append(f"round(coalesce({inner}, {below}.v, {above}.v), {digits}) as {name}")
    return f"""
      select {group}{', '.join(parts)} from (
        select *, coalesce({p}, 0) as p from (
          select {group}{value} as v, sum({weight}) over (o rows unbounded preceding) - {weight} / 2 as c,
                 sum({weight}) over ({part}) as t, first_value({weight}) over o / 2 as h,
                 last_value({weight}) over (o rows between unbounded preceding and unbounded following) as tl
          from {source} window o as ({part} order by {value}, {weight})))
      {'group by ' + by if by else ''}"""


_Q = {"q05": 0.05, "q25": 0.25, "median": 0.5, "q75": 0.75, "q99": 0.99}


@check("weighted_quantiles", _quantile_sql("lineitem", "", "l_extendedprice", "l_quantity", _Q, False))
def _(spark, folder):
    return panel.weighted_quantiles(items(spark, folder), "l_extendedprice", "l_quantity", _Q)


@check(
    "weighted_quantiles_by_group",
    _quantile_sql("lineitem", "l_suppkey", "l_discount", "l_quantity", _Q, False),
)
def _(spark, folder):
    return panel.weighted_quantiles(items(spark, folder), "l_discount", "l_quantity", _Q, ["l_suppkey"])


@check(
    "weighted_quantiles_old_style",
    _quantile_sql("lineitem", "l_returnflag", "l_extendedprice", "l_quantity", _Q, True),
)
def _(spark, folder):
    return panel.weighted_quantiles(
        items(spark, folder), "l_extendedprice", "l_quantity", _Q, ["l_returnflag"], old_style=True
    )


_SERIES = _quantile_sql(
    "(select ts::date as day, value, user_id + 1.0 as w from events)", "day", "value", "w",
    {"median": 0.5, "lower": 0.25, "upper": 0.75}, False, digits=15,
)


@check(
    "weighted_quantile_series",
    f"""select day::varchar as day, round(avg(median) over w * 100, 4) as median, round(avg(lower) over w * 100, 4) as lower,
               round(avg(upper) over w * 100, 4) as upper
        from ({_SERIES}) window w as (order by day rows between 4 preceding and current row)""",
)
def _(spark, folder):
    events = tables.table(spark, folder, "events").select(
        F.to_date("ts").alias("day"), "value", (F.col("user_id") + 1.0).alias("w")
    )
    series = panel.weighted_quantile_series(
        events, "day", "value", "w", window=5, min_periods=1, rescale=100.0
    )
    return series.select("day", *[F.round(c, 4).alias(c) for c in ("median", "lower", "upper")])


@check(
    "lag_by_id",
    """select event_id, user_id, coalesce(round(lag(value, 2) over (partition by user_id order by ts, event_id), 6)::varchar, '-') as lagged
       from events""",
)
def _(spark, folder):
    events = tables.table(spark, folder, "events")
    lagged = panel.lag_by_id(events, ["user_id"], ["ts", "event_id"], ["value"], 2)
    shown = F.coalesce(F.round("L2_value", 6).cast("string"), F.lit("-"))
    return lagged.select("event_id", "user_id", shown.alias("lagged"))


# Parts of a supplier have many months without a shipment.
_MONTHLY = """(select l_suppkey * 1000000 + l_partkey as id, date_trunc('month', l_shipdate)::date as date,
                      max(l_quantity) as value
              from lineitem group by 1, 2)"""


@check(
    "lag_by_null_id",
    """select event_id, coalesce(case when u is not null then round(lag(value) over (partition by u order by ts, event_id), 6) end::varchar, '-') as lagged
       from (select *, case when user_id % 3 <> 0 then user_id end as u from events)""",
)
def _(spark, folder):
    """A third of the ids is null: those rows have no predecessor."""
    events = tables.table(spark, folder, "events").withColumn("u", F.when(F.col("user_id") % 3 != 0, F.col("user_id")))
    lagged = panel.lag_by_id(events, ["u"], ["ts", "event_id"], ["value"])
    return lagged.select("event_id", F.coalesce(F.round("L1_value", 6).cast("string"), F.lit("-")).alias("lagged"))


@check(
    "lag_by_hot_id",
    """select event_id, coalesce(round(lag(value, 1) over (partition by event_type order by ts, event_id), 6)::varchar, '-') as lagged
       from events""",
)
def _(spark, folder):
    """Five ids hold all rows: slices of a hundred rows, far fewer than an id has."""
    events = tables.table(spark, folder, "events")
    lagged = panel.lag_by_id(events, ["event_type"], ["ts", "event_id"], ["value"], slice_rows=100)
    shown = F.coalesce(F.round("L1_value", 6).cast("string"), F.lit("-"))
    return lagged.select("event_id", shown.alias("lagged"))


@check(
    "weighted_quantiles_sliced",
    _quantile_sql("lineitem", "l_linestatus", "l_extendedprice", "l_quantity", _Q, False),
)
def _(spark, folder):
    return panel.weighted_quantiles(
        items(spark, folder), "l_extendedprice", "l_quantity", _Q, ["l_linestatus"], slice_rows=1000
    )


@check(
    "lag_on_calendar",
    f"""with p as {_MONTHLY},
             g as (select id, month::date as date from (select distinct id from p),
                   (select unnest(range((select min(date) from p), (select max(date) from p) + interval 1 day, interval 1 month)) as month)),
             l as (select g.id, g.date, p.value, lag(p.value, 2) over (partition by g.id order by g.date) as lagged
                   from g left join p using (id, date))
        select id, date::varchar as date, coalesce(value, -1) as value, coalesce(lagged, -1) as L2_value
        from l where value is not null or lagged is not null""",
)
def _(spark, folder):
    pair = (F.col("l_suppkey") * 1000000 + F.col("l_partkey")).alias("id")
    monthly = (
        items(spark, folder)
        .groupBy(pair, F.trunc("l_shipdate", "month").alias("date"))
        .agg(F.max("l_quantity").alias("value"))
    )
    return panel.lag_on_calendar(monthly, "value", "id", lags=2, freq="MS").na.fill(-1)


@check(
    "lag_on_business_months",
    """with p as (select l_suppkey as id, date_trunc('month', l_shipdate)::date as month, max(l_quantity) as value
                  from lineitem group by 1, 2),
             g as (select id, month::date as month from (select distinct id from p),
                   (select unnest(range((select min(month) from p), (select max(month) from p) + interval 1 day, interval 1 month)) as month)),
             l as (select g.id, g.month, p.value, lag(p.value) over (partition by g.id order by g.month) as lagged
                   from g left join p using (id, month))
        select id, (month + case isodow(month) when 6 then 2 when 7 then 1 else 0 end)::date::varchar as date,
               coalesce(value, -1) as value, coalesce(lagged, -1) as L1_value
        from l where value is not null or lagged is not null""",
)
def _(spark, folder):
    """Months labelled by their first working day."""
    month = F.trunc("l_shipdate", "month")
    first = F.date_add(month, F.when(F.weekday(month) == 5, 2).when(F.weekday(month) == 6, 1).otherwise(0))
    monthly = items(spark, folder).groupBy(F.col("l_suppkey").alias("id"), first.alias("date")).agg(
        F.max("l_quantity").alias("value")
    )
    return panel.lag_on_calendar(monthly, "value", "id", freq="BMS").na.fill(-1)


@check(
    "leave_one_out_sums",
    """select l_orderkey, l_linenumber, l_partkey, l_suppkey, round(sum(l_quantity) over (partition by l_suppkey) - l_quantity, 6) as others
       from lineitem""",
)
def _(spark, folder):
    result = panel.leave_one_out_sums(items(spark, folder), ["l_suppkey"], "l_quantity", "others")
    return result.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "others")


@check(
    "freq_counts",
    """select l_quantity, n as "count", round(n * 100.0 / sum(n) over (), 6) as freq,
              round(sum(n) over (order by n desc, l_quantity rows unbounded preceding) * 100.0 / sum(n) over (), 6) as cum_freq
       from (select l_quantity, count(*) as n from lineitem group by 1)""",
)
def _(spark, folder):
    return rows.freq_counts(items(spark, folder), "l_quantity")


@check(
    "number_rows",
    "select event_id, row_number() over (order by ts, event_id) as row from events",
)
def _(spark, folder):
    events = tables.table(spark, folder, "events").withColumn("_all", F.lit(0))
    numbered = rows.number_rows(events, ["_all"], [F.col("ts"), F.col("event_id")])
    return numbered.select("event_id", "row")


@check(
    "columns_to_front",
    "select p_name, p_brand, p_partkey, p_type, p_size, p_retailprice from part",
)
def _(spark, folder):
    return rows.move_columns_to_front(tables.table(spark, folder, "part"), ["p_name", "p_brand"])


@check(
    "fill_zero",
    "select doc_id, coalesce(quality, 0) as quality, coalesce(toxic, 0) as toxic from documents left join labels using (doc_id)",
)
def _(spark, folder):
    docs = tables.table(spark, folder, "documents").select("doc_id")
    return rows.fill_zero(docs.join(tables.table(spark, folder, "labels"), "doc_id", "left"))


_CUSIP = """
  select c_custkey, code, list_sum(list_transform(range(1, 9), lambda i:
           (v[i] * (1 + (i - 1) % 2)) // 10 + (v[i] * (1 + (i - 1) % 2)) % 10)) as total
  from (select *, list_transform(range(1, 9), lambda i:
          instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ*@#', code[i]) - 1) as v
        from (select c_custkey, upper(c_mktsegment[1:3]) || lpad((c_custkey % 100000)::varchar, 5, '0') as code from customer))"""


@check("cusip_8_to_9", f"select c_custkey, code || ((10 - total % 10) % 10)::int as cusip from ({_CUSIP})")
def _(spark, folder):
    code = F.concat(
        F.upper(F.substring("c_mktsegment", 1, 3)),
        F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0"),
    )
    customers = tables.table(spark, folder, "customer")
    return customers.select("c_custkey", identifiers.cusip_8_to_9(code).alias("cusip"))


@check(
    "calendar_ends",
    """select o_orderkey, (date_trunc('quarter', d) - interval 1 day)::date::varchar as recent_quarter_end,
              (date_trunc('quarter', d) + interval 3 month)::date::varchar as next_quarter,
              last_day(d)::varchar as month_end,
              (date_trunc('quarter', d) + interval 3 month - interval 1 day)::date::varchar as quarter_end,
              case when date_trunc('month', d) = date '1998-07-01' then 11 else day(last_day(d)) end as expected_days,
              (d >= date '1997-12-01' and d < date '1998-01-01')::int as in_month
       from (select o_orderkey, o_orderdate::date as d from orders)""",
)
def _(spark, folder):
    d = F.to_date("o_orderdate")
    return tables.table(spark, folder, "orders").select(
        "o_orderkey",
        dates.most_recent_quarter_end(d).alias("recent_quarter_end"),
        dates.next_quarter_start(d).alias("next_quarter"),
        dates.end_of_month(d).alias("month_end"),
        dates.end_of_quarter(d).alias("quarter_end"),
        dates.days_in_month(d, "1998-07-11").alias("expected_days"),
        dates.in_month(d, "1997-12").alias("in_month"),
    )


@check(
    "orders_per_month_range",
    """select greatest(m, date '1996-02-10')::varchar as month_start,
              least(m + interval 1 month, date '1997-01-05')::date::varchar as month_end, count(*) as n
       from (select range::date as m from range(date '1996-02-01', date '1997-01-05', interval 1 month))
       join orders on o_orderdate >= greatest(m, date '1996-02-10') and o_orderdate < least(m + interval 1 month, date '1997-01-05')
       group by 1, 2""",
)
def _(spark, folder):
    """Orders counted in clipped half-open month ranges, joined on the month."""
    ranges = dates.month_ranges(spark, "1996-02-10", "1997-01-05")
    ranges = ranges.withColumn("month", F.trunc("month_start", "month"))
    orders = tables.table(spark, folder, "orders").select(
        "o_orderdate", F.trunc("o_orderdate", "month").alias("month")
    )
    inside = (F.col("o_orderdate") >= F.col("month_start")) & (F.col("o_orderdate") < F.col("month_end"))
    joined = orders.join(ranges, "month").filter(inside)
    return joined.groupBy("month_start", "month_end").agg(F.count(F.lit(1)).alias("n"))


@check(
    "orders_per_quarter_end",
    """select q::varchar as quarter_end, count(o_orderkey) as n from (
         select (range + interval 3 month - interval 1 day)::date as q
         from range(date '1996-01-01', date '1998-10-01', interval 3 month)) left join orders
         on (date_trunc('quarter', o_orderdate) + interval 3 month - interval 1 day)::date = q group by 1""",
)
def _(spark, folder):
    ends = dates.quarter_ends_between(spark, "1996-02-01", "1998-09-30")
    closed = dates.end_of_quarter(F.to_date("o_orderdate"))
    orders = tables.table(spark, folder, "orders").select(closed.alias("quarter_end"), "o_orderkey")
    return ends.join(orders, "quarter_end", "left").groupBy("quarter_end").agg(F.count("o_orderkey").alias("n"))


# --- streams -----------------------------------------------------------------------------


def _landed_web_titles(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """Web titles landed as files, as a crawler would leave them."""
    path = new_folder(spark, "landing")
    titles = web_titles(spark, folder).select("gkg_date", "source_url", "source_name", "headline")
    titles.unionByName(titles).repartition(4, "gkg_date").write.parquet(path)
    return path, titles


@check(
    "stream_ingest",
    "select source_url, headline, strftime(gkg_date, '%Y-%m') as ym, 2 as copies from web_titles",
)
def _(spark, folder):
    """Files appended to a partitioned lake by two runs; the second finds nothing new."""
    landing, titles = _landed_web_titles(spark, folder)
    lake, checkpoint = new_folder(spark, "lake"), new_folder(spark, "progress")
    for _run in range(2):
        stream = streams.stream_parquet(spark, landing, titles.schema, files_per_trigger=2)
        monthly = stream.withColumn("ym", F.date_format("gkg_date", "yyyy-MM"))
        streams.ingest_available(monthly, lake, checkpoint, ["ym"]).awaitTermination()
    stored = spark.read.schema("source_url string, headline string, ym string").parquet(lake)
    return stored.groupBy("source_url", "headline", "ym").agg(F.count(F.lit(1)).alias("copies"))


@check("stream_dedup_titles", "select strftime(gkg_date, '%Y-%m') as ym, headline from web_titles")
def _(spark, folder):
    landing, titles = _landed_web_titles(spark, folder)
    out, checkpoint = new_folder(spark, "deduped"), new_folder(spark, "progress")
    stream = streams.stream_parquet(spark, landing, titles.schema)
    streams.run_available(streams.dedup_titles(stream, delay="100 days"), out, checkpoint)
    return spark.read.parquet(out).select(F.date_format("gkg_date", "yyyy-MM").alias("ym"), "headline")


@check(
    "stream_daily_counts",
    "select ts::date::varchar as date, event_type, count(*) as n from events group by 1, 2",
)
def _(spark, folder):
    """Counts of the days that the watermark has closed, and of the open day from a closing batch pass."""
    events = tables.table(spark, folder, "events")
    out, checkpoint = new_folder(spark, "counts"), new_folder(spark, "progress")
    stream = streams.stream_parquet(spark, folder, events.schema, glob="events.parquet")
    counts = streams.daily_counts(stream, "ts", "0 seconds", ["event_type"])
    streams.run_available(counts, out, checkpoint)
    return streams.with_open_days(spark.read.parquet(out), events, "ts", ["event_type"])


@check(
    "stream_earliest_titles",
    """select strftime(gkg_date, '%Y-%m-%d %H:%M:%S') as gkg_date, source_url, source_name, headline from web_titles""",
)
def _(spark, folder):
    """Each title lands a second time earlier, a month before the next, its own month's last days first."""
    titles = web_titles(spark, folder).select("gkg_date", "source_url", "source_name", "headline")
    later = titles.withColumn("gkg_date", F.least(F.expr("gkg_date + interval 1 hour"), F.expr("cast(last_day(gkg_date) as timestamp) + interval '23:59:59' hour to second")))
    later = later.withColumn("source_url", F.concat(F.lit("z"), "source_url"))
    landing = new_folder(spark, "landing")
    months = [r[0] for r in titles.select(F.trunc("gkg_date", "month").alias("m")).distinct().orderBy("m").collect()]
    for month in months:
        for rows in (later, titles):
            own = rows.where(F.trunc("gkg_date", "month") == F.lit(month)).orderBy(F.desc("gkg_date"))
            own.coalesce(1).write.mode("append").parquet(landing)
    for name, value in earliest.STATE.items():
        spark.conf.set(name, value)
    out, checkpoint = new_folder(spark, "earliest"), new_folder(spark, "progress")
    stream = streams.stream_parquet(spark, landing, titles.schema, files_per_trigger=1)
    found = earliest.earliest_titles(stream, order=["source_url", "source_name"])
    streams.run_available(found, out, checkpoint)
    closed = spark.read.schema(found.schema).parquet(out)
    rows = spark.read.schema(titles.schema).parquet(landing)
    whole = earliest.with_open_months(closed, rows, web_extract.dedup_earliest)
    return whole.withColumn("gkg_date", F.date_format("gkg_date", "yyyy-MM-dd HH:mm:ss"))


def _counted_events(spark: SparkSession, folder: str) -> str:
    """Events landed as three files, each over all days, and counted one file a batch; the path of the result."""
    events = tables.table(spark, folder, "events")
    landing, out, checkpoint = (new_folder(spark, x) for x in ("landing", "days", "progress"))
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(landing)
    for _run in range(2):
        stream = streams.stream_parquet(spark, landing, events.schema, files_per_trigger=1)
        days.count_days(stream, out, checkpoint, "ts", ["event_type"], "2 days").awaitTermination()
    return out


_LANDED = """
with parts as (select *, event_id % 3 as part from events),
latest as (select part, max(max(ts)) over (order by part rows between unbounded preceding and 1 preceding) as seen from parts group by part),
flagged as (select p.*, coalesce(ts::date < (seen - interval 2 day)::date, false) as late from parts p join latest using (part))
"""


@check(
    "stream_late_rows",
    _LANDED + "select part::bigint as batch, event_id, event_type, value from flagged where late",
)
def _(spark, folder):
    """Rows that came after their day was closed are kept, with the batch they came in."""
    return days.late_rows(spark, _counted_events(spark, folder)).select(
        F.col("batch").cast("bigint").alias("batch"), "event_id", "event_type", "value"
    )


@check(
    "stream_counts_and_late_rows",
    _LANDED + """select ts::date::varchar as date, event_type, count(*) filter (not late) as n_counted,
        count(*) filter (late) as n_late, ts::date < (select (max(ts) - interval 2 day)::date from events) as closed
        from flagged group by all""",
)
def _(spark, folder):
    """Counted rows and late rows of a day together are all its rows."""
    out = _counted_events(spark, folder)
    late = days.late_rows(spark, out).groupBy(F.to_date("ts").alias("date"), "event_type").agg(F.count("*").alias("n_late"))
    both = days.day_counts(spark, out, ["event_type"], "2 days").join(late, ["date", "event_type"], "full")
    last = days.ledger(spark, out).agg(F.max("latest")).scalar()
    return both.select(
        F.col("date").cast("string").alias("date"), "event_type", F.coalesce("n", F.lit(0)).alias("n_counted"),
        F.coalesce("n_late", F.lit(0)).alias("n_late"),
        (F.col("date") < F.to_date(last - F.expr("interval 2 days"))).alias("closed"),
    )
