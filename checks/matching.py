"""Crosswalk, enrichment and company matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sql, tables
from checks.registry import check
from titleweave.functions import similarity, text
from titleweave.operators import companies, enrichment, feed, rows
from titleweave.operators.matching import fuzzy_best_match
from titleweave.plans import crosswalk, reports
from titleweave.session import new_folder
from titleweave.sources import web_extract, writers


def web_titles(spark: SparkSession, folder: str) -> DataFrame:
    pages = tables.web_extract(spark, folder)
    selected = web_extract.gkg_extract(
        pages, "2024-01-01", "2024-04-01", ["example.com", "example.org"]
    )
    titles = web_extract.clean_web_titles(selected)
    return titles.withColumns({"year": F.year("gkg_date"), "month": F.month("gkg_date")})


def newswire(spark: SparkSession, folder: str) -> DataFrame:
    titles = tables.newswire_titles(spark, folder)
    return crosswalk.newswire_crosswalk(titles, tables.feed(spark, folder))


def web(spark: SparkSession, folder: str) -> DataFrame:
    return crosswalk.web_crosswalk(web_titles(spark, folder), tables.feed(spark, folder))


_CW = "rp_story_id, rp_entity_id, rp_entity_name, rp_headline, rp_source_name, round(fuzzy_score, 6) as fuzzy_score"


@check("fuzzy_match_newswire", f"select date::varchar as date, nw_source_url, nw_headline, nw_source, {_CW} from nw_cw")
def _(spark, folder):
    return newswire(spark, folder)


@check(
    "fuzzy_match_web",
    f"select date::varchar as date, gdelt_source_url, gdelt_headline, gdelt_source_name, {_CW} from gd_cw",
)
def _(spark, folder):
    return web(spark, folder)


_ALL_LEFT = "(select page_id as id, date::date as date, headline as title, source_url from newswire_titles)"


@check(
    "fuzzy_match_any_month",
    f"select date::varchar as date, source_url, rp_story_id, round(fuzzy_score, 6) as fuzzy_score "
    f"from ({sql.best_match(_ALL_LEFT, 'date, source_url')})",
)
def _(spark, folder):
    titles = tables.newswire_titles(spark, folder)
    matched = crosswalk.newswire_crosswalk(titles, tables.feed(spark, folder), month_scoped=False)
    return matched.select("date", F.col("nw_source_url").alias("source_url"), "rp_story_id", "fuzzy_score")


@check(
    "fuzzy_match_tiled",
    f"select date::varchar as date, nw_source_url, rp_story_id, round(fuzzy_score, 6) as fuzzy_score from nw_cw",
)
def _(spark, folder):
    """Every block cut into many small tiles: the result must not depend on the tiling."""
    titles = tables.newswire_titles(spark, folder)
    matched = crosswalk.newswire_crosswalk(titles, tables.feed(spark, folder), tile_rows=5)
    return matched.select("date", "nw_source_url", "rp_story_id", "fuzzy_score")


@check(
    "fuzzy_match_by_language",
    """select block, id, other, round(fuzzy_score, 6) as fuzzy_score from (
         select l.block, l.id, r.other, SCORE as fuzzy_score,
                row_number() over (partition by l.id order by SCORE desc, r.other) as place
         from (select p.page_id as id, KEYL as k, regexp_extract(html, '<html lang="([a-z]+)"', 1) as block
               from pages_h1 join pages p using (page_id)) l
         join (select lang as block, doc_id * 1000000 + line as other, KEYR as k
               from (select *, line_text as title from lines)) r
           on l.block = r.block and (l.k = r.k or (length(l.k) > 0 and length(r.k) > 0
             and 108.5 * least(length(l.k), length(r.k)) >= 91.49 * greatest(length(l.k), length(r.k))))
       ) where place = 1 and fuzzy_score >= 91.5""".replace("SCORE", sql.score("l.k", "r.k"))
    .replace("KEYL", sql.sort_key("h1"))
    .replace("KEYR", sql.sort_key("title"))
)
def _(spark, folder):
    """The generic operator: blocks by language, a few large ones, and another threshold."""
    h1 = F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1)
    left = tables.table(spark, folder, "pages").select(
        F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("block"), F.col("page_id").alias("id"), h1.alias("title")
    )
    right = tables.lines(spark, folder).select(
        F.col("lang").alias("block"),
        (F.col("doc_id") * 1000000 + F.col("line")).alias("other"),
        F.col("line_text").alias("other_title"),
    )
    matched = fuzzy_best_match(
        left, right, block="block", left_text="title", right_text="other_title",
        right_order=["other"], min_score=91.5,
    )
    return matched.select("block", "id", "other", "fuzzy_score")


@check(
    "normalize_and_sort_titles",
    f"select page_id, {sql.normalize('h1')} as norm, {sql.sort_key('h1')} as sort_key from pages_h1",
)
def _(spark, folder):
    h1 = F.regexp_extract("html", r"(?s)<h1[^>]*>(.*?)</h1>", 1)
    norm = text.normalize_title(h1)
    return tables.table(spark, folder, "pages").select(
        "page_id", norm.alias("norm"), text.token_sort_key(norm).alias("sort_key")
    )


@check(
    "token_sort_ratio",
    f"""select turn_id, round({sql.score('a', 'b')}, 6) as score from (
          select conv_id * 1000 + turn as turn_id,
                 {sql.sort_key('role || c_mktsegment || c_name')} as a,
                 {sql.sort_key("role || ' ' || c_name || ' ' || c_mktsegment")} as b
          from conversations join customer on c_custkey = conv_id)""",
)
def _(spark, folder):
    turns = tables.table(spark, folder, "conversations")
    customers = tables.table(spark, folder, "customer")
    joined = turns.join(customers, F.col("c_custkey") == F.col("conv_id"))

    def key(*parts):
        return text.token_sort_key(text.normalize_title(F.concat(*parts)))

    a = key(F.col("role"), F.col("c_mktsegment"), F.col("c_name"))
    b = key(F.col("role"), F.lit(" "), F.col("c_name"), F.lit(" "), F.col("c_mktsegment"))
    return joined.select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("turn_id"),
        similarity.token_sort_ratio(a, b).alias("score"),
    )


@check("similar_turns")
def _(spark, folder):
    """Whole texts of consecutive turns, of any length; held against dynamic programming in the tests."""
    turns = tables.table(spark, folder, "conversations").select(
        "conv_id", "turn", text.token_sort_key(text.normalize_title(F.col("text"))).alias("a")
    )
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b"))
    return turns.join(after, ["conv_id", "turn"]).select(
        "conv_id", "turn", similarity.token_sort_ratio(F.col("a"), F.col("b")).alias("score")
    )


def unmatchable_titles(spark: SparkSession, folder: str) -> DataFrame:
    """All titles, each followed by as many letters again that no feed title has: no score passes 67."""
    strange = F.repeat(F.lit("ⵣ"), F.length("headline"))
    return tables.newswire_titles(spark, folder).withColumn("headline", F.concat_ws(" ", "headline", strange))


@check("no_links_still_combine", "select 0 as n_links, 10 as n_columns")
def _(spark, folder):
    """A crosswalk without any link is written, combined and counted with its declared columns."""
    none = crosswalk.newswire_crosswalk(unmatchable_titles(spark, folder), tables.feed(spark, folder))
    path = new_folder(spark, "no-links")
    writers.write_crosswalk(none, path)
    combined = writers.combine_crosswalk(spark, path)
    return combined.agg(F.count("*").cast("int").alias("n_links")).withColumn("n_columns", F.lit(len(combined.columns)))


@check("unify_crosswalks", "select * replace (round(fuzzy_score, 6) as fuzzy_score) from unified")
def _(spark, folder):
    parts = [("newswire", newswire), ("gdelt", web)]
    a, b = (enrichment.unify_crosswalk(build(spark, folder), kind) for kind, build in parts)
    return a.unionByName(b)


@check("best_title_per_story", "select * replace (round(fuzzy_score, 6) as fuzzy_score) from best_titles")
def _(spark, folder):
    parts = [("newswire", newswire), ("gdelt", web)]
    a, b = (enrichment.unify_crosswalk(build(spark, folder), kind) for kind, build in parts)
    return enrichment.dedup_best_per_story(a.unionByName(b))


def merged(spark: SparkSession, folder: str) -> DataFrame:
    return reports.merged_titles(
        tables.feed(spark, folder), newswire(spark, folder), web(spark, folder)
    )


@check(
    "enrich_feed",
    """select * replace (timestamp_utc::varchar as timestamp_utc, round(fuzzy_score, 6) as fuzzy_score) from merged""",
)
def _(spark, folder):
    return merged(spark, folder)


@check(
    "merged_summary",
    """select count(*) as n_rows, count(headline) as n_matched,
              round(avg((headline is not null)::int), 6) as share_matched,
              round(min(fuzzy_score), 6) as min_score, round(median(fuzzy_score), 6) as median_score,
              round(avg(fuzzy_score), 6) as mean_score, round(max(fuzzy_score), 6) as max_score
       from merged""",
)
def _(spark, folder):
    return enrichment.merged_summary(merged(spark, folder))


@check(
    "merged_by_source",
    "select headline_source, count(*) as n from merged where headline is not null group by 1",
)
def _(spark, folder):
    return enrichment.matched_by_source(merged(spark, folder))


_ELIGIBLE = "entity_type = 'COMP' and country_code = 'US' and relevance >= 90"


@check(
    "eligible_feed_rows",
    f"""select * replace (timestamp_utc::varchar as timestamp_utc) from feed
        where {_ELIGIBLE} and timestamp_utc >= timestamp '2024-01-07' and timestamp_utc <= timestamp '2024-03-10'""",
)
def _(spark, folder):
    return feed.eligible_feed_rows(tables.feed(spark, folder), "2024-01-07", "2024-03-10")


@check(
    "single_firm_only",
    f"""select f.* replace (timestamp_utc::varchar as timestamp_utc) from feed f
        join (select provider_id, provider_story_id from feed where {_ELIGIBLE}
              group by 1, 2 having count(distinct rp_entity_id) = 1) using (provider_id, provider_story_id)
        where {_ELIGIBLE} and timestamp_utc >= timestamp '2024-01-01' and timestamp_utc <= timestamp '2024-12-31'""",
)
def _(spark, folder):
    return feed.single_firm_only(tables.feed(spark, folder), "2024-01-01", "2024-12-31")


@check(
    "normalize_company",
    f"select permno, comnam, {sql.company('comnam')} as comnam_norm from companies",
)
def _(spark, folder):
    named = tables.constituents(spark, folder)
    return named.select("permno", "comnam", text.normalize_company(F.col("comnam")).alias("comnam_norm"))


@check("names_lookup", "select permno, comnam, ticker, comnam_norm from lookup")
def _(spark, folder):
    return companies.names_lookup(tables.constituents(spark, folder))


@check(
    "title_company_match",
    f"""select source_url, headline, matched_company, permno, ticker from (
          select t.*, n.comnam as matched_company, n.permno, n.ticker,
                 row_number() over (partition by t.page_id
                   order by instr(t.norm, n.comnam_norm), length(n.comnam_norm) desc) as place
          from (select *, {sql.company('headline')} as norm from newswire_titles) t
          join (select * from (select *, row_number() over (partition by comnam_norm order by permno, comnam, ticker) as first
                               from lookup) where first = 1) n
            on contains(t.norm, n.comnam_norm)
        ) where place = 1""",
)
def _(spark, folder):
    lookup = companies.names_lookup(tables.constituents(spark, folder))
    found = companies.title_company_match(tables.newswire_titles(spark, folder), lookup)
    return found.select("source_url", "headline", "matched_company", "permno", "ticker")


@check(
    "constituents_with_names",
    """select permno, mbrstartdt::varchar as mbrstartdt, mbrenddt::varchar as mbrenddt, comnam,
              namedt::varchar as namedt, nameenddt::varchar as nameenddt
       from spells left join name_periods using (permno)""",
)
def _(spark, folder):
    return companies.constituents_with_names(
        tables.spells(spark, folder), tables.name_periods(spark, folder)
    )


@check(
    "rows_not_in",
    """select c.doc_id, c.source, c.lang from documents c where not exists (
         select 1 from labels l join documents d using (doc_id)
         where d.source is not distinct from c.source and d.lang is not distinct from c.lang and l.quality = 1)""",
)
def _(spark, folder):
    docs = tables.table(spark, folder, "documents").select("doc_id", "source", "lang")
    good = tables.table(spark, folder, "labels").filter("quality = 1")
    return rows.rows_not_in(docs, docs.join(good, "doc_id").select("source", "lang"), ["doc_id"])


@check(
    "merge_stats",
    """with a as (select distinct o_custkey as k from orders), b as (select distinct c_custkey as k from customer),
            n as (select (select count(*) from (select k from a union select k from b)) as u,
                         (select count(*) from (select k from a intersect select k from b)) as i,
                         (select count(*) from a) as l, (select count(*) from b) as r)
       select u as "union", i as "intersection", u - i as "union-intersection",
              round(i / u, 6) as "intersection/union", l as "left", r as "right",
              l - i as "left-intersection", r - i as "right-intersection",
              round(i / l, 6) as "intersection/left", round(i / r, 6) as "intersection/right"
       from n""",
)
def _(spark, folder):
    orders = tables.table(spark, folder, "orders").select(F.col("o_custkey").alias("k"))
    customers = tables.table(spark, folder, "customer").select(F.col("c_custkey").alias("k"))
    return rows.merge_stats(orders, customers, ["k"])
