"""The logical inputs of ``checks.tables`` as SQL, for the side-by-side comparison.

``with_tables(body)`` prefixes a query with the common table expressions it mentions.
"""

from __future__ import annotations

import re


def normalize(text: str) -> str:
    bare = rf"regexp_replace(lower({text}), '[^\p{{L}}\p{{N}}_\s\p{{Z}}'']', '', 'g')"
    return rf"trim(regexp_replace({bare}, '[\s\p{{Z}}]+', ' ', 'g'))"


def sort_key(text: str) -> str:
    return f"array_to_string(list_sort(string_split({normalize(text)}, ' ')), ' ')"


def company(text: str) -> str:
    # The legal suffixes, as in the engine.
    words = (
        "inc|corp|corporation|co|company|ltd|limited|llc|lp|plc|group|holdings|holding|enterprises"
        "|enterprise|intl|international|technologies|technology|systems|industries|services"
        "|bancorp|bancshares|financial"
    )
    spaced = f"regexp_replace(lower({text}), '[&.'',]', ' ', 'g')"
    # RE2 word boundaries are ASCII only, so the words are taken out of the list instead.
    kept = rf"regexp_replace({spaced}, '(^|[^\p{{L}}\p{{N}}_])({words})(?:$|([^\p{{L}}\p{{N}}_]))', '\1 \3', 'g')"
    again = kept.replace(spaced, kept)
    return rf"trim(regexp_replace({again}, '[\s\p{{Z}}]+', ' ', 'g'))"


def title_case(text: str) -> str:
    run = r"[\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+"
    return (
        f"array_to_string(list_transform(regexp_extract_all({text}, '{run}'), "
        "lambda w: case when w[1] = 'ß' then 'Ss' else upper(w[1]) end || lower(w[2:])), '')"
    )


def _lcs(a: str, b: str) -> str:
    """Bit-parallel longest common subsequence; ``a`` may have up to 126 characters."""
    full = f"((1::hugeint << length({a})) - 1)"
    mask = (
        f"list_sum(list_transform(range(1, length({a}) + 1), lambda i: case when "
        f"substring({a}, i, 1) = substring({b}, j, 1) then 1::hugeint << (i - 1) else 0::hugeint end))"
    )
    masks = f"list_transform(range(1, length({b}) + 1), lambda j: {mask}::hugeint)"
    step = f"lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}"
    return f"bit_count({full} & ~list_reduce(list_prepend({full}, {masks}), {step}))"


def score(a: str, b: str) -> str:
    total = f"(length({a}) + length({b}))"
    ratio = f"100.0::double * (1 - ({total} - 2 * {_lcs(a, b)})::double / {total})"
    return f"(case when {a} = {b} then 100.0 else {ratio} end)::float::double"


def best_match(left: str, left_columns: str, right: str = "feed_titles") -> str:
    """Best same-day row of ``right`` for each row of ``left`` (columns id, date, title)."""
    return f"""
    select {left_columns}, rp_story_id, rp_entity_id, rp_entity_name, rp_headline, rp_source_name, fuzzy_score
    from (
      select *, row_number() over (partition by id order by fuzzy_score desc, rp_story_id, rp_entity_id) as place
      from (
        select l.*, r.* exclude (date, k), {score('l.k', 'r.k')} as fuzzy_score
        from (select *, {sort_key('title')} as k from {left}) l
        join (select *, {sort_key('rp_headline')} as k from {right}) r on l.date = r.date
         and (l.k = r.k or (length(l.k) > 0 and length(r.k) > 0
              and 3 * least(length(l.k), length(r.k)) >= 2 * greatest(length(l.k), length(r.k))))
      )
    ) where place = 1 and fuzzy_score >= 80"""


def _day(key: str) -> str:
    return f"(date '2024-01-01' + (({key} % 30) * 3)::int)"


_DAY = _day("page_id")
_MOMENT = f"({_DAY}::timestamp + to_hours((page_id % 24)::int))"
_HOST = "regexp_extract(url, '^https?://([^/?#]+)', 1)"
_H1 = "regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"
_TITLE = "regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)"
_KEPT = rf"trim(regexp_replace({_H1}, '[^\p{{L}}\p{{N}}& ]', '', 'g'))"
_SLUG = f"replace(replace({_KEPT}, '&', '%26'), ' ', '-')"
_BASE = (
    f"'https://www.example.com/news/home/' || strftime({_DAY}, '%Y%m%d') || lpad(page_id::varchar, 6, '0') || '/en'"
)
# Entities that occur in the titles; the ampersand itself comes last.
_UNESCAPED = "regexp_replace(replace(t, '&quot;', '\"'), '&amp;?', '&', 'g')"

TABLES: dict[str, str] = {
    "pages_h1": f"select page_id, url, {_H1} as h1, {_DAY} as date, {_SLUG} as slug from pages",
    "newswire_titles": f"""
        select page_id,
               case page_id % 3 when 0 then h1 when 1 then h1 || ' Update'
                    else regexp_replace(h1, '^[^ ]+ ', '') end as headline,
               url as source_url, strftime(date, '%Y-%m-%d') as date,
               string_split({_HOST}, '.')[-1] as source,
               year(filed) as year, month(filed) as month, day(filed) as day
        from (select *, case when page_id % 17 = 0 then (date + interval 1 month)::date else date end as filed
              from pages_h1)""",
    "lines": """
        select * from (
          select *, unnest(string_split(text, chr(10))) as line_text,
                 unnest(range(1, len(string_split(text, chr(10))) + 1)) as line
          from documents) where line_text <> ''""",
    "feed": f"""
        select ({_day('doc_id')}::timestamp + to_hours((doc_id % 24)::int)) as timestamp_utc,
               lpad(doc_id::varchar, 12, '0') || '-' || lpad(line::varchar, 6, '0') as rp_story_id,
               'E' || ((doc_id // 3) % 50) as rp_entity_id,
               case when source in ('src0', 'src1') then 'ORGA' else 'COMP' end as entity_type,
               'Entity E' || ((doc_id // 3) % 50) as entity_name,
               case when lang = 'en' then 'US' else 'XX' end as country_code,
               70 + length(source) * 4 + doc_id % 9 as relevance,
               source as source_name, 'P' as provider_id, (doc_id // 2)::varchar as provider_story_id,
               line_text as headline
        from lines""",
    "feed_titles": r"""
        select timestamp_utc::date as date, rp_story_id, rp_entity_id, entity_name as rp_entity_name,
               headline as rp_headline, source_name as rp_source_name
        from feed where regexp_matches(headline, '[^\s\p{Z}]')""",
    "web_extract": f"""
        select strftime({_MOMENT}, '%Y%m%d%H%M%S')::bigint as gkg_number, url as source_url,
               regexp_extract({_HOST}, '([^.]+\\.[^.]+)$', 1) as source_name,
               case when url like '%utm_source%' then null else {_TITLE} end as t,
               html like '%lang="en"%' as english, url not like '%#top%' as has_orgs,
               {_MOMENT} as gkg_date, {_DAY} as day
        from (select * from pages union all select * from pages where url like 'http:%')""".replace("\\\\", "\\"),
    "web_selected": """
        select distinct gkg_date, source_url, source_name, t from web_extract
        where day >= date '2024-01-01' and day < date '2024-04-01' and t is not null and english
          and source_name in ('example.com', 'example.org')""",
    "web_titles": rf"""
        select gkg_date, source_url, source_name, headline, year(gkg_date) as year, month(gkg_date) as month
        from (select *, row_number() over (partition by date_trunc('month', gkg_date), headline
                                           order by gkg_date, source_url, source_name) as place
              from (select *, {_UNESCAPED} as headline from web_selected)
              where regexp_matches(headline, '[^\s\p{{Z}}]'))
        where place = 1""",
    "nw_left": r"""
        select page_id as id, date::date as date, headline as title, source_url as nw_source_url,
               headline as nw_headline, source as nw_source
        from newswire_titles where regexp_matches(headline, '[^\s\p{Z}]')
          and year(date::date) = year and month(date::date) = month""",
    "web_left": """
        select row_number() over (order by gkg_date, source_url, headline) as id, gkg_date::date as date,
               headline as title, source_url as gdelt_source_url, headline as gdelt_headline,
               source_name as gdelt_source_name
        from web_titles""",
    "nw_cw": best_match("nw_left", "date, nw_source_url, nw_headline, nw_source"),
    "gd_cw": best_match("web_left", "date, gdelt_source_url, gdelt_headline, gdelt_source_name"),
    "unified": """
        select nw_headline as headline, 'newswire' as headline_source, nw_source_url as headline_source_url,
               rp_headline, fuzzy_score, rp_story_id from nw_cw
        union all
        select gdelt_headline, 'gdelt', gdelt_source_url, rp_headline, fuzzy_score, rp_story_id from gd_cw""",
    "best_titles": """
        select * exclude (place) from (
          select *, row_number() over (partition by rp_story_id
                   order by fuzzy_score desc, headline_source, headline_source_url, headline) as place
          from unified) where place = 1""",
    "merged": """
        select f.* exclude (headline), f.headline as rp_headline, b.headline, b.headline_source,
               b.headline_source_url, b.fuzzy_score
        from feed f left join best_titles b using (rp_story_id)""",
    "overlap": """
        select greatest(a.lo, b.lo) as date_start, least(a.hi, b.hi) as date_end
        from (select min(date) as lo, max(date) as hi from nw_cw) a,
             (select min(date) as lo, max(date) as hi from gd_cw) b""",
    "nw_in": "select c.* from nw_cw c, overlap o where c.date between o.date_start and o.date_end",
    "gd_in": "select c.* from gd_cw c, overlap o where c.date between o.date_start and o.date_end",
    "titles_in": """
        select t.* replace (t.date::date as date) from newswire_titles t, overlap o
        where t.date::date between o.date_start and o.date_end""",
    "feed_in": """
        select f.*, f.timestamp_utc::date as date from feed f, overlap o
        where f.timestamp_utc::date between o.date_start and o.date_end""",
    "cdx_rows": f"""
        select page_id, strftime({_MOMENT}, '%Y%m%d%H%M%S') as timestamp, {_DAY} as day, {_BASE} as base,
               {_SLUG} as slug, page_id % 5 <> 0 as slug_ok
        from pages""",
    "articles": f"""
        select case when use_slug then base || '/' || slug else base end as source_url,
               timestamp as wayback_timestamp, strftime(day, '%Y-%m-%d') as date,
               case when use_slug then {title_case("trim(replace(replace(slug, '%26', '&'), '-', ' '))")} end
                 as headline_from_slug
        from (select *, slug_ok and slug <> '' and not regexp_full_match(lower(slug), '[a-z]{{2}}(-[a-z]{{2}})?')
                     as use_slug from cdx_rows)""",
    "companies": """
        select doc_id as permno, line_text || ' Inc' as comnam, upper(source) as ticker from lines""",
    "lookup": f"""
        select * from (select distinct permno, comnam, ticker, {company('comnam')} as comnam_norm from companies)
        where length(comnam_norm) >= 5""",
    "spells": """
        select o_custkey as permno, min(o_orderdate)::date as mbrstartdt, max(o_orderdate)::date as mbrenddt
        from orders group by 1""",
    "name_periods": """
        select o_custkey as permno, o_orderpriority as comnam, min(o_orderdate)::date as namedt,
               max(o_orderdate)::date as nameenddt
        from orders group by 1, 2""",
    "event_days": "select event_type as source, ts::date as day, value, event_id from events",
    "event_ledger": """
        select source, day, count(*) as row_count, case when day < date '2024-01-15' then 1 else 2 end as schema_version
        from event_days where isodow(day) < 6 group by source, day""",
    "month_map": """
        select month, case when top % 2 = 1 then 'x' else '' end || stamp as snapshot_ts
        from (select strftime(o_orderdate, '%Y-%m') as month, max(o_orderkey) as top,
                     strftime(max(o_orderdate), '%Y%m%d%H%M%S') as stamp from orders group by 1)""",
}


def with_tables(body: str) -> str:
    """``body`` with the tables it needs, directly or through others, as CTEs."""
    needed: set[str] = set()
    texts = [body]
    while texts:
        text = texts.pop()
        for name in TABLES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                texts.append(TABLES[name])
    ctes = ", ".join(f"{name} as materialized ({TABLES[name]})" for name in TABLES if name in needed)
    if not ctes:
        return body
    own = body.lstrip().removeprefix("with ")
    return f"with {ctes}, {own}" if own != body.lstrip() else f"with {ctes} {body}"
