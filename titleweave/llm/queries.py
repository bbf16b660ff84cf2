"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleweave.llm import (
    decontamination, fill_middle, fingerprints, html_text, license_scan, mixing, pitman_yor, quality_net, quality_rules, sharding, simhash, substring_dedup,
    token_alignment,
)
from titleweave.llm.common import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build):
    QUERIES[build.__name__] = build
    return build


def _license_sql() -> str:
    """Containment by counting, in every window, the template shingles that stand there."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    families = license_scan.families(license_scan.TEMPLATES)
    notices = ", ".join(
        f"({n}, {quoted(name)}, {family}, {quoted(notice)})"
        for n, ((name, notice), family) in enumerate(zip(license_scan.TEMPLATES, families))
    )

    def shingles(text: str) -> str:
        return f"""select *, list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) as all_of
            from (select *, string_split(trim(regexp_replace(lower(coalesce({text}, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' ') as w"""

    return f"""
    with notices(template, license, family, notice) as (values {notices}),
    known as (
      select template, license, family, list_distinct(all_of) as own,
             pow(2, ceil(log2(len(list_distinct(all_of))) - 1e-9))::bigint as size
      from ({shingles('notice')} from notices)) where len(all_of) > 0),
    met as (
      select doc_id, pos, shingle, k.* from (
        select doc_id, unnest(all_of) as shingle, unnest(range(0, len(all_of))) as pos
        from ({shingles('text')} from documents)) where len(w) >= 5) d
      join (select *, unnest(own) as shingle from known) k using (shingle)),
    spread as (select *, pos // size as place from met union all select *, pos // size - 1 from met where pos >= size),
    shares as (
      select doc_id, family, license, template, count(distinct shingle) / any_value(len(own)) as containment
      from spread group by doc_id, family, license, template, place),
    best as (
      select *, row_number() over (partition by doc_id, family, license order by containment desc, template) as n,
             max(containment) over (partition by doc_id, family) as nearest
      from shares where containment >= {license_scan.LEAST})
    select doc_id, license, containment, template from best where n = 1 and containment = nearest"""


ORACLES["op1_license_scan"] = _license_sql()

ORACLES["op3_substring_dedup"] = r"""
with texts as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
  from documents),
windows as (
  select doc_id, unnest(range(1, len(ws) - 48)) as i,
         unnest(list_transform(range(1, len(ws) - 48), lambda i: md5(array_to_string(ws[i:i + 49], ' ')))) as h
  from texts where len(ws) >= 50),
gone as (
  select distinct doc_id, unnest(range(i, i + 50)) as k
  from windows join (select h, min(doc_id) as first from windows group by h) using (h) where first < doc_id),
kept as (
  select w.doc_id, string_agg(word, ' ' order by k) as t
  from (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as k from texts) w
  anti join gone using (doc_id, k) group by w.doc_id)
select doc_id, len(ws) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from texts left join (select doc_id, count(*) as n from gone group by 1) using (doc_id) left join kept using (doc_id)
"""


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licenses whose notices stand in documents."""
    return license_scan.scan_licenses(_table(spark, folder, "documents"))


@query
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 16 shards of near-equal bytes."""
    docs = _table(spark, folder, "documents")
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return sharding.shard_by_bytes(docs.withColumn("text_crc32", crc)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document once passages of earlier documents are gone."""
    found = substring_dedup.remove_repeats(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold test items, with the items."""
    return decontamination.find_leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


@query
def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every document and whether the learned decision list keeps it."""
    docs = _table(spark, folder, "documents")
    table = stage(quality_rules.measured(docs).select("doc_id", "measures"), "measures")
    rules = quality_rules.learn_rules(quality_rules.labelled_rows(table, _table(spark, folder, "labels")))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return table.select(
        "doc_id", *[F.col(f"measures.{n}").alias(n) for n in names],
        quality_rules.base_failed().alias("base_failed"), quality_rules.kept(rules).alias("kept"),
    )


@query
def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_groups(_table(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = _table(spark, folder, "documents")
    return mixing.taken_per_row(mixing.mix_counts(docs)).select(
        F.col("id").alias("doc_id"), "size", "source", "source_size", "target", "taken"
    )


@query
def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    pages = html_text.extract_text(_table(spark, folder, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


@query
def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document."""
    found = quality_net.quality_scores(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    """Language-model score of every document."""
    return pitman_yor.score_texts(_table(spark, folder, "documents"), seated=True).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op11_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut in three and put in another order, by digest, and restored from it."""
    cut = fill_middle.fill_in_middle(_table(spark, folder, "documents").select("doc_id", "text"))
    back = fill_middle.restore(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )


ORACLES["op11_fill_in_middle"] = r"""
with texts as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines,
         sha256('7:' || doc_id::varchar) as h from documents),
drawn as (
  select *, len(lines) as n, [('0x' || h[8 * i + 1:8 * i + 8])::bigint for i in range(4)] as d from texts),
placed as (
  select *, least(d[1] % (n + 1), d[2] % (n + 1)) as low, greatest(d[1] % (n + 1), d[2] % (n + 1)) as high,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or d[3] % 100 >= 100 then 'plain'
              when d[4] % 100 < 50 then 'spm' else 'psm' end as form from drawn),
parts as (
  select *, coalesce(array_to_string(lines[1:low], ''), '') as p, coalesce(array_to_string(lines[low + 1:high], ''), '') as m,
         coalesce(array_to_string(lines[high + 1:], ''), '') as s from placed)
select doc_id, n::bigint as n, form, case when form <> 'plain' then len(p) end as prefix_chars,
       case when form <> 'plain' then len(m) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from parts
"""


@query
def op12_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of an edited version, and how alike they and the next one's are."""
    rows = fingerprints.with_next(_table(spark, folder, "documents"))
    n = F.char_length("text")
    cut = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    rows = rows.withColumn("n_chars", n.cast("bigint")).withColumn("edited", edited)
    rows = rows.withColumn("edited_digests", fingerprints.digests(F.col("edited")))
    rows = rows.withColumn("edited_sketch", fingerprints.sketch(F.col("edited_digests")))
    pair = ("left", "digests"), ("right", "{}_digests"), ("left_sketch", "sketch"), ("right_sketch", "{}_sketch")
    others = F.array(*[F.struct(*[F.col(c.format(o)).alias(a) for a, c in pair]) for o in ("edited", "next")])

    def near(p: Column) -> Column:
        apart = fingerprints.difference(p["left"], p["right"], p["left_sketch"], p["right_sketch"])
        return fingerprints.likeness(p["left"], p["right"], apart)

    rows = rows.withColumn("near", F.transform(others, near))
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("text"), F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited"), F.col("edited_sketch")).alias("edited_fingerprint"),
        F.get("near", F.lit(0)).alias("near_edited"), F.get("near", F.lit(1)).alias("near_next"),
    )


ORACLES["op12_fingerprints"] = r"""
with texts as (
  select doc_id, coalesce(text, '') as t, len(coalesce(text, '')) as n,
         lead(coalesce(text, '')) over (order by doc_id desc) as after,
         first_value(coalesce(text, '')) over (order by doc_id desc) as first from documents),
versions as (
  select doc_id, n, t, coalesce(after, first) as other, t[:n - n // 2] || left(coalesce(after, first), n // 2) as edited from texts),
sets as (
  select *, {keys_t} as kt, {keys_e} as ke, {keys_o} as ko from versions),
cells as (
  select doc_id, {cells_t} as ct, {cells_e} as ce from sets)
select doc_id, n::bigint as n_chars, sha256(edited) as edited_sha256,
       left(md5(t), 16) || '-' || ct as fingerprint, left(md5(edited), 16) || '-' || ce as edited_fingerprint,
       {near_e} as near_edited, {near_o} as near_next
from sets join cells using (doc_id)
"""


def _fingerprint_sql(sql: str) -> str:
    """Sets of digests and their exact shares; cells as counts and exclusive ors of listed digests."""
    keys = (
        r"list_distinct(list_transform(list_filter(list_transform(regexp_extract_all({}, '{}'), "
        r"lambda p: trim(p, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), lambda p: p <> ''), "
        r"lambda p: ('0x' || left(md5(p), 15))::bigint))"
    )
    cell = (
        "list_transform(range(0, 12), lambda c: list_filter({}, lambda k: ((k >> (20 * (c // 4))) & 3) = c % 4))"
    )
    shown = (
        "array_to_string(list_transform({}, lambda own: printf('%x:%x', len(own), "
        "list_reduce(list_prepend(0::bigint, own), lambda x, y: xor(x, y)))), ',')"
    )
    near = (
        "case when len(kt) + len({0}) = 0 then 1.0::double else len(list_intersect(kt, {0}))::double "
        "/ (len(kt) + len({0}) - len(list_intersect(kt, {0}))) end"
    )
    parts = {f"keys_{k}": keys.format(c, fingerprints.PARAGRAPH) for k, c in (("t", "t"), ("e", "edited"), ("o", "other"))}
    parts |= {f"cells_{k}": shown.format(cell.format("k" + k)) for k in "te"}
    parts |= {f"near_{k}": near.format("k" + k) for k in "eo"}
    return sql.format(**parts)


ORACLES["op12_fingerprints"] = _fingerprint_sql(ORACLES["op12_fingerprints"])


@query
def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of two tokenizers in every document, by corpus-wide pair counts."""
    found = token_alignment.align(_table(spark, folder, "documents").select("doc_id", "text"), digest=True)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )
