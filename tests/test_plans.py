"""What the plans must look like, so that they hold at scale."""

from pyspark.sql import functions as F

from titleweave.operators import companies, coverage, enrichment, feed
from titleweave.operators.matching import fuzzy_best_match
from titleweave.operators.rows import first_per_key
from titleweave.sources import lakes, web_extract, writers


def plan_of(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_top_row_is_trimmed_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id")
    plan = plan_of(first_per_key(df, ["k"], [F.col("id").desc()]))
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")
    assert "Partial" in plan.split("Exchange")[1]


def test_month_filter_prunes_partitions_and_columns(spark, tmp_path):
    path = str(tmp_path / "titles")
    titles = spark.createDataFrame(
        [("a", "u", "2024-01-01", "s"), ("b", "v", "2024-02-01", "s")],
        "headline string, source_url string, date string, source string",
    )
    writers.write_daily(titles, path)
    plan = plan_of(lakes.filter_to_month(lakes.read_titles(spark, path), "2024-02").select("headline"))
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "ReadSchema: struct<headline:string>" in plan


def test_feed_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "feed")
    spark.createDataFrame(
        [("COMP", "US", 95, "p", "1", "e", "s", "h")],
        "entity_type string, country_code string, relevance int, provider_id string, provider_story_id string, "
        "rp_entity_id string, rp_story_id string, headline string",
    ).withColumn("timestamp_utc", F.lit("2024-01-01").cast("timestamp")).write.parquet(path)
    rows = feed.eligible_feed_rows(lakes.read_feed(spark, path), "2024-01-01", "2024-02-01").select("rp_story_id")
    plan = plan_of(rows)
    for pushed in ("EqualTo(entity_type,COMP)", "GreaterThanOrEqual(relevance,90)", "LessThanOrEqual(timestamp_utc"):
        assert pushed in plan
    assert "headline" not in plan.split("ReadSchema")[1]


def test_extract_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame(
        [(20240101000000, "u", "wsj.com", "x", None, "o")],
        "DATE long, DocumentIdentifier string, SourceCommonName string, Extras string, TranslationInfo string, orgs string",
    ).withColumn("partition_time", F.to_date(F.lit("2024-01-01"))).write.partitionBy("partition_time").parquet(path)
    plan = plan_of(web_extract.gkg_extract(spark.read.parquet(path), "2024-01-01", "2024-02-01"))
    assert "StringContains(Extras,<PAGE_TITLE>)" in plan and "IsNull(TranslationInfo)" in plan
    assert "In(SourceCommonName" in plan and "PartitionFilters: [isnotnull(partition_time" in plan
    assert "orgs" not in plan


def test_no_nested_loops_where_rows_meet_rows(spark):
    titles = spark.createDataFrame([("acme opens",)], "headline string")
    lookup = spark.createDataFrame([(1, "ACME", "A", "acmes")], "permno int, comnam string, ticker string, comnam_norm string")
    plan = plan_of(companies.title_company_match(titles, lookup))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    unified = spark.createDataFrame(
        [("h", "newswire", "u", "r", 90.0, "s")],
        "headline string, headline_source string, headline_source_url string, rp_headline string, fuzzy_score double, rp_story_id string",
    )
    rp = spark.createDataFrame([("s", "r")], "rp_story_id string, headline string")
    plan = plan_of(enrichment.enrich_feed(rp, unified))
    assert "NestedLoop" not in plan and "LeftOuter" in plan


def test_daily_rates_scan_each_crosswalk_once(spark):
    rows = spark.createDataFrame([("2024-01-01", "s")], "date string, rp_story_id string")
    daily = coverage.daily_match_rate(rows, {"nw": rows, "web": rows})
    assert plan_of(daily).count("Scan ExistingRDD") <= 6


def test_a_hot_title_is_split_by_adaptive_execution(spark):
    """A third of the titles are copies of one: the join that hands matches back to the rows
    is divided between tasks instead of running the hot title in one."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    title = F.when(F.col("id") % 3 == 0, F.lit("acme opens plant")).otherwise(
        F.concat(F.lit("title number "), F.xxhash64("id").cast("string"))
    )
    left = spark.range(0, 12000, 1, 8).select("id", F.lit("d").alias("block"), title.alias("title"))
    # Titles found on both sides settle without tiles, which keeps this test small.
    right = left.select((F.col("id") + 0).alias("j"), "block", F.col("title").alias("other"))
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        matched = fuzzy_best_match(
            left, right, block="block", left_text="title", right_text="other", right_order=["j"]
        )
        assert len(matched.collect()) == 12000
        assert "skew=true" in matched._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
