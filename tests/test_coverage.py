import datetime
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from titleweave.operators import companies, coverage, feed, ledger
from titleweave.streaming import titles as streams


def day(n, month=1):
    return datetime.date(2024, month, n)


def test_daily_rates_count_rows_below_and_stories_above(spark):
    rp = spark.createDataFrame([(day(1), "s1"), (day(1), "s1"), (day(1), "s2"), (day(2), "s3")], "date date, rp_story_id string")
    nw = spark.createDataFrame([(day(1), "s1"), (day(1), "s1")], "date date, rp_story_id string")
    web = spark.createDataFrame([(day(1), "s2"), (day(9), "s9")], "date date, rp_story_id string")
    both = coverage.combined_stories(nw, web)
    daily = coverage.daily_match_rate(rp, {"nw": nw, "web": web, "combined": both})
    assert rows(daily, "date", "rp_total", "nw_matched", "web_matched", "combined_matched") == [
        (day(1), 3, 1, 1, 2), (day(2), 1, 0, 0, 0),
    ]
    mean = coverage.average_match_rate(daily).first()
    assert round(mean.uplift, 6) == round((200 / 3 - 100 / 3) / 2, 6)


def test_windows_and_gaps(spark):
    a = spark.createDataFrame([(day(1),), (day(20),)], "date date")
    b = spark.createDataFrame([(day(5),), (day(3, 4),)], "date date")
    assert tuple(coverage.overlap_window(a, b).first()) == (day(5), day(20))
    assert rows(coverage.within(a, coverage.overlap_window(a, b))) == [(day(20),)]
    assert rows(coverage.clip_to_range_of(b, a)) == [(day(5),)]
    gaps = coverage.monthly_gaps(a, b)
    assert rows(gaps) == [
        (day(1, 1), 2, 2, 1, 1), (day(1, 2), 0, 0, 0, 0), (day(1, 3), 0, 0, 0, 0), (day(1, 4), 0, 0, 1, 1),
    ]
    assert coverage.sparse_months(gaps, 1).count() == 3


def test_histogram_of_equal_and_of_spread_values(spark):
    same = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r.n for r in coverage.histogram(same, "x", 4).orderBy("bin").collect()] == [2, 0, 0, 0]
    spread = spark.createDataFrame([(0.0,), (2.5,), (9.9,), (10.0,), (None,)], "x double")
    assert [r.n for r in coverage.histogram(spread, "x", 4).orderBy("bin").collect()] == [1, 1, 0, 2]


def test_funnel_is_cumulative(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, "b")], "x int, y string")
    got = coverage.filter_funnel(df, {"small": F.col("x") < 4, "a": F.col("y") == "a"})
    assert rows(got) == [(0, "all rows", 4, None), (1, "small", 3, 75.0), (2, "a", 2, pytest.approx(200 / 3))]


def test_single_firm_stories(spark):
    data = [
        ("p", "1", "e1", "COMP", "US", 95, "2024-01-01 10:00:00"),
        ("p", "1", "e1", "COMP", "US", 90, "2024-01-02 00:00:00"),
        ("p", "1", "e2", "ORGA", "US", 95, "2024-01-01 10:00:00"),
        ("p", "2", "e1", "COMP", "US", 95, "2024-01-01 10:00:00"),
        ("p", "2", "e2", "COMP", "US", 95, "2025-01-01 10:00:00"),
        ("p", "3", "e3", "COMP", "US", 95, "2024-01-02 10:00:00"),
        (None, "4", "e4", "COMP", "US", 95, "2024-01-01 10:00:00"),
    ]
    df = spark.createDataFrame(
        data, "provider_id string, provider_story_id string, rp_entity_id string, entity_type string, "
        "country_code string, relevance int, ts string",
    ).withColumn("timestamp_utc", F.col("ts").cast("timestamp"))
    # Story 2 names two firms (one outside the dates), story 3 lies after the end date's midnight.
    kept = feed.single_firm_only(df, "2024-01-01", "2024-01-02")
    assert rows(kept, "provider_story_id", "relevance") == [("1", 90), ("1", 95)]


def test_company_names_in_titles(spark):
    constituents = spark.createDataFrame(
        [(1, "ACME CORP", "A"), (2, "ACME WIDGETS INC", "AW"), (3, "GAP INC", "G"), (4, "NORTHERN", "N"),
         (5, "Acme Widgets", "AX"), (6, None, "Z"), (7, "FINCH ROCK", "F")],
        "permno int, comnam string, ticker string",
    )
    lookup = companies.names_lookup(constituents, 4)
    assert rows(lookup, "permno", "comnam_norm") == [
        (1, "acme"), (2, "acme widgets"), (4, "northern"), (5, "acme widgets"), (7, "finch rock"),
    ]
    titles = spark.createDataFrame(
        [(1, "Northern wins, says Acme Widgets"), (2, "acme widgets opens"), (3, "Placmex buys"),
         (4, "nothing"), (5, "Gap sale"), (6, None), (7, "acme widgets opens")],
        "i int, headline string",
    )
    got = rows(companies.title_company_match(titles, lookup, min_length=4), "i", "matched_company", "permno")
    # Leftmost wins, then longest; equal names go to the lowest permno; no word boundaries.
    assert got == [
        (1, "NORTHERN", 4), (2, "ACME WIDGETS INC", 2), (3, "ACME CORP", 1), (7, "ACME WIDGETS INC", 2),
    ]


def test_names_of_common_beginnings_in_parts_and_slices(spark):
    rng = random.Random(6)
    words = ["the twenty first ", "the twenty first century ", "north ", "😀x", "ab", "a", "the "]
    text = lambda n: "".join(rng.choice(words) for _ in range(n)).strip()
    names = sorted({text(rng.randint(1, 4)) for _ in range(80)})
    titles = [(i, "say " + text(rng.randint(0, 6))) for i in range(150)] + [(900, None), (901, "")]
    known = [(k, n, n, "T") for k, n in enumerate(names)]
    lookup = spark.createDataFrame(known, "permno int, comnam string, comnam_norm string, ticker string")
    table = spark.createDataFrame(titles, "i int, headline string")
    want = []
    for i, title in titles:
        norm = " ".join((title or "").split())
        hits = [(norm.find(n), -len(n), n) for n in names if len(n) >= 2 and n in norm]
        if hits:
            want.append((i, min(hits)[2]))
    for options in ({}, {"part_bytes": 200, "slice_bytes": 500}):
        found = companies.title_company_match(table, lookup, min_length=2, **options)
        assert rows(found, "i", "matched_company") == sorted(want, key=repr)
    assert companies.title_company_match(table, lookup.limit(0), min_length=2).count() == 0


def test_months_before_first_coverage_are_skipped(spark):
    months = spark.createDataFrame(
        [("newswireca", "2010-12"), ("newswireca", "2011-01"), ("globenewswire", "2023-03"), ("prnewswire", "2009-01")],
        "source string, month string",
    )
    assert rows(ledger.after_first_coverage(months)) == [("newswireca", "2011-01"), ("prnewswire", "2009-01")]


def test_month_status_with_marker_and_running_month(spark):
    done = spark.createDataFrame([("s", day(1, 3)), ("s", day(2, 3)), ("s", day(1, 2))], "source string, day date")
    marked = spark.createDataFrame([("s", day(1, 2)), ("t", day(1, 1))], "source string, month date")
    status = ledger.month_status(done, "2024-03-02", marked)
    assert rows(status, "source", "month", "done_days", "expected_days", "complete") == [
        ("s", day(1, 2), 1, 29, True), ("s", day(1, 3), 2, 2, True), ("t", day(1, 1), 0, 31, True),
    ]
    assert rows(ledger.month_status(done, "2024-03-03"), "complete") == [(False,), (False,)]


def test_late_rows_and_first_incomplete_day(spark):
    book = spark.createDataFrame([("s", day(1)), ("s", day(3))], "source string, day date")
    days = ledger.calendar(spark, "2024-01-01", "2024-01-05").withColumn("source", F.lit("s"))
    assert rows(ledger.first_incomplete_day(days, book), "day") == [(day(2),)]
    assert rows(ledger.flag_late_rows(days, book).filter("late"), "day") == [(day(1),), (day(3),)]


def test_stream_resumes_where_it_stopped(spark, tmp_path):
    landing, lake, progress = (str(tmp_path / name) for name in ("landing", "lake", "progress"))
    schema = "headline string, source_url string, source string, day date"

    def land(*data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(landing)

    def run():
        stream = streams.stream_parquet(spark, landing, schema)
        streams.ingest_available(stream, lake, progress, ["source", "day"]).awaitTermination()
        return rows(spark.read.parquet(lake), "source_url")

    land(("a", "u1", "s", day(1)), ("  ", "u2", "s", day(1)))
    assert run() == [("u1",)]
    assert run() == [("u1",)]
    land(("b", "u3", "s", day(1)), ("c", "u4", "t", day(2)))
    assert run() == [("u1",), ("u3",), ("u4",)]
