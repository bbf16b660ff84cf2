"""Streams against batch: earliest rows by stateful processing, day counts with late rows kept."""

from datetime import datetime, timedelta

import pytest

from conftest import rows
from titleweave.sources import web_extract
from titleweave.streaming import days, earliest
from titleweave.streaming import titles as streams

TITLES = "gkg_date timestamp, source_url string, source_name string, headline string"
EVENTS = "ts timestamp, kind string, id int"


def land(spark, data, schema, path):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(path))


@pytest.fixture
def state(spark):
    for name, value in earliest.STATE.items():
        spark.conf.set(name, value)


def test_earliest_row_wins_in_reversed_order(spark, tmp_path, state):
    start = datetime(2024, 1, 2, 3, 4, 5, 678901)
    data = [(start + timedelta(days=d, microseconds=d), f"u{d % 7}", None if d % 5 else "s", f"title {d % 4}") for d in range(100)]
    data += [(start, "a tie", "s", "title 0"), (None, "x", "y", "title 1"), (start, "x", "y", None)]
    by_month = [[r for r in data if (r[0] or start).month == m] for m in (1, 2, 3, 4)]
    for part in by_month:
        ordered = sorted(part, key=lambda r: (r[0] or start, r[1]), reverse=True)
        land(spark, ordered[: len(ordered) // 2], TITLES, tmp_path / "in")
        land(spark, ordered[len(ordered) // 2 :], TITLES, tmp_path / "in")
    stream = streams.stream_parquet(spark, str(tmp_path / "in"), TITLES, files_per_trigger=1)
    found = earliest.earliest_titles(stream, order=["source_url", "source_name"])
    streams.run_available(found, str(tmp_path / "out"), str(tmp_path / "progress"))
    closed = spark.read.schema(found.schema).parquet(str(tmp_path / "out"))
    batch = spark.read.schema(TITLES).parquet(str(tmp_path / "in")).where("gkg_date is not null and headline is not null")
    want = web_extract.dedup_earliest(batch).select(*closed.columns)
    assert rows(closed) == rows(want.where("gkg_date < '2024-03-01'")) and closed.count() == 8
    assert rows(earliest.with_open_months(closed, batch, web_extract.dedup_earliest)) == rows(want)


def test_a_replayed_or_broken_batch_counts_once(spark, tmp_path):
    path, day = str(tmp_path / "out"), lambda d, h=0: datetime(2024, 5, d, h)
    first = spark.createDataFrame([(day(3), "a", 1), (day(4, 9), "a", 2), (None, "b", 3)], EVENTS)
    second = spark.createDataFrame([(day(1), "a", 4), (day(2, 23), "b", 5), (day(3), "a", 6), (day(9), "a", 7)], EVENTS)
    write = lambda batch, n: days._write_batch(batch, n, path, "ts", ["kind"], "1 day")
    write(first, 0)
    write(first, 0)
    # Broken off before its ledger entry: folders of batch 1 that readers must not see yet.
    spark.createDataFrame([(day(1), "a", 99)], EVENTS).write.parquet(f"{path}/late/batch=1")
    assert [r.id for r in days.late_rows(spark, path).collect()] == [3]
    write(second, 1)
    write(second, 1)
    assert sorted((r.batch, r.id) for r in days.late_rows(spark, path).collect()) == [(0, 3), (1, 4), (1, 5)]
    got = [(str(r.date), r.kind, r.n, r.closed) for r in days.day_counts(spark, path, ["kind"]).collect()]
    assert sorted(got) == [("2024-05-03", "a", 2, True), ("2024-05-04", "a", 1, True), ("2024-05-09", "a", 1, False)]
    entries = {r.batch: (r.n_counted, r.n_late) for r in days.ledger(spark, path).collect()}
    assert entries == {0: (2, 1), 1: (2, 2)}


def test_an_empty_table_before_the_first_batch(spark, tmp_path):
    assert days.ledger(spark, str(tmp_path / "none")).count() == 0
