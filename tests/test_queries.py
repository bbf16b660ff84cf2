"""Every registered query against its SQL counterpart on the smallest tables."""

import math
import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as entry_points  # noqa: E402
from checks.registry import QUERIES  # noqa: E402
from titleweave.plans import crosswalk  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Similarity of texts of any length: whole-number arithmetic beyond SQL's, tested below.
NO_SQL = {"similar_turns"}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables not present")


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    if isinstance(value, int):
        return float(value)
    return value if value is None or isinstance(value, str) else str(value)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(QUERIES) - set(entry_points.oracle_sql()) == NO_SQL


@pytest.mark.parametrize("name", sorted(set(QUERIES) - NO_SQL))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, FOLDER)
    found = duck.execute(entry_points.oracle_sql()[name])
    names = sorted(c[0] for c in found.description)
    assert sorted(df.columns) == names
    place = [[c[0] for c in found.description].index(n) for n in names]
    want = sorted((tuple(plain(r[i]) for i in place) for r in found.fetchall()), key=repr)
    got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)
    assert got == want


def test_entry(spark):
    assert "fuzzy_score" in entry_points.entry(spark).columns


def test_similar_turns_by_dynamic_programming(spark):
    from titleweave.functions import text

    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    keyed = turns.select("conv_id", "turn", text.token_sort_key(text.normalize_title(F.col("text"))).alias("k"))
    keys = {(r.conv_id, r.turn): r.k for r in keyed.collect()}
    got = {(r.conv_id, r.turn): r.score for r in QUERIES["similar_turns"](spark, FOLDER).collect()}
    assert set(got) == {k for k in keys if (k[0], k[1] + 1) in keys} and got
    for (conversation, turn), score in got.items():
        a, b = keys[conversation, turn], keys[conversation, turn + 1]
        row = [0] * (len(b) + 1)
        for x in a:
            before = row[:]
            for j, y in enumerate(b, 1):
                row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
        total = len(a) + len(b)
        assert score == pytest.approx(200 * row[-1] / total if total else 100, abs=1e-4)


def test_no_links_are_found_among_rows_that_are_compared(spark, monkeypatch):
    """The query hands the matcher rows of both sides that meet; a lower threshold would link them."""
    met = []

    def watched(titles, feed, **options):
        met.append((titles.count(), feed.count(), build(titles, feed, min_score=20.0).count()))
        return build(titles, feed, **options)

    build = crosswalk.newswire_crosswalk
    monkeypatch.setattr(crosswalk, "newswire_crosswalk", watched)
    assert [tuple(r) for r in QUERIES["no_links_still_combine"](spark, FOLDER).collect()] == [(0, 10)]
    assert len(met) == 1 and all(n > 0 for n in met[0])
