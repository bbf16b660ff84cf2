import random
import re

import numpy as np
import pytest

from conftest import rows
from test_similarity import lcs_by_table
from titleweave.operators import matching
from titleweave.operators.matching import fuzzy_best_match
from titleweave.plans import crosswalk, reports


def key(title):
    norm = re.sub(r"\s+", " ", re.sub(r"[^\w\s']", "", title.lower())).strip()
    return " ".join(sorted(norm.split()))


def score(a, b):
    total = len(a) + len(b)
    return float(np.float32(100 * (1 - (total - 2 * lcs_by_table(a, b)) / total) if total else 100))


def brute_force(left, right, min_score):
    """Best right row of each left row by scoring every pair of a block."""
    found = []
    for i, block, title in left:
        if title is None or block is None:
            continue
        ranked = sorted(
            (-score(key(title), key(t)), j) for j, b, t in right if b == block and t is not None
        )
        if ranked and -ranked[0][0] >= min_score:
            found.append((i, ranked[0][1], -ranked[0][0]))
    return sorted(found, key=repr)


def run(spark, left, right, min_score=80.0, **options):
    a = spark.createDataFrame(left, "i int, block string, title string")
    b = spark.createDataFrame(right, "j int, block string, other string")
    matched = fuzzy_best_match(
        a, b, block="block", left_text="title", right_text="other", right_order=["j"],
        min_score=min_score, **options,
    )
    return rows(matched, "i", "j", "fuzzy_score")


@pytest.fixture(scope="module")
def titles():
    """A third of all rows in one block, a third of it copies of one title."""
    rng = random.Random(3)
    vocabulary = ["alpha", "beta", "gamma", "delta", "omega", "corp", "wins", "award", "opens", "plant", "in", "q3"]
    sentences = [" ".join(rng.choices(vocabulary, k=rng.randint(2, 7))) for _ in range(40)]

    def damage(text):
        letters = list(text)
        for _ in range(rng.randint(0, 5)):
            letters[rng.randrange(len(letters))] = rng.choice("abcdefgh -!")
        return "".join(letters)

    def side(n):
        made = []
        for i in range(n):
            block = "hot" if i % 3 == 0 else f"b{rng.randrange(6)}"
            made.append((i, block, sentences[0] if i % 9 == 0 else damage(rng.choice(sentences))))
        return made

    left = [*side(150), (900, "hot", None), (901, None, "alpha beta"), (902, "b1", "!!!"), (903, "lone", "alpha")]
    right = [*side(120), (800, "hot", None), (801, "b1", "..."), (802, None, "alpha beta"), (803, "other", "alpha")]
    return left, right


@pytest.mark.parametrize(("min_score", "tile_rows"), [(80.0, 4096), (80.0, 3), (66.67, 7), (93.5, 1)])
def test_equals_scoring_all_pairs(spark, titles, min_score, tile_rows):
    left, right = titles
    got = run(spark, left, right, min_score, tile_rows=tile_rows)
    assert got == brute_force(left, right, min_score)


def test_ties_take_the_first_in_order_and_empty_keys_match(spark):
    left = [(1, "d", "new york mets"), (2, "d", "???")]
    right = [(9, "d", "mets york new"), (4, "d", "NEW, York: Mets"), (7, "d", "--")]
    assert run(spark, left, right) == [(1, 4, 100.0), (2, 7, 100.0)]


def test_every_left_copy_keeps_its_row(spark):
    left = [(i, "d", "acme opens plant") for i in range(50)]
    got = run(spark, left, [(1, "d", "acme opens plants"), (2, "d", "other")])
    assert [(i, j) for i, j, _ in got] == sorted(((i, 1) for i in range(50)), key=repr)


def feed(spark):
    data = [
        ("2024-01-31 08:00:00", "s1", "e1", "Acme opens new plant"),
        ("2024-01-31 09:00:00", "s2", "e2", "Beta wins award"),
        ("2024-02-01 09:00:00", "s3", "e3", "Gamma buys Delta"),
    ]
    columns = "ts string, rp_story_id string, rp_entity_id string, headline string"
    return spark.createDataFrame(data, columns).selectExpr(
        "cast(ts as timestamp) as timestamp_utc", "rp_story_id", "rp_entity_id",
        "concat('Name ', rp_entity_id) as entity_name", "headline", "'wire' as source_name",
    )


def test_month_scope_and_merge_invariants(spark):
    titles = spark.createDataFrame(
        [
            ("Acme opens a new plant", "u1", "2024-01-31", "x", 2024, 1),
            ("Acme opens new plant", "u2", "2024-01-31", "x", 2024, 2),  # filed under the next month
            ("   ", "u3", "2024-01-31", "x", 2024, 1),
            ("Gamma buys Delta", "u4", "2024-02-01", "x", 2024, 2),
        ],
        "headline string, source_url string, date string, source string, year int, month int",
    )
    scoped = crosswalk.newswire_crosswalk(titles, feed(spark))
    assert [r[0] for r in rows(scoped, "nw_source_url")] == ["u1", "u4"]
    whole = crosswalk.newswire_crosswalk(titles, feed(spark), month_scoped=False)
    assert [r[0] for r in rows(whole, "nw_source_url")] == ["u1", "u2", "u4"]

    merged = reports.merged_titles(feed(spark), whole, None)
    assert rows(merged, "rp_story_id", "headline_source_url", "fuzzy_score") == [
        ("s1", "u2", 100.0),  # the better of u1 and u2
        ("s2", None, None),
        ("s3", "u4", 100.0),
    ]
    assert merged.columns[-4:] == ["headline", "headline_source", "headline_source_url", "fuzzy_score"]


def test_no_cartesian_product_in_the_plan(spark, titles):
    left, right = titles
    a = spark.createDataFrame(left, "i int, block string, title string")
    b = spark.createDataFrame(right, "j int, block string, other string")
    matched = fuzzy_best_match(
        a, b, block="block", left_text="title", right_text="other", right_order=["j"]
    )
    plan = matched._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_tiles_of_far_lengths_or_letters_never_meet(spark):
    """Zone maps drop tiles before keys are copied, and no pair that reaches the score is lost."""
    rng = random.Random(8)
    letters = ["aeiou", "nrst", "bcdfg", "kqxz"]
    keys = ["".join(rng.choices(letters[i % 4], k=10 + 3 * (i % 12))) for i in range(480)]
    left = [(i, "one", k) for i, k in enumerate(keys[:240])]
    right = [(i, "one", k) for i, k in enumerate(keys[240:])]
    a = spark.createDataFrame(left, "i int, block string, title string")
    b = spark.createDataFrame(right, "j int, block string, other string")
    folded = matching.fold_keys(
        a, b, block="block", left_text="title", right_text="other", right_order=["j"], min_score=80.0
    )
    found = matching.pair_survey(folded, "block", 80.0, tile_rows=8).first()
    assert found.scored_pairs <= found.met_pairs < found.all_pairs / 3
    assert run(spark, left, right, tile_rows=8) == brute_force(left, right, 80.0)


def test_rows_of_equal_order_columns_keep_the_first_payload(spark):
    a = spark.createDataFrame([(1, "d", "alpha beta gamma"), (2, "d", "delta")], "i int, block string, title string")
    b = spark.createDataFrame(
        [(7, "d", "gamma beta alpha", "second"), (7, "d", "alpha beta gamma", "first"), (7, "d", "delta", "x"), (None, "d", "delta!", "y")],
        "j int, block string, other string, payload string",
    )
    matched = fuzzy_best_match(a, b, block="block", left_text="title", right_text="other", right_order=["j"])
    assert rows(matched, "i", "j", "other", "payload") == [
        (1, 7, "alpha beta gamma", "first"), (2, None, "delta!", "y"),
    ]
