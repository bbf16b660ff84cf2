import random

import numpy as np
import pytest

from test_matching import run
from test_similarity import lcs_by_table
from titleweave.functions import nearest
from titleweave.operators import matching


def side(keys, tile_rows):
    keys = sorted(set(keys), key=lambda k: (len(k), k))
    return nearest.Side(keys, np.arange(len(keys)) // tile_rows)


def by_table(left, right, min_score):
    found = {}
    for a, x in enumerate(left.keys):
        scores = [float(np.float32(100 * 2 * lcs_by_table(x, y) / (len(x) + len(y)) if x or y else 100)) for y in right.keys]
        top = max(scores, default=-1)
        if top >= min_score:
            found[a] = (top, [b for b, s in enumerate(scores) if s == top])
    return found


@pytest.mark.parametrize(("min_score", "tile_rows", "low", "high"), [(80.0, 4, 1, 40), (66.67, 1, 20, 90), (91.5, 50, 60, 140), (80.0, 8, 150, 260)])
def test_best_partners_equal_scoring_all_pairs(monkeypatch, min_score, tile_rows, low, high):
    """Keys of one to five machine words, symbols beyond those counted, and blocks of a few keys."""
    monkeypatch.setattr(nearest, "_COUNTED", 9)
    monkeypatch.setattr(nearest, "_LEFT_ROWS", 11)
    monkeypatch.setattr(nearest, "_RIGHT_ROWS", 17)
    rng = random.Random(low)
    letters = "aaaabbbcdefghijk é漢ⵣ𝒳'1 "
    base = ["".join(rng.choices(letters, k=rng.randint(low, high))) for _ in range(40)]

    def damage(text):
        made = list(text)
        for _ in range(rng.randint(0, max(2, len(made) // 4))):
            at = rng.randrange(len(made) + 1)
            made[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "é", "z"])
        return "".join(made)

    left, right = side([*base, ""], tile_rows), side([damage(k) for k in base for _ in range(2)], tile_rows)
    a, b, score, met, scored = nearest.best_partners(left, right, min_score)
    expected = by_table(left, right, min_score)
    assert {x: (s, sorted(b[a == x])) for x, s in zip(a.tolist(), score.tolist())} == expected
    assert len(expected) > 5 and scored <= met <= len(left.keys) * len(right.keys)


def test_keys_are_copied_by_bin_whatever_the_tiles(spark):
    """Tiles of one key each: a key goes once to every bin that its own bin meets, not to every tile."""
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "omega", "corp", "wins", "award", "opens", "plant"]
    titles = [" ".join(rng.choices(words, k=4)) for _ in range(600)]
    a = spark.createDataFrame([(i, "one", t) for i, t in enumerate(titles[:300])], "i int, block string, title string")
    b = spark.createDataFrame([(i, "one", t + " q3") for i, t in enumerate(titles[300:])], "j int, block string, other string")
    folded = matching.fold_keys(a, b, block="block", left_text="title", right_text="other", right_order=["j"], min_score=80.0)
    flagged = folded.selectExpr("block", "_key", "_wanted", "_match is not null as _offered")
    sides = matching._met_keys(flagged, "block", 80.0, [], 1, None)
    assert [s.count() for s in sides] == [flagged.where("_wanted and not _offered").count(), flagged.where("_offered").count()]


def test_the_cut_into_bins_does_not_show(spark, monkeypatch):
    rng = random.Random(5)
    titles = ["".join(rng.choices("abcdefg ", k=rng.randint(4, 30))) for _ in range(300)]
    left, right = [(i, "one", t) for i, t in enumerate(titles[:150])], [(i, "one", t) for i, t in enumerate(titles[150:])]
    whole = run(spark, left, right, 66.0)
    monkeypatch.setattr(matching, "BIN_BYTES", 1500)
    assert run(spark, left, right, 66.0) == whole and len(whole) > 10


def test_letters_of_one_side_alone_leave_nothing_to_score():
    """A title followed by as many strange letters again: all pairs fail the bound, however often a letter stands."""
    rng = random.Random(9)
    titles = ["".join(rng.choices("abcdefgh ", k=50)) for _ in range(60)]
    left, right = side([t + "ⵣ" * 50 for t in titles], 1024), side([t + u for t, u in zip(titles, titles[1:])], 1024)
    *_, met, scored = nearest.best_partners(left, right, 80.0)
    assert scored == 0


@pytest.mark.parametrize("size", [20, 64, 100])
def test_matches_that_cost_places_do_not_count_as_won(size):
    """At any point of the recurrence: never below the outcome, and what a table of all cuts gives."""
    rng = random.Random(size)
    for _ in range(30):
        a, b = ("".join(rng.choices("abcd", k=rng.randint(size // 2, size))) for _ in range(2))
        words, step = (len(a) - 1) // 64 + 1, rng.randint(1, len(b))
        state = (1 << 64 * words) - 1
        for letter in b[:step]:
            hit = state & sum(1 << i for i, c in enumerate(a) if c == letter)
            state = ((state + hit) | (state - hit)) & ((1 << 64 * words) - 1)
        parts = [np.array([state >> 64 * w & (1 << 64) - 1], np.uint64) for w in range(words)]
        most = nearest._most(parts, np.array([len(a)]), np.array([len(b) - step]))
        cuts = [lcs_by_table(a[:i], b[:step]) + min(len(a) - i, len(b) - step) for i in range(len(a) + 1)]
        assert most.tolist() == [max(cuts)] and max(cuts) >= lcs_by_table(a, b)


def test_long_titles_are_ruled_out_by_their_beginning_without_sorting(spark):
    """A short key in a long title stays; the filter normalises a title once and sorts no words."""
    gap = "." * 700
    titles = ["alpha beta gamma", gap + "Beta  alpha-, " + gap + "gamma" + gap, "alpha " * 80, "a" * 24, "a" * 25, "", None, gap]
    right = spark.createDataFrame([(i, "one", t) for i, t in enumerate(titles)], "j int, block string, other string")
    keys = spark.createDataFrame([("alpha beta gamma",)], "_key string")
    kept = matching._within_reach(right, "other", keys, 80.0)
    assert [r.j for r in kept.orderBy("j").collect()] == [0, 1, 3]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_replace") == 4 and "sort(" not in plan
