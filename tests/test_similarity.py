import tracemalloc

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from titleweave.functions import similarity


def lcs_by_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


words = st.text(alphabet="abcé 漢'1", max_size=150)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(words, words), max_size=12))
def test_lcs_equals_dynamic_programming(pairs):
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    assert list(similarity.lcs_lengths(left, right)) == [lcs_by_table(a, b) for a, b in pairs]


def test_scores():
    left = pd.Series(["", "", "abc", "abcde", "new york mets"])
    right = pd.Series(["", "x", "abc", "abcdf", "mets new york"])
    expected = [100.0, 0.0, 100.0, 80.0, 200 * lcs_by_table(left[4], right[4]) / 26]
    assert np.allclose(similarity.score_pairs(left, right), expected)


def test_scores_are_single_precision(spark):
    df = spark.createDataFrame([("abcdef", "abcdeg")], "a string, b string")
    score = df.select(similarity.token_sort_ratio(F.col("a"), F.col("b"))).first()[0]
    assert score == float(np.float32(100 * (1 - 2 / 12)))


def test_bound_never_excludes_a_reachable_pair(spark):
    rng = np.random.default_rng(7)
    letters = list("aaaaabcdefg 019é-")
    pairs = []
    for _ in range(1500):
        a = "".join(rng.choice(letters, rng.integers(0, 45)))
        b = list(a)
        for _ in range(rng.integers(0, 14)):
            if b and rng.random() < 0.5:
                b.pop(rng.integers(0, len(b)))
            else:
                b.insert(rng.integers(0, len(b) + 1), rng.choice(letters))
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string")
    for side in "ab":
        profile = similarity.letter_profile(side)
        df = df.withColumns({f"{side}p{i}": p for i, p in enumerate(profile)})
        df = df.withColumn(f"{side}len", F.length(side))
    for threshold in (60.0, 80.0, 83.3333, 95.0):
        bound = F.expr(similarity.may_reach(threshold, "a", "b"))
        scored = df.select(bound.alias("kept"), similarity.token_sort_ratio(F.col("a"), F.col("b")).alias("s"))
        assert scored.filter(~F.col("kept") & (F.col("s") >= threshold)).count() == 0
        # ... and it does exclude something.
        assert scored.filter(~F.col("kept")).count() > 0


def test_long_keys_equal_dynamic_programming_and_are_quick():
    import random
    import time

    from titleweave.functions.similarity import lcs_length_long, lcs_lengths

    draw = random.Random(4)
    for n, m in ((1, 700), (700, 1), (400, 900), (1200, 1100)):
        a, b = ("".join(draw.choice("abcdé ") for _ in range(k)) for k in (n, m))
        row = [0] * (m + 1)
        for x in a:
            before = row[:]
            for j, y in enumerate(b, 1):
                row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
        assert lcs_length_long(a, b) == row[-1] == lcs_lengths([a], [b])[0]
    a, b = ("".join(draw.choice("abcdefgh ") for _ in range(4000)) for _ in range(2))
    start = time.process_time()
    lcs_length_long(a, b)
    assert time.process_time() - start < 0.05


def test_a_very_long_right_key_does_not_widen_the_others():
    rng = np.random.default_rng(4)
    short = ["".join(rng.choice(list("abcdefgh "), 11)) for _ in range(10_000)]
    right = [*short[1:], "ab" * 100_000]
    tracemalloc.start()
    scores = similarity.score_pairs(pd.Series(short), pd.Series(right))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * 2**20
    some = rng.choice(9_999, 50)
    assert np.allclose(scores[some], [200 * lcs_by_table(short[i], right[i]) / 22 for i in some])
    common = lcs_by_table(short[-1], "ab" * 50)  # eleven characters need no more than these
    assert np.isclose(scores[-1], 200 * common / 200_011)


def test_scores_across_the_widths_of_keys():
    rng = np.random.default_rng(6)
    sizes = [0, 1, 63, 64, 127, 128, 191, 192, 1023, 1024, 1100]
    pairs = [("".join(rng.choice(list("abc"), a)), "".join(rng.choice(list("abc"), b))) for a in sizes for b in sizes]
    left, right = zip(*pairs)
    got = similarity.score_pairs(pd.Series(left), pd.Series(right))
    assert np.allclose(got, [200 * lcs_by_table(a, b) / (len(a) + len(b)) if a or b else 100 for a, b in pairs])
