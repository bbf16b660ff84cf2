"""Fill-in-the-middle cuts against slicing of lists of lines."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import SCHEMA, SMALL, documents, empty, odd, prose  # noqa: F401

from pyspark.sql import functions as F

from titleweave.llm import fill_middle, queries


def by_hand(doc_id, text, seed=7, rate=100, spm_rate=50, markers=("<P>", "<S>", "<M>")):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(lines)
    if not text or any(m in text for m in markers) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    a, b, c = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
    p, s, m = markers
    if h[3] % 100 < spm_rate:
        return n, "spm", len(a), len(b), s + c + p + a + m + b
    return n, "psm", len(a), len(b), p + a + s + c + m + b


def check(rows, **options):
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_hand(r.doc_id, r.text, **options)
        assert r.back == (r.text or "")


def with_back(df):
    return df.withColumn("back", fill_middle.restore(F.col("output"), F.col("form")))


def test_registered_query(spark, documents):
    rows = {r.doc_id: r for r in queries.op11_fill_in_middle(spark, SMALL).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert set(rows) == set(texts)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for i, text in texts.items():
        want = by_hand(i, text)
        r = rows[i]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == want[:4]
        assert r.output_sha256 == sha(want[4]) and r.restored_sha256 == sha(text or "")


def test_odd_rows(odd, empty):
    found = with_back(fill_middle.fill_in_middle(odd)).collect()
    assert len(found) == odd.count()
    check(found)
    assert set(odd.columns) <= set(found[0].asDict())
    assert fill_middle.fill_in_middle(empty).count() == 0


def test_clashing_names_are_replaced(spark):
    df = spark.createDataFrame([(1, "a\nb\n", "x", "y")], "doc_id bigint, text string, N string, output string")
    found = fill_middle.fill_in_middle(df)
    assert sorted(c.lower() for c in found.columns) == sorted("doc_id text n form prefix_chars middle_chars output".split())
    assert found.first()["n"] == 2


def test_long_texts_of_many_blocks(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choice("ab é\n\U0001F600\n") for _ in range(60_000)), "\n" * 50_000, "x" * 200_000]
    texts += [prose(6, 40_000).replace(" ", "\n", 9000), "\n", "é", "a<M>b\nc", "a<P\n>b<\nS>"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts * 6)]
    check(with_back(fill_middle.fill_in_middle(spark.createDataFrame(rows, SCHEMA))).collect())


def test_rates_seeds_and_markers(spark):
    rows = [(i, f"one {i}\ntwo\nthree", None, None, None) for i in range(400)]
    options = {"rate": 40, "spm_rate": 20, "seed": 11, "markers": ("[pre]", "[suf]", "[mid]")}
    found = fill_middle.fill_in_middle(spark.createDataFrame(rows, SCHEMA), **options)
    found = found.withColumn("back", fill_middle.restore(F.col("output"), F.col("form"), options["markers"])).collect()
    check(found, **options)
    forms = [r.form for r in found]
    assert 100 < 400 - forms.count("plain") < 220 and 0 < forms.count("spm") < forms.count("psm")


@pytest.mark.parametrize("markers", [("", "b", "c"), ("aa", "b", "c"), ("ab", "bc", "d"), ("a", "a", "b"), ("xay", "a", "b")])
def test_markers_that_overlap_are_refused(empty, markers):
    with pytest.raises(ValueError):
        fill_middle.fill_in_middle(empty, markers=markers)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 9)), max_size=70), st.integers(1, 220))
def test_tree_and_descent(counts, rank):
    tree = fill_middle.fenwick(np.array(counts, np.int64).reshape(-1, 2))
    place, passed = fill_middle.descend(tree, rank)
    totals = [sum(c[0] for c in counts[:k]) for k in range(len(counts) + 1)]
    assert place == max(k for k in range(len(totals)) if totals[k] < rank)
    assert passed.tolist() == [totals[place], sum(c[1] for c in counts[:place])]
