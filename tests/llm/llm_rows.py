"""Invented texts and odd rows that the tests of the training-data operators share."""

import os
import random
import re
from pathlib import Path

import pytest

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(seed, n, syllables="ka lo mi ren sut tav eli dor pin gra"):
    """Invented words, the same for the same seed."""
    draw = random.Random(seed)
    parts = syllables.split()
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 4))) for _ in range(n))


def odd_rows():
    """Nulls in every column, empty, blank and very long texts, equal texts, fully repeated rows."""
    long = prose(1, 60_000)
    shared = prose(2, 90)
    return [
        (1, prose(3, 120), "en", "a", 1), (2, shared, "en", "a", 2), (3, shared, "de", None, 3),
        (4, shared, None, "b", None), (4, shared, None, "b", None), (5, None, "en", "b", 0),
        (6, "", "en", "c", 0), (7, " \n\t ", "en", "c", 4), (8, long, "en", "a", 5), (9, long + " end", "en", "b", 5),
        (None, prose(4, 80), "en", "c", 1), (None, prose(5, 80), None, None, 1), (None, None, None, None, None),
        (10, "é ü *** !!! | naïve\x85word", "fr", "d", 9), (11, "one", "en", "d", 3),
        (11, "two words", "en", "d", 9), (12, prose(3, 120).upper(), "en", "é", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns named like those the operators add."""
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    clash = "size shard slot measures fp chunk word count vector score held_out mix_row mix_id text_digest head_id leaked_items row id target copies".split()
    for name in clash:
        df = df.selectExpr("*", f"'x' as {name}")
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    if not Path(SMALL).exists():
        pytest.skip("test tables not present")
    return spark.read.parquet(f"{SMALL}/documents.parquet")
