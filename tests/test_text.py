import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from titleweave.functions import text


def evaluate(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_release_url_slug_is_decoded(spark):
    cases = {
        "https://wire.example.net/news-releases/q%26a-with-the-%22night-bus%22-crew-200000001.html": 'Q&A With The "Night Bus" Crew',
        "http://wire.example.net/a/b/News-Releases/o%27hara-s-3d-maps-200000002.html?x=1&y=2": "O'Hara S 3D Maps",
        "https://wire.example.net/contact": None,
        "https://wire.example.net/news-releases/5%-off+tax-200000003.html#top": "5% Off+Tax",
        "https://wire.example.net/news-releases/-200000004.html": None,
    }
    assert evaluate(spark, text.title_from_release_url, cases) == list(cases.values())


def test_title_case_matches_str_title(spark):
    samples = ["r&d o'neil 3m", "ßbe straße", "élan VITAL été", "漢字abc", "", "a-b_c d", "ﬁne"]
    assert evaluate(spark, text.title_case, samples) == [s.title() for s in samples]


def test_unquote_keeps_plus_and_bare_percent(spark):
    samples = ["a+b", "50%", "%E2%80%99s", "x%20y+z", "%zz"]
    assert evaluate(spark, text.unquote, samples) == ["a+b", "50%", "’s", "x y+z", "%zz"]


def test_normalize_title_follows_unicode_word_characters(spark):
    """Every BMP letter, digit, mark, punctuation and space, against the defining patterns.

    Code points newer than the JVM's character tables and the four separators U+001C-1F are
    the known differences; both are excluded by comparing only assigned, non-control ones.
    """

    def expected(s):
        s = re.sub(r"[^\w\s']", "", s.lower().strip())
        return re.sub(r"\s+", " ", s).strip()

    points = [
        chr(c)
        for c in range(32, 0x10000)
        if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c))[0] != "C"
    ]
    samples = [f"A{c}b  C{c}{c}'d " for c in points]
    got = evaluate(spark, text.normalize_title, samples)
    different = [s for s, g in zip(samples, got) if g != expected(s)]
    assert len(different) <= 60, [hex(ord(s[1])) for s in different[:80]]


def test_blank_test_knows_all_whitespace(spark):
    assert evaluate(spark, text.has_text, ["x", " \t\n", "  ", "", None]) == [
        True, False, False, False, False,
    ]


def test_page_title(spark):
    samples = [
        "<A>x</A><PAGE_TITLE>One\nTwo</PAGE_TITLE><PAGE_TITLE>Three</PAGE_TITLE>",
        "<PAGE_TITLE></PAGE_TITLE>", "<PAGE_TITLE>open", "none", None,
    ]
    assert evaluate(spark, text.extract_page_title, samples) == ["One\nTwo", "", None, None, None]


def test_html_unescape(spark):
    samples = ["R&amp;D &eacute; &#39;x&#39; &hellip;", "plain", "a &amp b", None]
    assert evaluate(spark, text.html_unescape, samples) == ["R&D é 'x' …", "plain", "a & b", None]


@pytest.mark.parametrize(
    ("function", "values", "expected"),
    [
        (
            text.date_from_release_path,
            ["https://x/news-release/2024/01/05/7/0/en/a.html", "https://x/news-release/2024/01", "https://x/"],
            ["2024-01-05", None, None],
        ),
        (
            text.date_from_home_path,
            ["https://x/news/home/20240102000123/en", "https://x/news", None],
            ["2024-01-02", None, None],
        ),
        (text.day_from_date_text, ["2024-01-05", "2024-01-xx", "2024-01", None], [5, -1, -1, -1]),
        (
            text.normalize_company,
            ["Acme & Sons, Inc.", "LLC CORP", "Costco Holdings Co", "Thé Company's"],
            ["acme sons", "", "costco", "thé s"],
        ),
    ],
)
def test_small_expressions(spark, function, values, expected):
    assert evaluate(spark, function, values) == expected
