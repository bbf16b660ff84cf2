"""Column expressions for titles, URL slugs and company names.

Everything here stays in the JVM except ``html_unescape``, which needs the full HTML5
entity table and goes through one Arrow-batched UDF.
"""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words dropped from a company name before it is compared.
COMPANY_SUFFIXES = [
    "inc", "corp", "corporation", "co", "company", "ltd", "limited", "llc", "lp", "plc",
    "group", "holdings", "holding", "enterprises", "enterprise", "intl", "international",
    "technologies", "technology", "systems", "industries", "services", "bancorp",
    "bancshares", "financial",
]

# File extensions that mark a URL tail as an asset, not an article slug.
ASSET_EXTENSIONS = [
    ".css", ".doc", ".docx", ".gif", ".ico", ".jpeg", ".jpg", ".js", ".json", ".pdf",
    ".png", ".svg", ".txt", ".webp", ".xml",
]

# Unicode-aware classes: Java's plain \w and \s are ASCII only.
_NOT_WORD = r"(?U)[^\p{L}\p{N}_\s']"
_SPACES = r"(?U)\s+"
_EDGE_SPACES = r"(?U)^\s+|\s+\z"
_CASED_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only knows U+0020)."""
    return F.regexp_replace(text, _EDGE_SPACES, "")


def has_text(text: Column) -> Column:
    """True when the text is neither null nor all whitespace."""
    return text.isNotNull() & text.rlike(r"(?U)\S")


def null_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def normalize_title(text: Column) -> Column:
    """Lower case, punctuation (but not apostrophes) removed, whitespace collapsed."""
    bare = F.regexp_replace(F.lower(text), _NOT_WORD, "")
    return F.trim(F.regexp_replace(bare, _SPACES, " "))


def token_sort_key(text: Column) -> Column:
    """Words in code point order, joined by one space."""
    return F.array_join(F.array_sort(F.split(text, " ")), " ")


def normalize_company(name: Column) -> Column:
    """Lower case, ``& . ' ,`` as spaces, legal and generic suffix words removed."""
    spaced = F.regexp_replace(F.lower(name), "[&.',]", " ")
    words = "|".join(COMPANY_SUFFIXES)
    kept = F.regexp_replace(spaced, rf"(?U)\b({words})\b", " ")
    return F.trim(F.regexp_replace(kept, _SPACES, " "))


def title_case(text: Column) -> Column:
    """Capitalise every run of cased letters, so ``r&d`` becomes ``R&D``."""

    def capitalise(run: Column) -> Column:
        first = F.upper(F.substring(run, 1, 1))
        return F.concat(
            F.substring(first, 1, 1),
            F.lower(F.substring(first, 2, 8)),  # e.g. the second S of SS, from a sharp s
            F.lower(F.substring(run, 2, 2**30)),
        )

    runs = F.regexp_extract_all(text, F.lit(_CASED_RUNS), F.lit(1))
    return F.array_join(F.transform(runs, capitalise), "")


def unquote(text: Column) -> Column:
    """Percent-decode; a bare ``%`` and ``+`` stay as they are."""
    guarded = F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25")
    decoded = F.url_decode(F.replace(guarded, F.lit("+"), F.lit("%2B")))
    return F.when(text.contains("%"), decoded).otherwise(text)


def _words_from_slug(slug: Column) -> Column:
    return title_case(strip(F.replace(unquote(slug), F.lit("-"), F.lit(" "))))


def title_from_release_slug(slug: Column) -> Column:
    """Approximate title of an article from its bare URL slug; null when nothing is left."""
    return null_if_empty(_words_from_slug(slug))


def title_from_release_url(url: Column) -> Column:
    """Approximate title from ``…/news-releases/<slug>-<id>.html``; null when absent."""
    slug = F.regexp_extract(url, r"(?i)/news-releases/([^?#]*)", 1)
    slug = F.regexp_replace(slug, r"\.html\z", "")
    slug = F.regexp_replace(slug, r"-\d{6,}\z", "")
    return null_if_empty(_words_from_slug(slug))


def extract_page_title(extras: Column) -> Column:
    """Text of the first PAGE_TITLE element; null when it is missing or unclosed."""
    pattern = r"(?s)<PAGE_TITLE>(.*?)</PAGE_TITLE>"
    return F.when(extras.rlike(pattern), F.regexp_extract(extras, pattern, 1))


@F.pandas_udf(StringType())
def _unescape(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def html_unescape(text: Column) -> Column:
    """Replace HTML entities. Rows without ``&`` reach Python as null and come back as is."""
    return F.coalesce(_unescape(F.when(text.contains("&"), text)), text)


def date_from_release_path(url: Column) -> Column:
    """``Y-M-D`` from the three path segments after ``/news-release/``; not validated."""
    pattern = r"/news-release/([^/]*)/([^/]*)/([^/]*)"
    parts = [F.regexp_extract(url, pattern, i) for i in (1, 2, 3)]
    return F.when(url.rlike(pattern), F.concat_ws("-", *parts))


def date_from_home_path(url: Column) -> Column:
    """``Y-M-D`` from the eight characters after ``/home/``; null without that segment."""
    tail = F.get(F.split(url, "/home/"), 1)
    parts = [F.substring(tail, start, size) for start, size in ((1, 4), (5, 2), (7, 2))]
    return F.when(tail.isNotNull(), F.concat_ws("-", *parts))


def day_from_date_text(text: Column) -> Column:
    """Day of month of a ``YYYY-MM-DD…`` string, -1 when it has none."""
    day = F.substring(text, 9, 2).try_cast("int")
    return F.when(F.length(text) >= 10, F.coalesce(day, F.lit(-1))).otherwise(F.lit(-1))


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, "^[a-zA-Z]+://([^/?#]+)", 1)


def is_release_url(url: Column, marker: str = "/news-release") -> Column:
    """Press-release page test; sources differ only in the marker."""
    return F.lower(url).contains(marker)


def is_asset_slug(slug: Column) -> Column:
    endings = "|".join(e.lstrip(".") for e in ASSET_EXTENSIONS)
    return F.lower(slug).rlike(rf"\.({endings})\z")
