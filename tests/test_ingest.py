import gzip
import json
import os
import re
import tracemalloc

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from conftest import rows
from titleweave import schemas
from titleweave.operators import inventory, ledger
from titleweave.plans import crosswalk, reports
from titleweave.sources import cdx, contents, html_pages, lakes, sitemaps, web_extract, writers

def _url(loc, changed, pad=""):
    return f"<url><loc>{pad}{loc}{pad}</loc><lastmod>{changed}</lastmod></url>"


# Five addresses: an escaped slash and a plus sign, a fragment, a query with padding around it, one
# whose slug is only a number, and one that is no release. Only a year is given as the day of the last.
_RELEASES = "https://wire.example.net/news-releases/"
SITEMAP = (
    '<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
    + _url(_RELEASES + "tidal-power-24%2F7-in-orkney-300000017.html", "2019-11-02")
    + _url(_RELEASES + "two-plus-two%3A-a-maths-prize-300000018.html#photo", "2019-11-04T23:59:59+01:00")
    + _url(_RELEASES + "harbour-opens-300000021.html?src=feed", "2019-11-05T00:00:00Z", pad=" \n ")
    + _url(_RELEASES + "-300000022.html", "2019-11-06")
    + _url("https://wire.example.net/contact", "2019-11-06")
    + "</urlset>"
)
SLUG_ROWS = [
    ("Harbour Opens", _RELEASES + "harbour-opens-300000021.html?src=feed", "2019-11-05"),
    ("Tidal Power 24/7 In Orkney", _RELEASES + "tidal-power-24%2F7-in-orkney-300000017.html", "2019-11-02"),
    ("Two Plus Two: A Maths Prize", _RELEASES + "two-plus-two%3A-a-maths-prize-300000018.html#photo", "2019-11-04"),
]
NEWS = """<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:news="http://www.google.com/schemas/sitemap-news/0.9">
<url><loc>https://x/News-Release/1</loc><news:news><news:publication_date>2024-01-05T01:00:00Z</news:publication_date>
<news:title> Profit &amp; Loss </news:title></news:news></url>
<url><loc>https://x/news-release/2</loc><lastmod>2024-01-06</lastmod><news:news><news:title>Second</news:title></news:news></url>
<url><loc>https://x/news-release/3</loc><news:news><news:title>No date</news:title></news:news></url>
<url><loc>https://x/news-release/4</loc><lastmod>2024-01-06</lastmod></url>
<url><loc>https://x/about</loc><lastmod>2024-01-06</lastmod><news:news><news:title>Not a release</news:title></news:news></url>
</urlset>"""


def documents(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "xml string")


def test_slug_sitemap(spark):
    assert rows(sitemaps.slug_entries(sitemaps.url_entries(documents(spark, SITEMAP)))) == SLUG_ROWS


def test_news_sitemap(spark):
    want = [("Profit & Loss", "https://x/News-Release/1", "2024-01-05"), ("Second", "https://x/news-release/2", "2024-01-06")]
    assert rows(sitemaps.news_entries(sitemaps.url_entries(documents(spark, NEWS)))) == want


def test_sitemap_without_namespace_and_with_damage(spark):
    damaged = SITEMAP.replace(' xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"', "").replace(
        "https://wire.example.net/contact</loc>", "https://wire.example.net/<<contact"
    )
    assert rows(sitemaps.slug_entries(sitemaps.url_entries(documents(spark, damaged)))) == SLUG_ROWS
    assert rows(sitemaps.url_entries(documents(spark, "", "not xml"))) == []


def test_sitemap_index(spark):
    index = documents(
        spark,
        '<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'
        "<sitemap><loc>https://x/news/en/2024-01.xml</loc></sitemap>"
        "<sitemap><loc>https://x/news/en/latest.xml</loc></sitemap>"
        "<sitemap><loc>https://x/other.xml</loc></sitemap></sitemapindex>",
    )
    children = sitemaps.child_sitemaps(sitemaps.index_entries(index))
    assert children.count() == 3
    assert rows(inventory.available_months(children)) == [(2024, 1)]


def test_archives_are_rejected_whole_and_cleaned(spark, tmp_path):
    good = gzip.compress(b"\xef\xbb\xbf" + SITEMAP.replace("harbour", "har\x00bour").encode() + b"\x00")
    (tmp_path / "good.xml.gz").write_bytes(good)
    (tmp_path / "cut.xml.gz").write_bytes(good[: len(good) - 12])
    (tmp_path / "flipped.xml.gz").write_bytes(good[:-6] + b"\x00\x01" + good[-4:])
    (tmp_path / "junk.xml.gz").write_bytes(b"no gzip at all")
    (tmp_path / "plain.xml.gz").write_bytes(gzip.compress(b"<urlset><url><loc>https://x/about</loc></url></urlset>"))
    files = spark.read.format("binaryFile").load(str(tmp_path))
    status = {r.path.rsplit("/")[-1]: (r.valid, r.n_urls) for r in sitemaps.validate_archives(files).collect()}
    assert status == {
        "good.xml.gz": (True, 4), "cut.xml.gz": (False, 0), "flipped.xml.gz": (False, 0),
        "junk.xml.gz": (False, 0), "plain.xml.gz": (False, 0),
    }
    titles = reports.archive_titles(files, "newswireca", "2019-11")
    assert rows(titles) == [(*r, "newswireca") for r in SLUG_ROWS]
    done = spark.sql("select 'newswireca' as source, date '2019-11-04' as day union all select 'other', date '2019-11-05'")
    left = reports.archive_titles(files, "newswireca", "2019-11", done)
    assert rows(left) == [(*r, "newswireca") for r in SLUG_ROWS if r[2] != "2019-11-04"]
    assert sitemaps.scan_archives(spark, str(tmp_path)).count() == 2


def _split_at_will(data, sizes):
    """A stream that hands out ``data`` in pieces of these sizes, then the rest a byte at a time."""
    at, parts = 0, []
    for size in sizes:
        parts.append(data[at : at + size])
        at += size
    parts = [p for p in parts if p] + [bytes([b]) for b in data[at:]]

    class Stream:
        def read(self, _size):
            return parts.pop(0) if parts else b""

    return Stream()


@pytest.mark.parametrize("sizes", [(), (7, 1, 30), (100,), (10**6,)])
def test_elements_do_not_depend_on_where_chunks_end(sizes):
    """Prefixed, nested and unclosed elements, a tag with an open bracket in it, tags of like names."""
    xml = (
        "<urls>a > b <url>one</url><n:url a='<' b>two <url> deep</n:url\n> <urlx>no</urlx> </url> <url/>"
        "<url>th\x00r\u00e9e</ur></url ><u <url\t>four</url><url>never closed <"
    )
    element = r"<(?:\w+:)?url(?:\s[^>]*)?>.*?</(?:\w+:)?url\s*>"
    want = re.findall(element, xml.replace("\x00", ""), re.S)
    assert len(want) == 4
    assert list(sitemaps.elements_of(_split_at_will(xml.encode(), sizes), "url")) == want


def test_a_long_archive_is_read_in_little_memory(tmp_path):
    """120 MB of elements; peak of what Python allocates stays at a few chunks."""
    path = tmp_path / "long.xml.gz"
    one = b"<url><loc>https://x/news-releases/a-%09d.html</loc></url>" + b" " * 1000
    with gzip.open(path, "wb", compresslevel=1) as out:
        for block in range(110):
            out.write(b"".join(one % (block * 1000 + i) for i in range(1000)))
    tracemalloc.start()
    with open(path, "rb") as packed:
        assert sitemaps.is_intact(packed)
        packed.seek(0)
        with gzip.open(packed) as unpacked:
            assert sum(1 for _ in sitemaps.elements_of(unpacked, "url")) == 110_000
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * 2**20


def test_archives_by_path_or_content(spark, tmp_path):
    """Files opened where they lie give what their content gives; empty, null and damaged ones give nothing."""
    good = gzip.compress(SITEMAP.encode()) + gzip.compress(b"<url><loc>second member</loc></url>")
    (tmp_path / "good file.xml.gz").write_bytes(good)
    (tmp_path / "empty.xml.gz").write_bytes(b"")
    (tmp_path / "cut.xml.gz").write_bytes(good[:-3])
    urls = sitemaps.scan_archive_urls(spark, str(tmp_path))
    held = spark.createDataFrame([("p", bytearray(good)), ("q", None)], "path string, content binary")
    by_path, by_content = (rows(u, "position", "loc") for u in (urls, sitemaps.archive_urls(held)))
    assert by_path == by_content and by_path[-1] == (5, "second member") and len(by_path) == 6
    assert sitemaps.archive_urls(held.where("false")).count() == 0


def test_xml_source_reads_the_same_entries(spark, tmp_path):
    (tmp_path / "a.xml").write_text(SITEMAP.strip())
    (tmp_path / "b.xml.gz").write_bytes(gzip.compress(NEWS.encode()))
    scanned = sitemaps.scan_urls(spark, str(tmp_path))
    assert rows(sitemaps.slug_entries(scanned)) == SLUG_ROWS
    assert sitemaps.news_entries(scanned).count() == 2


HOME = "https://press.example.com/news/home/"


def _captures(*tails):
    """An archive-index answer: one capture a minute, in the given order."""
    return [["timestamp", "original", "statuscode"]] + [
        [f"2017080908{n:02d}30", f"{HOME}{tail}", "200"] for n, tail in enumerate(tails)
    ]


# The slug of the first article is captured before and after its bare address; the second has only
# a bare address, twice; the third exists in two languages, of which one is asked for.
INDEX = _captures(
    "20170809005501/en/Glacier-Survey-Ends", "20170809005501/en", "20170809005501/en/Glacier-Survey-Ends",
    "20170809005502/en/", "20170809005502/en", "20170809005503/en/pt-br", "20170809005503/en/Ferry-Line-Sold",
    "20170809005504/es/Linea-Vendida", "20170809005505/en/map.svg",
)


def test_archive_index_to_inventory(spark):
    bodies = [json.dumps(INDEX), json.dumps(INDEX[:1]), "[]", "[[\"truncated", "null"]
    responses = spark.createDataFrame([("2017-08-09", b) for b in bodies], "day string, body string")
    entries = cdx.read_cdx(responses)
    assert entries.count() == len(INDEX) - 1
    found = inventory.inventory_from_index(cdx.status_ok(entries), F.col("day"), ["position"])
    got = [(r[0].removeprefix(HOME), *r[1:]) for r in rows(found)]
    assert [(u, h) for u, _, _, h in got if h] == [
        ("20170809005501/en/Glacier-Survey-Ends", "Glacier Survey Ends"),
        ("20170809005503/en/Ferry-Line-Sold", "Ferry Line Sold"),
    ]
    bare = [(u, h) for u, _, _, h in got if not h]
    assert len(bare) == 1 and bare[0][0].rstrip("/") == "20170809005502/en"
    assert {d for _, _, d, _ in got} == {"2017-08-09"}


@pytest.mark.parametrize(
    ("tail", "kept"),
    [
        ("/en", True), ("/en/", True), ("/en/Some-Title/", True), ("/en/zh-cn", False), ("/en/FR", False),
        ("/en/a/b", False), ("/en/chart.PDF", False), ("/de/Title", False), ("/english", False),
    ],
)
def test_english_article_test(spark, tail, kept):
    df = spark.createDataFrame([(f"{HOME}20170809005501{tail}",)], "original string")
    assert (inventory.english_articles(df).count() == 1) is kept


def test_slug_coverage(spark):
    df = spark.createDataFrame(
        [("u1", "Glacier Survey Ends"), ("u2", None), ("u3", "Ferry Line Sold"), ("u4", "  ")],
        "source_url string, headline_from_slug string",
    )
    assert tuple(inventory.slug_coverage(df).first()) == (4, 2, 2, 50.0)
    assert tuple(inventory.slug_coverage(df.limit(0)).first()) == (0, 0, 0, 0.0)
    assert [r[0] for r in inventory.slug_samples(df, True).collect()] == ["u1", "u3"]
    assert [r[0] for r in inventory.slug_samples(df, False, 1).collect()] == ["u2"]


def test_inventory_lake_with_legacy_days(spark, tmp_path):
    """Four days over two months: two old files without the slug column, one file without rows."""
    days = {
        "2018-12-30": ["Quarry Reopens", "Bridge Named", None, "Mill Burns"], "2018-12-31": "old",
        "2019-01-01": [], "2019-01-02": "old",
    }
    for day, slugs in days.items():
        year, month, dom = day.split("-")
        folder = tmp_path / f"year={year}" / f"month={month}" / f"day={dom}"
        folder.mkdir(parents=True)
        n = 1 if slugs == "old" else len(slugs)
        columns = {
            "source_url": pa.array([f"{day}/{i}" for i in range(n)], pa.string()),
            "wayback_timestamp": pa.array(["20190601000000"] * n, pa.string()),
            "date": pa.array([day] * n, pa.string()),
        }
        if slugs != "old":
            columns["headline_from_slug"] = pa.array(slugs, pa.string())
        pq.write_table(pa.table(columns), folder / "urls.parquet")
    path = str(tmp_path)
    status = inventory.inventory_status(spark, path, lakes.read_inventory(spark, path)).first().asDict()
    assert [str(d) for d in status["legacy_dates"]] == ["2018-12-31", "2019-01-02"]
    assert [status[k] for k in ("day_files", "slug_ready_day_files", "legacy_day_files")] == [4, 2, 2]
    assert [status[k] for k in ("total_urls", "slug_headline_count", "missing_slug_count")] == [6, 3, 3]
    assert status["slug_coverage_pct"] == pytest.approx(50.0)


def test_footers_are_all_that_is_read(spark, tmp_path):
    """Data pages are overwritten by zeros; a file without rows counts, one that is no Parquet is named."""
    for day, n in ((1, 3), (2, 0)):
        folder = tmp_path / "lake" / "source=a b" / "year=2020" / "month=5" / f"day={day}"
        folder.mkdir(parents=True)
        file = folder / "part.parquet"
        pq.write_table(pa.table({"source_url": [f"{i}" * 9 for i in range(n)]}, pa.schema([("source_url", pa.string())])), file)
        content = bytearray(file.read_bytes())
        start = len(content) - 8 - int.from_bytes(content[-8:-4], "little")
        content[4:start] = bytes(start - 4)
        file.write_bytes(content)
    path = str(tmp_path / "lake")
    size = sum(f.stat().st_size for f in (tmp_path / "lake").rglob("*.parquet"))
    found = inventory.lake_inventory(spark, path, ["source"], ["year", "month", "day"])
    assert rows(found) == [("a b", 2, 1, 2, size, 3)]
    listed = inventory.inventory_files(spark, path)
    assert rows(listed.selectExpr("cast(date as string)", "n_rows", "has_slug_column")) == [
        ("2020-05-01", 3, False), ("2020-05-02", 0, False)
    ]
    file.write_bytes(b"PAR1 not really")
    with pytest.raises(PythonException, match="no Parquet footer"):
        inventory.lake_inventory(spark, path, ["source"], ["year", "month", "day"]).collect()


TITLE_KEYS = {"source": F.col, "month": lambda _: F.make_date(F.col("year"), F.col("month"), F.lit(1))}


def test_versions_follow_what_a_lake_holds(spark, tmp_path):
    lake, book = str(tmp_path / "lake"), str(tmp_path / "book")
    data = [("A title", "u1", "2021-03-01", "s"), (None, "u2", "2021-03-01", "s"), ("B", "u3", "2021-04-02", "s"),
            ("B", "u3", "2021-04-02", "s"), ("C", None, "2021-04-09", "t")]

    def write(some):
        writers.write_daily(spark.createDataFrame(some, "headline string, source_url string, date string, source string"), lake)

    def now():
        keys = {name: make(name) for name, make in TITLE_KEYS.items()}
        found = contents.lake_versions(spark, lake, schemas.TITLES, keys, book)
        return {(r.source, r.month.month): r.input_version for r in found.collect()}

    write(data)
    first = now()
    assert set(first) == {("s", 3), ("s", 4), ("t", 4)} and now() == first
    write(data[::-1])  # equal rows, other files
    assert now() == first
    write([data[0], ("", "u2", "2021-03-01", "s")])  # a null became an empty text
    assert {k for k, v in now().items() if v != first[k]} == {("s", 3)}
    write(data[2:3])  # one of two equal rows
    assert {k for k, v in now().items() if v != first[k]} == {("s", 3), ("s", 4)}
    file = next((tmp_path / "lake" / "source=t").rglob("*.parquet"))
    kept, stat = file.read_bytes(), file.stat()
    file.write_bytes(bytes(len(kept)))
    os.utime(file, ns=(stat.st_atime_ns, stat.st_mtime_ns))
    assert now()["t", 4] == first["t", 4]  # known by name, size and time: not opened again
    file.unlink()
    assert set(now()) == {("s", 3), ("s", 4)}


def test_versions_of_rows(spark):
    def version(*data):
        found = contents.content_versions(spark.createDataFrame(data, "k int, a string, b string"), ["k"])
        return {r.k: r.input_version for r in found.collect()}

    base = version((1, "x", None), (1, "y", "z"))
    assert base == version((1, "y", "z"), (1, "x", None))
    for other in [((1, None, "x"), (1, "y", "z")), ((1, "x", ""), (1, "y", "z")), ((1, "x", None),),
                  ((1, "x", None), (1, "y", "z"), (1, "y", "z")), ((1, "y", None), (1, "x", "z"))]:
        assert version(*other) != base


def test_an_empty_month_is_done_and_cleared(spark, tmp_path):
    path, book = str(tmp_path / "web"), str(tmp_path / "months")
    titles = spark.createDataFrame(
        [("2022-01-05", "u1"), ("2022-02-05", "u2")], "d string, source_url string"
    ).selectExpr("cast(d as timestamp) as gkg_date", "source_url", "'n' as source_name", "'h' as headline")
    months = spark.sql("select 'web' as source, explode(array(date '2022-01-01', date '2022-02-01', date '2022-03-01')) as month")
    writers.write_monthly(titles, path, processed=months.where("month < '2022-03-01'"), ledger_path=book)
    assert rows(ledger.pending_months(months, spark.read.parquet(book)).selectExpr("cast(month as string)")) == [("2022-03-01",)]
    # January is fetched again and holds nothing now; March never did.
    writers.write_monthly(titles.where("false"), path, processed=months.where("month(month) <> 2"), ledger_path=book)
    assert rows(lakes.read_web_titles(spark, path), "source_url") == [("u2",)]
    assert ledger.pending_months(months, spark.read.parquet(book)).count() == 0


def test_month_map(spark):
    """One year asked for: a gap, a month too many on either side, a stamp of 13 digits, and one of letters."""
    stamps = {f"1999-{m:02d}": f"2005{m:02d}01120000" for m in range(1, 13)}
    stamps |= {"1998-12": "20050101120000", "2000-01": "20050101120000", "1999-03": "2005030112000", "1999-11": "soon"}
    gone = ["1999-06", "1999-07"]

    def findings(absent, known):
        data = [(m, s) for m, s in stamps.items() if m not in absent]
        df = spark.createDataFrame(data, "month string, snapshot_ts string")
        found = {}
        for r in inventory.validate_month_map(df, "1999-01", "1999-12", known).collect():
            found.setdefault(r.finding, []).append(r.month)
        assert len(found.pop("in_range")) == 12 - len(absent)
        return {k: sorted(v) for k, v in found.items()}

    always = {"malformed_timestamp": ["1999-03", "1999-11"], "outside_range": ["1998-12", "2000-01"]}
    assert findings([], []) == always
    assert findings(gone, []) == always | {"missing": gone}
    assert findings(gone, ["1999-07", "1999-09"]) == always | {"missing": ["1999-06"], "covered_no_archive": ["1999-09"]}


def test_month_ranges(spark):
    alone, across, long = ["2001-06"], ["2003-11", "2003-12", "2004-01"], [f"2008-{m:02d}" for m in range(2, 12)]
    df = spark.createDataFrame([(m,) for m in reversed(alone + across + long)], "month string")
    assert [r[0] for r in rows(inventory.collapse_month_ranges(df))] == [
        "2001-06", "2003-11..2004-01", "2008-02..2008-11",
    ]


def test_newest_valid_snapshot_among_three(spark):
    data = [("m1", "5", False), ("m1", "4", True), ("m1", "3", True), ("m2", "9", False), ("m2", "8", False),
            ("m2", "7", False), ("m2", "6", True)]
    df = spark.createDataFrame(data, "month string, timestamp string, valid boolean")
    assert rows(inventory.pick_valid_snapshot(df)) == [("m1", "4")]


PAGES = [
    ("https://x/1", '<meta content="2024-01-05T10:00" name="date"><h1 class="a">First <b> half</b></h1>'),
    ("https://x/2", '<h1 class="top release-header__title"> R&amp;D </h1><h1>x</h1>'
                    '<meta property="article:published_time" content="2024-02-01T00:00">'),
    ("https://x/3", '<h1></h1><h1 class="release-header__title">Later class wins</h1>'),
    ("https://x/4", "<h1> &nbsp; </h1>"),
    ("https://x/news-release/2024/03/09/1/x", '<h1 class="main-title">Main</h1><h1 class="article-headline">Article</h1>'),
]


def test_html_titles(spark):
    pages = spark.createDataFrame(PAGES, "url string, html string")
    got = {r.source_url: (r.headline, r.date) for r in html_pages.read_html_titles(pages, "prnewswire").collect()}
    assert got == {
        "https://x/1": ("Firsthalf", "2024-01-05"),  # text pieces are stripped, then joined
        "https://x/2": ("R&D", "2024-02-01"),
        "https://x/3": ("Later class wins", None),
        "https://x/news-release/2024/03/09/1/x": ("Main", None),
    }
    globe = html_pages.read_html_titles(pages.filter("url like '%release%'"), "globenewswire")
    assert rows(globe, "headline", "date") == [("Article", "2024-03-09")]


def test_web_titles_keep_the_earliest_copy_per_month(spark):
    data = [
        (20240105100000, "u1", "wsj.com", "<PAGE_TITLE>A &amp; B</PAGE_TITLE>", None),
        (20240103100000, "u2", "wsj.com", "<PAGE_TITLE>A & B</PAGE_TITLE>", None),
        (20240103100000, "u2", "wsj.com", "<PAGE_TITLE>A & B</PAGE_TITLE>", None),
        (20240203100000, "u3", "wsj.com", "<PAGE_TITLE>A & B</PAGE_TITLE>", None),
        (20240104100000, "u4", "wsj.com", "<PAGE_TITLE> &nbsp;</PAGE_TITLE>", None),
        (20240104100000, "u5", "wsj.com", "<PAGE_TITLE>French</PAGE_TITLE>", "srclc:fra"),
        (20240104100000, "u6", "example.com", "<PAGE_TITLE>Other</PAGE_TITLE>", None),
        (20240104100000, "u7", "wsj.com", "none", None),
        (20240301000000, "u8", "wsj.com", "<PAGE_TITLE>Too late</PAGE_TITLE>", None),
    ]
    pages = spark.createDataFrame(
        data, "DATE long, DocumentIdentifier string, SourceCommonName string, Extras string, TranslationInfo string"
    ).withColumn("partition_time", F.to_timestamp(F.col("DATE").cast("string"), "yyyyMMddHHmmss"))
    titles = web_extract.clean_web_titles(web_extract.gkg_extract(pages, "2024-01-01", "2024-03-01"))
    assert rows(titles, "source_url", "headline") == [("u2", "A & B"), ("u3", "A & B")]


def test_feed_with_nanosecond_timestamps(spark, tmp_path):
    moment = pa.array([1700000000123456789], pa.timestamp("ns"))
    for year in (2021, 2023):
        folder = tmp_path / f"year={year}"
        folder.mkdir()
        pq.write_table(pa.table({"timestamp_utc": moment, "rp_story_id": [f"s{year}"]}), folder / "a.parquet", version="2.6")
    feed = lakes.read_feed_by_year(spark, str(tmp_path), "2022-05-01", "2024-01-01")
    assert rows(feed.selectExpr("cast(timestamp_utc as string)", "rp_story_id", "year")) == [
        ("2023-11-14 22:13:20.123456", "s2023", 2023)
    ]


def test_relayout_counts_and_keeps_existing_months(spark, tmp_path):
    flat, hive = tmp_path / "flat", tmp_path / "hive"
    flat.mkdir()
    for month, n in (("2024-01", 3), ("2024-02", 2)):
        pq.write_table(pa.table({"x": list(range(n))}), flat / f"{month}.parquet")
    pq.write_table(pa.table({"x": [1]}), flat / "notes.parquet")
    want = [(2024, 1, 3, 3, True), (2024, 2, 2, 2, True)]
    for _ in range(2):
        assert rows(writers.relayout_flat_to_hive(spark, str(flat), str(hive))) == want
    assert spark.read.parquet(str(hive)).count() == 5


def test_daily_write_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "titles")

    def titles(*data):
        return spark.createDataFrame(list(data), "headline string, source_url string, date string, source string")

    writers.write_daily(titles(("a", "u1", "2024-01-01", "s"), ("b", "u2", "2024-01-02", "s")), path)
    writers.write_daily(titles(("c", "u3", "2024-01-02", "s")), path)
    assert rows(lakes.read_titles(spark, path), "headline", "day") == [("a", 1), ("c", 2)]
    assert rows(lakes.filter_to_month(lakes.read_titles(spark, path), "2024-02")) == []


def test_inventory_ledger_records_empty_days(spark, tmp_path):
    found = spark.createDataFrame([("u1", "2024-01-01")], "source_url string, date string")
    days = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "d string").selectExpr("cast(d as date) as day")
    path, ledger = str(tmp_path / "inventory"), str(tmp_path / "ledger")
    writers.write_inventory(found, days, path, ledger, "wire")
    assert rows(spark.read.parquet(ledger).selectExpr("cast(day as string)", "row_count")) == [("2024-01-01", 1), ("2024-01-02", 0)]


def test_slug_titles_spare_the_page(spark):
    known = spark.createDataFrame(
        [(f"{HOME}20170809005501/en/A-B", "A B"), (f"{HOME}20170809005502/en", None), (f"{HOME}20170810005502/en", None)],
        "source_url string, headline_from_slug string",
    )
    pages = spark.createDataFrame(
        [(f"{HOME}20170809005502/en", "<h1>Page title</h1>"), (f"{HOME}20170809005501/en/A-B", "<h1>Unused</h1>")],
        "url string, html string",
    )
    got = rows(html_pages.titles_from_inventory(known, pages), "headline", "date")
    assert got == [("A B", "2017-08-09"), ("Page title", "2017-08-09")]


def test_refresh_clears_a_month_that_lost_its_matches(spark, tmp_path):
    path, book = str(tmp_path / "crosswalk"), str(tmp_path / "ledger")
    rp = spark.createDataFrame(
        [("2024-01-05", "s1", "Orchard sold at auction"), ("2024-02-05", "s2", "Lighthouse relit")],
        "d string, rp_story_id string, headline string",
    ).selectExpr(
        "cast(d as timestamp) as timestamp_utc", "rp_story_id", "'e' as rp_entity_id",
        "'n' as entity_name", "headline", "'w' as source_name",
    )

    def titles(january):
        data = [(january, "u1", "2024-01-05", "s", 2024, 1), ("Lighthouse relit", "u2", "2024-02-05", "s", 2024, 2)]
        return spark.createDataFrame(
            data, "headline string, source_url string, date string, source string, year int, month int"
        )

    def inputs(january):
        data = [("s", "2024-01-01", january), ("s", "2024-02-01", "v1")]
        return spark.createDataFrame(data, "source string, m string, input_version string").selectExpr(
            "source", "cast(m as date) as month", "input_version"
        )

    def stored():
        return rows(writers.combine_crosswalk(spark, path), "nw_source_url", "fuzzy_score")

    crosswalk.refresh_crosswalk(titles("Orchard sold at auction"), rp, inputs("v1"), path, book)
    assert stored() == [("u1", 100.0), ("u2", 100.0)]
    redone = crosswalk.refresh_crosswalk(titles("Something else entirely"), rp, inputs("v2"), path, book)
    assert [str(r[0]) for r in rows(redone)] == ["2024-01-01"]
    assert stored() == [("u2", 100.0)]
    assert crosswalk.refresh_crosswalk(titles("Orchard sold at auction"), rp, inputs("v2"), path, book).count() == 0
