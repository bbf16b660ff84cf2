"""Sitemaps: plain or gzipped XML, landed as files or held in a column.

``url_entries``/``index_entries`` take XML text in a column; the ``scan_*`` forms let Spark's
XML source split large intact files by element. Both feed the same projections.
"""

from __future__ import annotations

import gzip
import io
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleweave.functions.text import has_text, is_release_url, strip, title_from_release_url
from titleweave.sources.files import list_files, open_file

_URL_ELEMENT = (
    "loc string, lastmod string, news struct<title: string, publication_date: string>"
)
_INDEX_ELEMENT = "loc string, lastmod string"
_OPTIONS = {"ignoreNamespace": "true", "inferSchema": "false", "timeZone": "UTC"}


def decode_archives(files: DataFrame) -> DataFrame:
    """(path, xml) of each gzip file that decompresses in full; others are left out.

    ``files`` is a ``binaryFile`` scan or any (path, content). A partly readable archive is
    rejected as a whole. A byte order mark and NUL bytes are removed.
    """

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def text(content: bytes) -> str | None:
            try:
                raw = gzip.decompress(content)
            except (OSError, EOFError, ValueError, gzip.zlib.error):
                return None
            return raw.removeprefix(b"\xef\xbb\xbf").replace(b"\x00", b"").decode("utf-8", "replace")

        # One archive at a time: unpacked sitemaps are large, batches of them larger.
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                xml = text(content)
                if xml is not None:
                    yield pd.DataFrame({"path": [path], "xml": [xml]})

    return files.select("path", "content").mapInPandas(decode, "path string, xml string")


def scan_archives(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return decode_archives(files)


CHUNK = 1 << 20  # bytes unpacked at a time


def is_intact(packed: io.IOBase) -> bool:
    """Whether a gzip stream unpacks to its end with length and checksum right; nothing is kept."""
    try:
        with gzip.open(packed) as unpacked:
            while unpacked.read(CHUNK):
                pass
    except (gzip.BadGzipFile, EOFError, zlib.error):
        return False
    return True


def elements_of(stream: io.IOBase, tag: str) -> Iterator[str]:
    """Text of every ``<tag>`` element of an XML stream, in order, NUL bytes removed.

    Holds one chunk and the element that is open at its end.
    """
    opening = re.compile(rb"<(?:\w+:)?%b(?:\s[^>]*)?>" % tag.encode())
    closing = re.compile(rb"</(?:\w+:)?%b\s*>" % tag.encode())
    held, inside, sought = bytearray(), False, 0
    while chunk := stream.read(CHUNK):
        held += chunk.replace(b"\x00", b"")
        while found := (closing if inside else opening).search(held, sought):
            if inside:
                yield held[: found.end()].decode("utf-8", "replace")
                del held[: found.end()]
                sought = 0
            else:
                del held[: found.start()]
                sought = found.end() - found.start()
            inside = not inside
        # A tag cut by the chunk's end holds no ">", so it starts behind the last one.
        sought = max(sought, held.rfind(b">") + 1)
        if not inside:
            cut = held.find(b"<", sought)
            del held[: cut if cut >= 0 else len(held)]
            sought = 0


def archive_elements(files: DataFrame, tag: str) -> DataFrame:
    """(path, position, piece) of every ``<tag>`` in gzip archives, in memory that does not grow with them.

    ``files`` has ``path`` and may have ``content``; without it each file is opened at its path.
    An archive is unpacked twice, a chunk at a time: once to see that its checksum holds, then for
    its elements; a partly readable one gives none, nor does a null content.
    """
    inline = "content" in files.columns
    schema = pa.schema([("path", pa.string()), ("position", pa.int32()), ("piece", pa.string())])

    def batch_of(path: str, pieces: list[str], end: int) -> pa.RecordBatch:
        places = range(end - len(pieces), end)
        columns = [pa.array([path] * len(pieces)), pa.array(places, pa.int32()), pa.array(pieces)]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    def of_archive(path: str, packed) -> Iterator[pa.RecordBatch]:
        if not is_intact(packed):
            return
        packed.seek(0)
        pieces, size, end = [], 0, 0
        with gzip.open(packed) as unpacked:
            for piece in elements_of(unpacked, tag):
                pieces.append(piece)
                size, end = size + len(piece), end + 1
                if size >= CHUNK:
                    yield batch_of(path, pieces, end)
                    pieces, size = [], 0
        if pieces:
            yield batch_of(path, pieces, end)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path = batch.column("path")[i].as_py()
                content = batch.column("content")[i] if inline else None
                if inline and not content.is_valid:
                    continue
                with pa.BufferReader(content.as_buffer()) if inline else open_file(path) as packed:
                    yield from of_archive(path, packed)

    wanted = files.select("path", *(["content"] if inline else []))
    return wanted.mapInArrow(read, "path string, position int, piece string")


def archive_urls(files: DataFrame) -> DataFrame:
    """Same as ``url_entries`` of the decoded archives, without holding any of them whole."""
    parsed = archive_elements(files, "url").withColumn("_e", F.from_xml("piece", _URL_ELEMENT, _OPTIONS))
    return parsed.select("path", "position", "_e.*")


def scan_archive_urls(spark: SparkSession, path: str) -> DataFrame:
    """``archive_urls`` of the ``.gz`` files below ``path``, each opened by the task that reads it."""
    return archive_urls(list_files(spark, path, "*.gz"))


def _elements(documents: DataFrame, tag: str, schema: str, column: str) -> DataFrame:
    """One row per element, parsed on its own: damage elsewhere in a document costs nothing."""
    element = rf"(?s)<(?:\w+:)?{tag}(?:\s[^>]*)?>.*?</(?:\w+:)?{tag}\s*>"
    pieces = F.regexp_extract_all(F.col(column), F.lit(element), F.lit(0))
    others = [c for c in documents.columns if c != column]
    return (
        documents.select(*others, F.posexplode(pieces).alias("position", "_piece"))
        .withColumn("_e", F.from_xml("_piece", schema, _OPTIONS))
        .select(*others, "position", "_e.*")
    )


def url_entries(documents: DataFrame, column: str = "xml") -> DataFrame:
    """loc, lastmod, news of every ``<url>`` in the documents."""
    return _elements(documents, "url", _URL_ELEMENT, column)


def index_entries(documents: DataFrame, column: str = "xml") -> DataFrame:
    """loc of every ``<sitemap>`` in the documents."""
    return _elements(documents, "sitemap", _INDEX_ELEMENT, column)


def scan_urls(spark: SparkSession, path: str) -> DataFrame:
    """Same as ``url_entries``, read by the XML source from intact files (plain or .gz)."""
    reader = spark.read.format("xml").schema(_URL_ELEMENT).option("rowTag", "url")
    return reader.options(**_OPTIONS).load(path)


def child_sitemaps(index: DataFrame) -> DataFrame:
    """Child sitemap addresses of an index."""
    return index.withColumn("loc", strip(F.col("loc"))).filter(F.col("loc") != "")


def sitemap_urls(urls: DataFrame, keep: Column | None = None) -> DataFrame:
    """Page addresses, optionally only those satisfying ``keep`` (a condition on ``loc``)."""
    addresses = urls.withColumn("loc", strip(F.col("loc"))).filter(F.col("loc") != "")
    return addresses if keep is None else addresses.filter(keep)


def _first_ten(text: Column) -> Column:
    return F.nullif(F.substring(text, 1, 10), F.lit(""))


def news_entries(urls: DataFrame) -> DataFrame:
    """(headline, source_url, date) from news metadata; rows lacking title or date are dropped."""
    date = F.coalesce(_first_ten(F.col("news.publication_date")), _first_ten(F.col("lastmod")))
    return (
        sitemap_urls(urls, is_release_url(F.col("loc")))
        .select(strip(F.col("news.title")).alias("headline"), F.col("loc").alias("source_url"), date.alias("date"))
        .filter(has_text(F.col("headline")) & F.col("date").isNotNull())
    )


def slug_entries(urls: DataFrame) -> DataFrame:
    """(headline, source_url, date) with the title derived from the URL slug."""
    return (
        sitemap_urls(urls, is_release_url(F.col("loc"), "/news-releases/"))
        .select(
            title_from_release_url(F.col("loc")).alias("headline"),
            F.col("loc").alias("source_url"),
            _first_ten(F.col("lastmod")).alias("date"),
        )
        .dropna()
    )


# How each source turns its sitemap URLs into titles; callers may add their own.
ENTRY_PARSERS = {
    "prnewswire": news_entries,
    "globenewswire": news_entries,
    "newswireca": slug_entries,
}


def validate_archives(files: DataFrame) -> DataFrame:
    """Per file: does it decompress and hold at least one press-release URL, and how many."""
    urls = archive_urls(files)
    found = (
        sitemap_urls(urls, is_release_url(F.col("loc")))
        .groupBy("path")
        .agg(F.count(F.lit(1)).alias("n_urls"))
    )
    count = F.coalesce("n_urls", F.lit(0))
    return files.select("path").join(found, "path", "left").select(
        "path", (count > 0).alias("valid"), count.alias("n_urls")
    )
