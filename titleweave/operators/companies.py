"""Index constituents and company names inside titles."""

from __future__ import annotations

import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleweave.functions.text import normalize_company
from titleweave.operators.rows import first_per_key
from titleweave.session import stage

MIN_NAME_LENGTH = 5


def constituents_with_names(spells: DataFrame, names: DataFrame) -> DataFrame:
    """Membership spells x name periods, joined on the security only; spells without a name stay."""
    return spells.join(names, "permno", "left")


def names_lookup(constituents: DataFrame, min_length: int = MIN_NAME_LENGTH) -> DataFrame:
    """Distinct (permno, comnam, ticker, comnam_norm); short names match far too much.

    A fixed partition number for the normaliser: adaptive coalescing looks at bytes, but its cost
    is a search at every word. A filter on its result would be pushed below the exchange and
    normalise twice, so names are dropped as the elements of an array.
    """
    n = int(constituents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    long_enough = F.filter(F.array(normalize_company(F.col("comnam"))), lambda name: F.length(name) >= min_length)
    return (
        constituents.filter(F.col("comnam").isNotNull())
        .select("permno", "comnam", "ticker")
        .distinct()
        .repartition(n, "permno", "comnam", "ticker")
        .select("permno", "comnam", "ticker", F.explode(long_enough).alias("comnam_norm"))
    )


def _finder(names: list[str]):
    """A trie with failure links over the first ``ANCHOR`` characters of all names.

    Behind each anchor stand its names by length, so that names with a common beginning cost one
    look-up per length and not one each.
    """
    import ahocorasick

    trie = ahocorasick.Automaton()
    for name in names:
        anchor = name[:ANCHOR]
        if anchor not in trie:
            trie.add_word(anchor, (len(anchor), {}))
        trie.get(anchor)[1].setdefault(len(name), set()).add(name)
    by_length = {anchor: (n, sorted(known.items(), reverse=True)) for anchor, (n, known) in trie.items()}
    for anchor, entry in by_length.items():
        trie.add_word(anchor, entry)
    trie.make_automaton()

    def find(title: str) -> tuple[int, str] | None:
        """Place (from 1) and name of the leftmost hit, there the longest; linear in the title's length."""
        best = None
        for end, (width, known) in trie.iter(title):
            start = end - width + 1
            if best is not None and end - ANCHOR + 1 > best[0]:
                break  # nothing that ends here or later can begin earlier
            if best is not None and start > best[0]:
                continue
            for length, own in known:
                if best is not None and start == best[0] and length <= len(best[1]):
                    break
                if title[start : start + length] in own:
                    best = (start, title[start : start + length])
                    break
        return None if best is None else (best[0] + 1, best[1])

    return find


def _find_names(titles: pa.Table, names: pa.Table) -> pa.Table:
    """Best hit of every title of a slice among the names of a part."""
    found = []
    if titles.num_rows and names.num_rows:
        find = _finder(names.column("comnam_norm").to_pylist())
        for title in titles.column("_norm").to_pylist():
            hit = find(title)
            if hit is not None:
                found.append((title, *hit))
    columns = list(zip(*found)) or [(), (), ()]
    kinds = (pa.string(), pa.int32(), pa.string())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], ["_norm", "_start", "comnam_norm"])


# Characters of a name that the trie spells out, and text that meets in one task: a slice of titles
# and a part of the names, whose trie takes some fifty bytes a character.
ANCHOR = 16
PART_BYTES = 4 << 20
SLICE_BYTES = 32 << 20


def title_company_match(
    titles: DataFrame, lookup: DataFrame, title: str = "headline", min_length: int = MIN_NAME_LENGTH,
    part_bytes: int = PART_BYTES, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """Titles that contain a company name, with the leftmost and there the longest hit.

    Substring containment without word boundaries. Equal titles are folded first, and each is
    looked up once. Names are cut into parts and titles into slices of bounded size; each slice
    meets each part in one task, which reads its titles through one automaton over all names of the
    part. Names longer than the longest title take no part.
    """
    keyed = titles.withColumn("_norm", normalize_company(F.col(title)))
    norms = stage(keyed.select("_norm").distinct().filter(F.length("_norm") >= min_length), "titles")
    longest, size = norms.agg(F.max(F.length("_norm")), F.sum(F.octet_length("_norm"))).first()
    # Staged before the filter, which would otherwise normalise every name once more.
    known = stage(lookup.select("comnam_norm", "comnam", "permno", "ticker"), "lookup")
    names = first_per_key(
        known.filter(F.length("comnam_norm").between(min_length, longest or 0)),
        ["comnam_norm"],
        [F.col("permno"), F.col("comnam"), F.col("ticker")],
    ).select("comnam_norm", F.col("comnam").alias("matched_company"), "permno", "ticker")
    names = stage(names, "names")
    name_size = names.agg(F.sum(F.octet_length("comnam_norm"))).first()[0]
    parts, slices = (max(1, -(-(n or 0) // limit)) for n, limit in ((name_size, part_bytes), (size, slice_bytes)))

    def number(column: str, n: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(n).cast("bigint"))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    left = norms.select("_norm", number("_norm", slices).alias("slice"), each(parts).alias("part"))
    right = names.select("comnam_norm", number("comnam_norm", parts).alias("part"), each(slices).alias("slice"))
    hits = left.groupBy("part", "slice").cogroup(right.groupBy("part", "slice")).applyInArrow(
        _find_names, "_norm string, _start int, comnam_norm string"
    )
    rank = F.struct("_start", (-F.length("comnam_norm")).alias("_shorter"), "comnam_norm")
    best = hits.groupBy("_norm").agg(F.min(rank).alias("_hit")).select("_norm", F.col("_hit.comnam_norm").alias("comnam_norm"))
    named = best.join(names, "comnam_norm").select("_norm", "matched_company", "permno", "ticker")
    return keyed.join(named, "_norm").drop("_norm")
