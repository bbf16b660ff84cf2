"""Near duplicates by SimHash fingerprints and a byte-position inverted index.

A fingerprint is eight positional bytes. Two fingerprints that differ in at most four bits share
at least four of them, so each such pair meets in a posting list. Lists of single bytes would
hold 1/256 of all fingerprints each and their pairs grow with the square of the input; lists
are therefore kept for triples of positions. The twenty triples are chosen so that any four
positions contain one: no pair is missed. Within a list the shared bytes of a pair are tallied,
pairs with four or more are verified on their bits.

Equal fingerprints are folded first. A list with more than ``TILE`` members is cut into tiles of
two blocks each. A tile gives back a spanning forest of its links, not its pairs: enough to keep
every component, and linear in the members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from titleweave.llm.common import free_name, stage
from titleweave.llm.components import components

SHINGLE = 4
SEED = 42
MOST_BITS = 4
LEAST_BYTES = 8 - MOST_BITS
TILE = 2048
_RUN = 1 << 18
_LAST_ID = 2**63 - 1


def position_triples() -> list[tuple[int, int, int]]:
    """Triples of the eight positions such that any four positions contain one.

    Three groups of positions in a ring; a triple lies in one group, or has two in a group and
    one in the next.
    """
    groups = ((0, 1, 2), (3, 4, 5), (6, 7))
    found = [t for g in groups for t in combinations(g, 3)]
    for g, after in zip(groups, groups[1:] + groups[:1]):
        found += [(a, b, c) for a, b in combinations(g, 2) for c in after]
    return found


def _shingle_hashes(text: bytes) -> list[int]:
    parts = text.lower().split()
    if not parts:
        return []
    joined = b" ".join(parts)
    if len(parts) <= SHINGLE:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - SHINGLE].tolist(), ends[SHINGLE - 1 :].tolist())]


def _majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of hashes; empty groups give zero.

    Bits are counted eight at a time: one byte of a 64-bit number counts one bit of up to 255 hashes.
    """
    out = np.zeros(len(counts), np.uint64)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    filled = np.flatnonzero(counts)
    if not len(filled):
        return out
    pieces = -(-counts[filled] // 255)
    first = np.concatenate([[0], np.cumsum(pieces)])
    within = np.arange(first[-1]) - np.repeat(first[:-1], pieces)
    cuts = np.repeat(bounds[filled], pieces) + within * 255
    ones = np.uint64(0x0101010101010101)
    for bit in range(8):
        counted = np.add.reduceat((hashes >> np.uint64(bit)) & ones, cuts)
        per_byte = np.add.reduceat(counted.view(np.uint8).reshape(-1, 8).astype(np.int64), first[:-1], axis=0)
        wins = (2 * per_byte > counts[filled][:, None]).astype(np.uint8)
        out[filled] |= np.ascontiguousarray(wins).view(np.uint64).reshape(-1) << np.uint64(bit)
    return out


def fingerprint_texts(texts: pa.Array) -> np.ndarray:
    """Unsigned fingerprints; null and blank texts have zero."""
    done: list[np.ndarray] = []
    hashes: list[int] = []
    counts: list[int] = []

    def flush() -> None:
        done.append(_majority(np.array(hashes, np.uint64), np.array(counts, np.int64)))
        hashes.clear()
        counts.clear()

    for text in texts:
        value = text.as_py()
        own = _shingle_hashes(value.encode()) if value else []
        hashes += own
        counts.append(len(own))
        if len(hashes) >= _RUN:
            flush()
    flush()
    return np.concatenate(done)


@F.arrow_udf(LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    return pa.array(fingerprint_texts(texts).view(np.int64))


def _postings(prints: DataFrame) -> DataFrame:
    """fp -> (key, fp) for each triple of positions; the key holds the triple and its bytes."""

    def byte(i: int) -> Column:
        return F.shiftrightunsigned(F.col("fp"), 8 * i).bitwiseAND(F.lit(255))

    keys = [
        F.lit(n << 24) + F.shiftleft(byte(a), 16) + F.shiftleft(byte(b), 8) + byte(c)
        for n, (a, b, c) in enumerate(position_triples())
    ]
    return prints.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _tiles(postings: DataFrame) -> DataFrame:
    """(key, lo, hi, fp): members of lists that hold a pair, in tiles of at most two blocks."""
    lists = postings.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    blocks = F.ceil(F.col("n") / TILE)
    member = postings.join(lists, "key").withColumn("blocks", blocks)
    member = member.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return member.select("key", "fp", "own", other.alias("other")).select(
        "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"
    )


def _linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of fingerprints (a down, b across) share enough bytes and differ in few bits."""
    differ = a[:, None] ^ b[None, :]
    shared = (differ.view(np.uint8).reshape(len(a), len(b), 8) == 0).sum(axis=2, dtype=np.uint8)
    return (shared >= LEAST_BYTES) & (np.bitwise_count(differ) <= MOST_BITS)


def spanning_links(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest with the same components as all links among distinct fingerprints."""
    left, right = [], []
    open_ = prints
    while len(open_) > 1:
        front, open_ = open_[:1], open_[1:]
        while len(front) and len(open_):
            reached = np.zeros(len(open_), bool)
            for at in range(0, len(front), 64):
                waiting = np.flatnonzero(~reached)
                if not len(waiting):
                    break
                part = front[at : at + 64]
                hit = _linked(part, open_[waiting])
                some = hit.any(axis=0)
                left.append(part[hit.argmax(axis=0)[some]])
                right.append(open_[waiting[some]])
                reached[waiting[some]] = True
            front, open_ = open_[reached], open_[~reached]
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _small_lists(starts: np.ndarray, sizes: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All links of many lists of one small size at once."""
    left, right = [], []
    for size in np.unique(sizes):
        rows = prints[starts[sizes == size][:, None] + np.arange(size)]
        for i, j in combinations(range(size), 2):
            a, b = rows[:, i], rows[:, j]
            differ = np.ascontiguousarray(a ^ b)
            shared = (differ.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
            hit = (shared >= LEAST_BYTES) & (np.bitwise_count(differ) <= MOST_BITS)
            left.append(a[hit])
            right.append(b[hit])
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def _link_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists arrive in order; the last one of a batch may go on in the next."""
    names = ("key", "lo", "hi", "fp")
    held = [np.empty(0, np.int64)] * 4

    def work(columns: list[np.ndarray]) -> pa.RecordBatch | None:
        if not len(columns[0]):
            return None
        new = np.ones(len(columns[0]), bool)
        new[1:] = False
        for c in columns[:3]:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(new)))
        prints = columns[3].view(np.uint64)
        few = (sizes > 1) & (sizes <= 8)
        pairs = [_small_lists(starts[few], sizes[few], prints)]
        for start, size in zip(starts[sizes > 8], sizes[sizes > 8]):
            pairs.append(spanning_links(np.unique(prints[start : start + size])))
        u = np.concatenate([p[0] for p in pairs]).view(np.int64)
        v = np.concatenate([p[1] for p in pairs]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    for batch in batches:
        now = [np.concatenate([h, batch.column(n).to_numpy()]) for h, n in zip(held, names)]
        if not len(now[0]):
            continue
        same = (now[0] == now[0][-1]) & (now[1] == now[1][-1]) & (now[2] == now[2][-1])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        held = [c[cut:] for c in now]
        out = work([c[:cut] for c in now])
        if out is not None:
            yield out
    out = work(held)
    if out is not None:
        yield out


def links(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) that join the same fingerprints as all true links do."""
    tiles = _tiles(_postings(prints)).repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi")
    return tiles.mapInArrow(_link_lists, "u bigint, v bigint")


def _grouped(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """doc_id, digest (of the text), fp, root (fingerprint of the component), least (smallest id in it)."""
    rows = stage(
        df.select(
            F.col(row_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("digest"),
            fingerprint(F.col(text)).alias("fp"),
        ),
        "fingerprints",
    )
    own = F.coalesce(F.col("doc_id"), F.lit(_LAST_ID))
    prints = stage(rows.groupBy("fp").agg(F.min(own).alias("first")), "distinct-fingerprints")
    roots = stage(components(links(prints.select("fp"))), "roots")
    rooted = prints.join(roots, prints.fp == roots.node).select("fp", "root", "first")
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    moved = rooted.join(least, "root").select(F.col("fp").alias("moved"), "root", "least")
    named = prints.join(moved, F.col("fp") == F.col("moved"), "left").select(
        F.col("fp").alias("print"), F.coalesce("root", "fp").alias("root"), F.coalesce("least", "first").alias("least")
    )
    # From a table both sides of the join are plain exchanges, so a fingerprint of many rows can be split.
    named = stage(named, "named-fingerprints")
    return rows.join(named, F.col("fp") == F.col("print")).drop("print")


def near_groups(df: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, component_id for every row: the smallest id reachable over links of few bits.

    Blank and null texts share fingerprint zero and link like any other. Repeated rows keep their
    rows; a null id counts as larger than any other, and a component of null ids only has a null
    component. An empty table gives no rows.
    """
    found = _grouped(df, row_id, text)
    return found.select("doc_id", "fp", F.nullif(F.col("least"), F.lit(_LAST_ID)).alias("component_id"))


def keep_one(df: DataFrame, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``df`` for each component: that of its smallest id, ties by the text's hash. Same columns.

    A component of null ids only keeps one row too; of fully repeated rows one stays.
    """
    digest, head, its_text = (free_name(df, n) for n in ("text_digest", "head_id", "head_text"))
    own = F.struct(F.coalesce("doc_id", F.lit(_LAST_ID)).alias("id"), "digest")
    heads = _grouped(df, row_id, text).groupBy("root").agg(F.min(own).alias("h")).select(
        F.nullif(F.col("h.id"), F.lit(_LAST_ID)).alias(head), F.col("h.digest").alias(its_text)
    )
    with_digest = df.withColumn(digest, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    is_head = F.col(row_id).eqNullSafe(F.col(head)) & (F.col(digest) == F.col(its_text))
    return with_digest.join(heads, is_head, "left_semi").dropDuplicates([row_id, digest]).select(*df.columns)
