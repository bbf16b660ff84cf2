"""Best counterpart of every title within its block, by token-sort similarity.

The result equals scoring all pairs of a block and keeping the best one, but pairs are never
materialised:

1. Titles become sorted-token keys once per row. Right keys whose length no left key of the block
   can reach are dropped before anything is shuffled; equal keys of a block are folded together,
   so a title copied a million times is scored once. Only the columns that order right rows travel
   with the keys; the rest is joined to the matches at the end.
2. Equal keys score 100 and cannot be beaten: the same grouping that folds the keys settles
   those rows.
3. The rest is laid out in tiles of about ``tile_rows`` keys, consecutive by length and number of
   vowels within a block and side, and in larger bins of about ``BIN_BYTES`` along the same order. A zone
   map holds each bin's least and largest length and letter sums, and two bins meet only if some
   pair in these bounds could reach the score: keys are copied once per bin, whatever the tiles. The
   work of one task does not grow with the size of a hot block.
4. Where two bins meet, one task (``functions.nearest``) leaves out tiles by the same bounds, holds the
   rest of the pairs against a bound by letter counts and scores what passes. ``min`` of a struct keeps
   the best per key with map-side combining.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from titleweave.functions import nearest, similarity, text
from titleweave.session import hint_if_small, stage

EXACT_SCORE = 100.0
SUMS = [f"_s{i}" for i in range(len(similarity.LETTER_GROUPS) + 1)]
# Part of a title looked at first, as a multiple of the longest key within reach; any value gives the same rows.
BEGINNING = 1.5


def _within_reach(rows: DataFrame, column: str, other: DataFrame, min_score: float) -> DataFrame:
    """Rows whose key, made of ``column``, can reach the score with some key length of ``other``.

    Sorting its words keeps a title's length, so only rows within reach are sorted. A normalised title
    begins with its normalised beginning: a long one is ruled out by that alone.
    """
    length = F.length("_key")
    found = other.agg(F.min(length).alias("low"), F.max(length).alias("high")).first()
    if found.low is None:
        return rows.limit(0)
    low = math.ceil(similarity.length_reach(min_score, found.low)[0])
    high = math.floor(similarity.length_reach(min_score, found.high)[1])
    start = F.substring(F.col(column), 1, int(BEGINNING * high) + 1)
    begins = F.length(text.normalize_title(start)) <= high
    # One comparison: a filter makes the title anew for each of two.
    middle = F.length(text.normalize_title(F.col(column))) * 2 - (low + high)
    return rows.where(begins).where(F.abs(middle) <= high - low)


def _fold_titles(left: DataFrame, right: DataFrame, block: str, first: list[str]) -> DataFrame:
    """One row per (block, _key): is it wanted on the left, and the first right row with it."""
    nothing = F.lit(None).cast(right.select(F.struct(*first)).schema[0].dataType)
    wanted = left.select(block, "_key", F.lit(True).alias("_wanted"), nothing.alias("_match"))
    offered = right.select(block, "_key", F.lit(False).alias("_wanted"), F.struct(*first).alias("_match"))
    return (
        wanted.unionByName(offered)
        .groupBy(block, "_key")
        .agg(F.max("_wanted").alias("_wanted"), F.min("_match").alias("_match"))
    )


def with_tiles(keys: DataFrame, block: str, tile_rows: int) -> DataFrame:
    """Keys with their side, measures, ``_tile`` and ``_bin``, consecutive by length and vowels in a block and side.

    Keys of equal length and vowels are one cell; cells are counted, and a key's place within its
    cell is drawn by its hash, so that no block is ever sorted. A tile has about ``tile_rows``
    keys, a bin about ``BIN_BYTES``.
    """
    cell = [block, "_offered", "_len", SUMS[0]]
    measured = keys.withColumns({"_len": F.length("_key"), **dict(zip(SUMS, similarity.letter_sums("_key")))})
    before = Window.partitionBy(*cell[:2]).orderBy(*cell[2:]).rowsBetween(Window.unboundedPreceding, -1)
    width = F.col("_len").cast("bigint") + KEY_BYTES
    cells = measured.groupBy(*cell).agg(F.count(F.lit(1)).alias("_n"))
    cells = cells.withColumns({
        "_before": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        "_bytes": F.coalesce(F.sum(F.col("_n") * width).over(before), F.lit(0)),
    })
    drawn = F.pmod(F.xxhash64("_key", F.lit(1)), F.col("_n"))
    placed = measured.join(hint_if_small(stage(cells, "cells")), cell)
    return placed.withColumns({
        "_tile": F.floor((F.col("_before") + drawn) / tile_rows).cast("int"),
        "_bin": F.floor((F.col("_bytes") + drawn * width) / BIN_BYTES).cast("int"),
    }).drop("_n", "_before", "_bytes")


def zone_map(keys: DataFrame, block: str) -> DataFrame:
    """Number and bytes of keys, least and largest length and letter sums of every bin."""
    bounds = [f(c).alias(f"{c}_{x}") for c in ("_len", *SUMS) for x, f in (("min", F.min), ("max", F.max))]
    size = F.sum(F.col("_len").cast("bigint") + KEY_BYTES).alias("_bytes")
    return keys.groupBy(block, "_offered", "_bin").agg(F.count(F.lit(1)).alias("_keys"), size, *bounds)


def bin_pairs(zones: DataFrame, block: str, min_score: float) -> DataFrame:
    """Pairs of bins (block, _left, _right), numbered by ``_pair``, of which some pair of keys may reach
    the score, the number of pairs of keys (``_pairs``) that meet there and their ``_bytes``."""
    sides = []
    for which, side in (("not _offered", "l"), ("_offered", "r")):
        named = [F.col(c).alias(f"{side}{c}") for c in zones.columns if c not in (block, "_offered")]
        sides.append(zones.where(which).select(block, *named))
    met = sides[0].join(sides[1], block).where(F.expr(similarity.zones_may_reach(min_score, SUMS)))
    return met.select(
        F.monotonically_increasing_id().alias("_pair"), block, F.col("l_bin").alias("_left"), F.col("r_bin").alias("_right"),
        (F.col("l_keys") * F.col("r_keys")).alias("_pairs"), (F.col("l_bytes") + F.col("r_bytes")).alias("_bytes"),
    )


# What a key takes beside its characters, and the size of a bin: some 16,000 keys of 60 characters.
KEY_BYTES = 64
BIN_BYTES = 2 << 20
# Pairs of keys that one task goes through, about a second of work, and bytes that it holds.
PAIRS_PER_TASK = 25_000_000
BYTES_PER_TASK = 32 << 20


def _met_keys(
    keys: DataFrame, block: str, min_score: float, carry: list[str], tile_rows: int, partitions: int | None
) -> tuple[DataFrame, DataFrame]:
    """Both sides of the bins that meet, dealt to tasks by ``_task``: a copy of a key per bin that its own meets."""
    tiled = with_tiles(keys.filter("_offered or _wanted"), block, tile_rows)
    pairs = stage(bin_pairs(zone_map(tiled, block), block, min_score), "bin-pairs")
    # A fixed partition number: adaptive coalescing looks at bytes, but the cost of these
    # tasks is the number of pairs of keys, and few bytes can mean many pairs.
    work = pairs.agg(F.sum("_pairs"), F.sum("_bytes")).first()
    shuffles = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = partitions or max(shuffles, -(-(work[0] or 0) // PAIRS_PER_TASK), -(-(work[1] or 0) // BYTES_PER_TASK))
    dealt = pairs.withColumn("_task", F.pmod(F.xxhash64("_pair"), F.lit(n)).cast("int")).drop("_pairs", "_bytes")
    dealt = hint_if_small(dealt)
    sides = []
    for which, own, extra in (("not _offered", "_left", [block]), ("_offered", "_right", carry)):
        side = tiled.where(which).withColumnRenamed("_bin", own).join(dealt, [block, own])
        # Aliases, as both sides come from one table.
        columns = [F.col(c).alias(c) for c in ("_task", "_pair", "_tile", "_len", "_key", *extra)]
        sides.append(side.select(*columns).repartition(n, "_task"))
    return sides[0], sides[1]


def _in_bins(left: pa.Table, right: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, nearest.Side, nearest.Side]]:
    """Row numbers and keys of the two sides of each pair of bins in a task."""
    sides = []
    for rows in (left, right):
        pair, tile, length = (rows.column(c).to_numpy() for c in ("_pair", "_tile", "_len"))
        order = np.lexsort((length, tile, pair))
        numbers, starts = np.unique(pair[order], return_index=True)
        sides.append((rows.column("_key"), tile, order, dict(zip(numbers.tolist(), np.split(order, starts[1:])))))
    for pair, own in sides[0][3].items():
        other = sides[1][3].get(pair)
        if other is not None:
            made = [nearest.Side(side[0].take(pa.array(at)).to_pylist(), side[1][at]) for side, at in zip(sides, (own, other))]
            yield own, other, *made


def _best_of(min_score: float, block: str, carry: list[str]):
    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        nothing = np.zeros(0, np.int64)
        found = [(nothing, nothing, np.zeros(0))]
        for own, other, a, b in _in_bins(left, right):
            i, j, score, _, _ = nearest.best_partners(a, b, min_score)
            found.append((own[i], other[j], score))
        i, j, score = (np.concatenate(c) for c in zip(*found))
        mine, theirs = left.select([block, "_key"]).take(pa.array(i)), right.select(["_key", *carry]).take(pa.array(j))
        return pa.table([*mine.columns, *theirs.columns, pa.array(score)], [block, "l_key", "r_key", *carry, "_score"])

    return best


def best_pairs(
    keys: DataFrame,
    block: str,
    min_score: float,
    carry: list[str],
    tile_rows: int = 1024,
    partitions: int | None = None,
) -> DataFrame:
    """block, l_key, r_key, ``carry`` columns of the right, _score: for each left key, the pairs that tie for
    the best of any two bins, if that reaches the score.

    ``keys`` has ``block``, ``_key`` and the flags ``_wanted`` (left) and ``_offered`` (right).
    Lossless: a pair is left out only if a proven upper bound of its score is too low or another
    partner scores higher. Left keys that are also offered are settled and take no part.
    """
    left, right = _met_keys(keys, block, min_score, carry, tile_rows, partitions)
    schema = left.select(block, F.col("_key").alias("l_key")).schema.fields
    schema += right.select(F.col("_key").alias("r_key"), *carry).schema.fields + [StructField("_score", DoubleType())]
    best = _best_of(min_score, block, carry)
    return left.groupBy("_task").cogroup(right.groupBy("_task")).applyInArrow(best, StructType(schema))


def _payload_of(matches: DataFrame, right: DataFrame, block: str, right_text: str, order: list[str]) -> DataFrame:
    """Whole right rows of matches, found by the columns that order them and by their key."""
    payload = [c for c in right.columns if c != block]
    first = [*order, *[c for c in payload if c not in order]]
    named = [F.col(f"_match.{c}").alias(f"_m{i}") for i, c in enumerate(order)]
    wanted = matches.select(F.col(block).alias("_b"), F.col("_found"), *named)
    same = [F.col(block) == F.col("_b"), *[F.col(c).eqNullSafe(F.col(f"_m{i}")) for i, c in enumerate(order)]]
    # Not an equality that the join could take for a key: that would normalise every right row again.
    same.append(F.coalesce(_title_key(right_text) == F.col("_found"), F.lit(False)))
    rows = right.join(hint_if_small(wanted), reduce(lambda x, y: x & y, same))
    whole = rows.groupBy(block, "_found", *[f"_m{i}" for i in range(len(order))]).agg(F.min(F.struct(*first)).alias("_row"))
    keep = whole.select(block, "_found", F.col("_row"), F.struct(*[F.col(f"_m{i}").alias(c) for i, c in enumerate(order)]).alias("_match"))
    return matches.join(keep, [block, "_found", "_match"])


def _count_pairs(min_score: float):
    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        counts = [nearest.best_partners(a, b, min_score)[3:] for _, _, a, b in _in_bins(left, right)]
        met, scored = (pa.array([sum(c)], pa.int64()) for c in zip(*counts, (0, 0)))
        return pa.table({"met": met, "scored": scored})

    return count


def pair_survey(folded: DataFrame, block: str, min_score: float, tile_rows: int = 1024) -> DataFrame:
    """One row for keys of ``fold_keys``: pairs within blocks, pairs in tiles that meet, and pairs
    within all bounds, which are the ones scored."""
    flagged = folded.select(block, "_key", "_wanted", F.col("_match").isNotNull().alias("_offered"))
    sides = F.count_if(F.expr("_wanted and not _offered")), F.count_if("_offered")
    total = flagged.groupBy(block).agg((sides[0] * sides[1]).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("all_pairs"))
    left, right = _met_keys(flagged, block, min_score, [], tile_rows, None)
    counted = left.groupBy("_task").cogroup(right.groupBy("_task")).applyInArrow(_count_pairs(min_score), "met bigint, scored bigint")
    return total.join(counted.agg(
        F.coalesce(F.sum("met"), F.lit(0)).alias("met_pairs"), F.coalesce(F.sum("scored"), F.lit(0)).alias("scored_pairs")
    ))  # one row each


def _title_key(column: str) -> Column:
    return text.token_sort_key(text.normalize_title(F.col(column)))


def fold_keys(
    left: DataFrame, right: DataFrame, *, block: str, left_text: str, right_text: str, right_order: list[str],
    min_score: float,
) -> DataFrame:
    """Staged distinct keys of each block: ``_wanted`` on the left, first ``_match`` on the right."""
    # A key is null only if its title is.
    left = left.where(F.col(block).isNotNull() & F.col(left_text).isNotNull())
    right = right.where(F.col(block).isNotNull() & F.col(right_text).isNotNull())
    wanted = stage(left.select(block, _title_key(left_text).alias("_key")), "wanted-keys")
    offered = _within_reach(right, right_text, wanted, min_score)
    offered = offered.select(block, _title_key(right_text).alias("_key"), *right_order)
    return stage(_fold_titles(wanted, offered, block, right_order), "folded-titles")


def fuzzy_best_match(
    left: DataFrame,
    right: DataFrame,
    *,
    block: str,
    left_text: str,
    right_text: str,
    right_order: list[str],
    min_score: float = 80.0,
    tile_rows: int = 1024,
    partitions: int | None = None,
) -> DataFrame:
    """Each left row with its best right row in the same block, if it scores ``min_score``.

    ``right_order`` breaks ties, ascending; it should identify a right row. Apart from
    ``block`` the two sides must not share column names. Result: the left columns, the right
    columns and ``fuzzy_score``; a left row appears at most once.

    Keys, tiles and matches feed several later stages and are written to the shared folder, which
    runs jobs while the plan is built.
    """
    payload = [c for c in right.columns if c != block]
    folded = fold_keys(
        left, right, block=block, left_text=left_text, right_text=right_text, right_order=right_order, min_score=min_score
    )
    exact = folded.filter("_wanted and _match is not null").select(
        block, "_key", F.col("_key").alias("_found"), "_match", F.lit(EXACT_SCORE).alias("fuzzy_score")
    )
    order = {f"_o{i}": F.col(f"_match.{c}") for i, c in enumerate(right_order)}
    flagged = folded.withColumns({"_offered": F.col("_match").isNotNull(), **order}).drop("_match")
    pairs = best_pairs(flagged, block, min_score, list(order), tile_rows, partitions)
    ranking = F.struct((-F.col("_score")).alias("loss"), *order, F.col("r_key").alias("other"))
    match = F.struct(*[F.col(f"_rank.{o}").alias(c) for o, c in zip(order, right_order)])
    fuzzy = (
        pairs.groupBy(block, F.col("l_key").alias("_key"))
        .agg(F.min(ranking).alias("_rank"))
        .select(block, "_key", F.col("_rank.other").alias("_found"), match.alias("_match"), (-F.col("_rank.loss")).alias("fuzzy_score"))
    )
    matches = _payload_of(stage(exact.unionByName(fuzzy), "matches"), right, block, right_text, right_order)
    # A hot title makes this join skewed on the left; adaptive execution splits it there.
    keyed = left.withColumn("_key", _title_key(left_text))
    return keyed.join(matches.select(block, "_key", "_row", "fuzzy_score"), [block, "_key"]).select(
        *left.columns, *[F.col(f"_row.{c}").alias(c) for c in payload], "fuzzy_score"
    )
