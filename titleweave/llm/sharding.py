"""Shards of near-equal bytes by sampled splitters.

The range key is the hash of the text, so equal texts are neighbours. Keys are drawn with a
chance in proportion to their size; quantiles of the draws cut the key space into cells; bytes
and rows of each cell are then counted exactly. A cell far above its share is subdivided: a text whose
rows alone are more than a cell gets cells of its own, by the hash of the row's id, and the rest
of the range is cut by a second hash of the text. Whole cells are dealt to shards by their exact
bytes, the largest first, each to the shard with most room.

Only splitters, texts heavier than a cell and cell totals reach the driver; their number is
``shards * cells_per_shard`` times a small constant, whatever the input.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titleweave.llm.common import free_name, unit


def _place(df: DataFrame, key: str, out: str, splitters: list[int]) -> DataFrame:
    """Number of splitters at or below ``key``, by a binary search in generated code."""
    steps = 1
    while (1 << steps) - 1 < len(splitters):
        steps += 1
    padded = splitters + [2**63 - 1] * ((1 << steps) - 1 - len(splitters))
    table = _ints(padded, "bigint")
    df = df.withColumn(out, F.lit(0))
    for step in reversed(range(steps)):
        here = F.col(out) + (1 << step)
        above = F.element_at(table, here.cast("int")) <= F.col(key)
        df = df.withColumn(out, F.when(above, here).otherwise(F.col(out)).cast("int"))
    # Padding equals the largest key; a row there belongs to the last true cell.
    return df.withColumn(out, F.least(F.col(out), F.lit(len(splitters))))


def _splitters(df: DataFrame, key: str, size: str, chance: Column, total: int, cells: int, draws: int) -> list[int]:
    """Quantiles of keys drawn in proportion to size: about ``draws`` for each cell."""
    step = max(total / (cells * draws), 1.0)
    times = F.floor(F.col(size) / step + chance).cast("int")
    drawn = (
        df.select(F.col(key).alias("k"), times.alias("n"))
        .where("n > 0")
        .select("k", F.explode(F.array_repeat(F.lit(0), F.col("n"))))
    )
    at = [i / cells for i in range(1, cells)]
    found = drawn.agg(F.percentile_approx("k", at, 20 * cells).alias("q")).first()["q"]
    return sorted(set(found or []))


def shard_by_bytes(
    df: DataFrame,
    shards: int = 16,
    text: str = "text",
    row_id: str = "doc_id",
    cells_per_shard: int = 64,
    draws_per_cell: int = 64,
) -> DataFrame:
    """All rows with ``size``, ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in a shard).

    Size is the UTF-8 bytes of the text plus 1. Shards differ by about one cell, a
    ``1 / cells_per_shard`` part of a shard; more only if single rows are larger than a shard.
    Equal texts share a shard unless together they are more than a cell.

    Null text counts as empty; null ids are one id; fully equal rows cannot be told apart and
    stay in one cell; an empty table gives no rows. Input columns called size, shard or slot are
    replaced, all others are kept.
    """
    kept = [c for c in df.columns if c.lower() not in ("size", "shard", "slot")]
    key, chance, cell, part = (free_name(df, n) for n in ("shard_key", "shard_chance", "shard_cell", "shard_part"))
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = df.select(
        *[F.col(c) for c in kept],
        (F.octet_length(whole) + 1).cast("bigint").alias("size"),
        F.xxhash64(whole).alias(key),
        unit(F.coalesce(F.col(row_id), F.lit(-1)), whole).alias(chance),
    )
    total = keyed.agg(F.sum("size")).first()[0] or 0
    cells = shards * cells_per_shard
    splitters = _splitters(keyed, key, "size", F.col(chance), total, cells, draws_per_cell)
    placed = _place(keyed, key, cell, splitters)

    goal = max(total / cells, 1.0)
    light = Counter({r[0]: r[1] for r in placed.groupBy(cell).agg(F.sum("size")).collect()})
    # Fewer texts than ``cells``, as each is more than one cell's share.
    sums = keyed.groupBy(key).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"))
    heavy = sorted(tuple(r) for r in sums.where(F.col("size") > goal).collect())
    for k, size, _ in heavy:
        light[min(bisect_right(splitters, k), len(splitters))] -= size
    parts = [math.ceil(light[c] / goal) if light[c] > 2 * goal else 1 for c in range(len(splitters) + 1)]
    parts += [min(n, math.ceil(size / goal)) for _, size, n in heavy]
    first = [0]
    for n in parts:
        first.append(first[-1] + n)
    keys = [k for k, *_ in heavy]
    placed = _place(placed, key, part, keys)
    below = F.col(part)
    own = (below > 0) & (F.element_at(_ints(keys or [0], "bigint"), F.greatest(below, F.lit(1))) == F.col(key))
    at = F.when(own, below + len(splitters) + 1).otherwise(F.col(cell) + 1).cast("int")
    spread = F.when(own, F.col(chance)).otherwise(unit(F.col(key), F.lit(1)))
    inner = F.floor(spread * F.element_at(_ints(parts), at))
    placed = placed.withColumn(part, (F.element_at(_ints(first[:-1]), at) + inner).cast("int"))

    facts = {r[0]: (r[1], r[2]) for r in placed.groupBy(part).agg(F.sum("size"), F.count("*")).collect()}
    shard_of, offset_of, rows_in = [0] * first[-1], [0] * first[-1], [0] * shards
    room = [(0, shard) for shard in range(shards)]
    for p in sorted(facts, key=lambda p: (-facts[p][0], p)):
        filled, shard = heapq.heappop(room)
        shard_of[p], offset_of[p] = shard, rows_in[shard]
        rows_in[shard] += facts[p][1]
        heapq.heappush(room, (filled + facts[p][0], shard))
    order = Window.partitionBy(part).orderBy(key, chance, F.col(row_id).asc_nulls_last())
    spot = (F.col(part) + 1).cast("int")
    return placed.select(
        *[F.col(c) for c in kept],
        "size",
        F.element_at(_ints(shard_of), spot).alias("shard"),
        (F.element_at(_ints(offset_of, "bigint"), spot) + F.row_number().over(order) - 1).cast("bigint").alias("slot"),
    )


def _ints(values: list[int], kind: str = "int") -> Column:
    """A constant array; one text that the optimizer folds, as a literal for each entry is slow to analyse."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")
