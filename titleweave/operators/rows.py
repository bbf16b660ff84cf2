"""Row-level building blocks shared by the other operators."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from titleweave.session import broadcast_if_small, stage


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of each key. Spark trims every map task to ``n`` rows per key before
    the shuffle (WindowGroupLimit), so a key with very many rows stays cheap."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def attach(df: DataFrame, facts: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join per-key ``facts`` back to the rows, null keys included. ``facts`` has one row per
    key, so a hot key is skewed on the row side only, where adaptive execution can split it."""
    renamed = [F.col(k).alias(f"_r_{k}") for k in keys]
    right = facts.select(*renamed, *[c for c in facts.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return df.join(right, on, how).drop(*[f"_r_{k}" for k in keys])


def attach_group_facts(df: DataFrame, facts: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``attach`` for aggregates of ``df`` itself: when they are few enough to broadcast, the
    rows are not shuffled a second time."""
    return attach(df, broadcast_if_small(facts), keys, how)


# Rows of a slice, about: what one task sorts and walks through.
SLICE_ROWS = 1_000_000
# Parts of one table at most. Larger tables get larger parts; a part is sorted with spill.
MAX_PARTS = 1 << 16


def _parts(df: DataFrame, order: list[Column], slice_rows: int, label: str) -> tuple[DataFrame, int]:
    """``df`` cut into parts consecutive along ``order``, with ``_part`` and ``_place`` (from 0 in a part).

    Staged, as the cut points must not move between the passes over it or under a retry. The number
    of parts follows the rows, one plan for all sizes; a part has a million rows or more, however
    small the slices are that are then cut within it, as each is a task and a file.
    """
    n = min(max(-(-df.count() // max(slice_rows, SLICE_ROWS)), 1), MAX_PARTS)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    # The upper 31 bits of this number are the partition, the lower 33 the row's place in it.
    number = ranged.withColumn("_place", F.monotonically_increasing_id())
    cut = number.withColumns({
        "_part": F.shiftright("_place", 33).cast("int"), "_place": F.col("_place").bitwiseAND((1 << 33) - 1)
    })
    return stage(cut, label), n


def running_totals(
    df: DataFrame, keys: list[str], order: list[Column], totals: dict[str, Column], slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Inclusive running sums within ``keys`` along ``order``, which must be total.

    Sums run inside slices consecutive along keys and order, so a hot key is never confined to one
    task; the slices' own totals, at most one row per slice and key, supply the offsets.
    """
    parts, _ = _parts(df, [*[F.col(k) for k in keys], *order], slice_rows, "running")
    within_part = F.expr(f"_place div {slice_rows}")
    sliced = parts.withColumn("_slice", F.shiftleft(F.col("_part").cast("bigint"), 33) + within_part).drop("_part")
    group = [*keys, "_slice"]
    inside = Window.partitionBy(*group).orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy(*group)
        .agg(*[F.sum(value).alias(f"_s_{name}") for name, value in totals.items()])
        .select(*group, *[F.sum(f"_s_{name}").over(earlier).alias(f"_o_{name}") for name in totals])
    )
    within = sliced.withColumns({f"_w_{name}": F.sum(x).over(inside) for name, x in totals.items()})
    result = {name: F.col(f"_w_{name}") + F.coalesce(f"_o_{name}", F.lit(0)) for name in totals}
    return attach(within, offsets, group, "inner").withColumns(result).select(*df.columns, *totals)


def number_rows(
    df: DataFrame, keys: list[str], order: list[Column], name: str = "row", slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """1-based position of each row within ``keys`` along ``order``, as one column more."""
    one = F.lit(1).cast("bigint")
    return running_totals(df, keys, order, {name: one}, slice_rows)


def over_slices(
    df: DataFrame, order: list[Column], halo: int, columns: Callable[[WindowSpec], dict[str, Column]],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Window columns that look at most ``halo`` rows back along ``order``, without a window over all rows.

    Slices of ``slice_rows`` rows are cut by row number from the staged parts. Each gets a copy of the
    ``halo`` rows before its first, from as many earlier slices as hold them. ``columns`` makes the columns from a window; frames may start ``halo`` rows back.
    """
    parts, n = _parts(df, order, slice_rows, "slices")
    rows_in = {r[0]: r[1] for r in parts.groupBy("_part").agg(F.count(F.lit(1))).collect()}  # a row per part
    first = [0]
    for at in range(n):
        first.append(first[-1] + rows_in.get(at, 0))
    start = F.split(F.lit(",".join(map(str, first))), ",").cast("array<bigint>")
    numbered = parts.withColumn("_row", F.col("_place") + F.element_at(start, F.col("_part") + 1))
    # Rows are numbered without gaps, so slices are cut by number; few rows have a later one within reach.
    home, last = F.expr(f"_row div {slice_rows}"), F.expr(f"(_row + {halo}) div {slice_rows}")
    within = F.least(last, F.lit((first[-1] - 1) // slice_rows).cast("bigint"))
    copies = numbered.withColumn("_slice", home).withColumn("_target", F.explode(F.sequence(home, F.greatest(home, within))))
    window = Window.partitionBy("_target").orderBy("_row")
    found = columns(window)
    return copies.withColumns(found).where("_target = _slice").select(*df.columns, *found)


def rows_not_in(left: DataFrame, right: DataFrame, ignore: list[str] | None = None) -> DataFrame:
    """Rows of ``left`` absent from ``right``, null-safe on all columns, duplicates kept.

    ``ignore`` names columns of ``left`` that are not compared, such as a row number.
    """
    columns = [c for c in left.columns if c not in (ignore or [])]
    other = right.select(*[F.col(c).alias(f"_r_{c}") for c in columns]).distinct()
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns])
    return left.join(other, on, "left_anti")


def merge_stats(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """One row of counts and ratios describing how the distinct keys of two tables overlap."""
    flags = left.select(*on, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*on, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    keys = flags.groupBy(*on).agg(F.max("l").alias("l"), F.max("r").alias("r"))
    counts = keys.agg(
        F.count(F.lit(1)).alias("union"),
        F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("intersection"),
        F.coalesce(F.sum("l"), F.lit(0)).alias("left"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right"),
    )
    u, i, nl, nr = (F.col(c) for c in ("union", "intersection", "left", "right"))
    return counts.select(
        u.alias("union"),
        i.alias("intersection"),
        (u - i).alias("union-intersection"),
        F.try_divide(i, u).alias("intersection/union"),
        nl.alias("left"),
        nr.alias("right"),
        (nl - i).alias("left-intersection"),
        (nr - i).alias("right-intersection"),
        F.try_divide(i, nl).alias("intersection/left"),
        F.try_divide(i, nr).alias("intersection/right"),
    )


def freq_counts(
    df: DataFrame, column: str, with_count: bool = True, with_cum_freq: bool = True
) -> DataFrame:
    """Value counts, most frequent first, with percentage and running percentage.

    Null counts as a value. The running sum works on exact counts, so it ends at 100.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    result = counts
    if with_cum_freq:
        keyed = counts.withColumn("_all", F.lit(0))
        order = [F.col("count").desc(), F.col(column).asc_nulls_first()]
        result = running_totals(keyed, ["_all"], order, {"_running": F.col("count")}).drop("_all")
    result = result.withColumn("freq", F.col("count") / total * 100)
    if with_cum_freq:
        result = result.withColumn("cum_freq", F.col("_running") / total * 100).drop("_running")
    result = result.orderBy(F.col("count").desc(), F.col(column).asc_nulls_first())
    return result if with_count else result.drop("count")


def move_columns_to_front(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns, *[c for c in df.columns if c not in columns])


def fill_zero(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.fill(0, columns)


def map_values(column: Column, names: dict[str, str], default: str = "Unknown") -> Column:
    """Replace by dictionary; anything else becomes ``default``."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), F.lit(default))
