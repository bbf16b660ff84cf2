"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; target over size is the expected number of copies of
each of its documents. The whole part of that number is taken as it is. The fractions are
rounded together: two documents transfer words between them, in a random direction with odds
that keep both expectations, until one fraction is 0 or 1, and the other goes on. The words of a
source so stay at their target up to the last open document.

Documents are paired within small chunks of a source; what each chunk leaves open is paired
again with its neighbours', level by level, so that no task ever sees a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titleweave.llm.common import free_name, stage, unit, word_count
from titleweave.session import broadcast_if_small

WEIGHTS = (5, 2, 1)
FAN_IN = 16


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size -> also ``target``: weights repeat over sources in code point order, null last.

    ``share`` times all words are dealt by weight; no source gets more than ``cap`` times its
    size, and the excess is dealt again among the others. That fixed point is one level ``l``
    with ``target = min(cap * size, weight * l)``, found by running sums over the sources in the
    order in which they reach their cap. One row per source: a small table, whatever the input.
    """
    everything = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("n", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("n") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(cap))
    ranked = ranked.withColumn("reach", F.col("most") / F.col("weight"))
    by_reach = everything.orderBy("reach", "n")
    spent = F.coalesce(F.sum("most").over(by_reach.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_reach.rowsBetween(0, Window.unboundedFollowing))
    goal = F.sum("source_size").over(everything) * F.lit(share)
    leveled = ranked.withColumn("level", (goal - spent) / rest)
    settled = F.when(F.col("level") <= F.col("reach"), F.struct("reach", "n", "level"))
    chosen = F.min(settled).over(everything)["level"]
    return leveled.select(
        "source", "source_size", F.least("most", F.coalesce(F.col("weight") * chosen, F.col("most"))).alias("target")
    )


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, though it is named more than once."""
    return F.transform(F.array(value), use)[0]


def _snap(p: Column) -> Column:
    return F.when(p < 1e-9, 0.0).when(p > 1 - 1e-9, 1.0).otherwise(p)


def _meet(state: Column, b: Column) -> Column:
    """One pivotal step: the open unit of a chunk meets the next one, and one of them closes."""
    a = state["unit"]
    gains = F.struct(
        F.least((1 - a["p"]) * a["size"], b["p"] * b["size"]).alias("a"),
        F.least(a["p"] * a["size"], (1 - b["p"]) * b["size"]).alias("b"),
        unit(a["row"], b["row"], F.lit("pair")).alias("draw"),
    )

    def moved(g: Column) -> Column:
        return F.when(g["draw"] * (g["a"] + g["b"]) < g["b"], g["a"]).otherwise(-g["b"])

    def after(words: Column) -> Column:
        return F.struct(
            a.withField("p", _snap(a["p"] + words / a["size"])).alias("a"),
            b.withField("p", _snap(b["p"] - words / b["size"])).alias("b"),
        )

    def close(x: Column) -> Column:
        first = x["a"]["p"].isin(0.0, 1.0)
        return F.struct(
            F.when(first, x["b"]).otherwise(x["a"]).alias("unit"),
            F.concat(state["done"], F.array(F.when(first, x["a"]).otherwise(x["b"]))).alias("done"),
        )

    return _let(_let(_let(gains, moved), after), close)


def _fold(units: Column) -> Column:
    """Pair a chunk's units one after another: struct(unit = the one left open, done = all others)."""
    start = F.struct(units[0].alias("unit"), F.slice(units, 1, 0).alias("done"))
    return F.aggregate(F.slice(units, 2, F.greatest(F.size(units) - 1, F.lit(0))), start, _meet)


def mix_counts(df: DataFrame, row_id: str = "doc_id", source: str = "source", text: str = "text",
               weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """One row per distinct row of ``df``: id, row (digest), source, size, rows, copies, source_size, target.

    ``rows`` counts fully equal rows of ``df``, ``copies`` is what the mix takes of them all
    together. Documents without words get the rounded-down number of copies. Null text has no
    words; a null source is a source; null ids are allowed. An empty table gives no rows. The
    same rows always give the same mix.
    """
    digest = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    rows = stage(
        df.select(
            F.col(row_id).alias("id"), digest.alias("row"), F.col(source).alias("source"),
            word_count(F.col(text)).alias("size"),
        )
        .groupBy("id", "row", "source", "size")
        .agg(F.count("*").alias("rows")),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("units")
    )
    targets = source_targets(sizes.drop("units"), weights, share, cap).join(
        sizes.select(F.col("source").alias("s"), "units"), F.col("source").eqNullSafe(F.col("s"))
    ).drop("s")
    facts = broadcast_if_small(targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    expected = rate * F.col("rows")
    joined = rows.join(facts.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    joined = joined.withColumn("whole", F.floor(expected + 1e-9)).withColumn(
        "p", F.greatest(expected - F.col("whole"), F.lit(0.0))
    )
    joined = joined.withColumn("p", F.when((F.col("size") == 0) | (F.col("p") < 1e-9), 0.0).otherwise(F.col("p")))
    names = ["id", "row", "size", "rows", "whole", "p"]
    most = joined.where("p > 0").agg(F.max("units")).first()[0] or 0
    done = [joined.where("p = 0").select("source", *names)]
    chunks = F.greatest(F.ceil(F.col("units") / FAN_IN), F.lit(1))
    level = joined.where("p > 0").select(
        "source", F.pmod(F.xxhash64("row", "id"), chunks).alias("chunk"), F.struct(*names).alias("unit")
    )
    width = -(-most // FAN_IN)
    while most:
        order = F.array_sort(F.collect_list("unit"), _by_size)
        folded = stage(
            level.groupBy("source", "chunk").agg(order.alias("units")).select(
                "source", "chunk", _fold(F.col("units")).alias("f")
            ),
            "mix-level",
        )
        done.append(folded.select("source", F.explode("f.done").alias("u")).select("source", *[f"u.{n}" for n in names]))
        left = folded.select("source", F.col("chunk"), F.col("f.unit").alias("unit"))
        if width <= 1:
            done.append(left.select("source", *[f"unit.{n}" for n in names]))
            break
        width = -(-width // FAN_IN)
        level = left.withColumn("chunk", F.floor(F.col("chunk") / FAN_IN))
    rounded = done[0]
    for more in done[1:]:
        rounded = rounded.unionByName(more)
    # At most one document of a source is still open: the nearer whole number.
    copies = (F.col("whole") + F.round("p")).cast("bigint")
    taken = rounded.select("source", "id", "row", "size", "rows", copies.alias("copies"))
    return (
        taken.join(facts.drop("units").withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
    )


def _by_size(a: Column, b: Column) -> Column:
    """Larger documents first, then a fixed order."""
    return (
        F.when(a["size"] > b["size"], -1).when(a["size"] < b["size"], 1)
        .when(a["row"] < b["row"], -1).when(a["row"] > b["row"], 1)
        .when(F.coalesce(a["id"], F.lit(-1)) < F.coalesce(b["id"], F.lit(-1)), -1)
        .when(F.coalesce(a["id"], F.lit(-1)) > F.coalesce(b["id"], F.lit(-1)), 1)
        .otherwise(0)
    )


def taken_per_row(counts: DataFrame) -> DataFrame:
    """``mix_counts`` back to one row for each row of the input, with ``taken`` words."""
    each = counts.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    own = F.floor(F.col("copies") / F.col("rows")) + (F.col("k") <= F.col("copies") % F.col("rows")).cast("bigint")
    return each.withColumn("taken", (own * F.col("size")).cast("bigint")).drop("k")


def mix(df: DataFrame, row_id: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mixed rows themselves: every row of ``df`` as often as the mix takes it, same columns."""
    counts = mix_counts(df, row_id, source, text, **options)
    row, copies, its_id, its_row = (free_name(df, n) for n in ("mix_row", "mix_copies", "mix_id", "mix_digest"))
    digest = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    once = df.withColumn(row, digest).dropDuplicates([row_id, row])
    take = counts.where("copies > 0").select(
        F.col("id").alias(its_id), F.col("row").alias(its_row), F.col("copies").alias(copies)
    )
    joined = once.join(take, F.col(row_id).eqNullSafe(F.col(its_id)) & (F.col(row) == F.col(its_row)))
    return joined.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*df.columns)
