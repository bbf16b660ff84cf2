"""Weighted statistics and lags on (id, date, value) panels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from titleweave.operators.rows import SLICE_ROWS, attach_group_facts, over_slices, running_totals
from titleweave.session import stage


def weighted_average(df: DataFrame, value: str, weight: str, name: str = "weighted_average") -> DataFrame:
    """One row: sum(w x) / sum(w)."""
    x, w = F.col(value), F.col(weight)
    return df.agg(F.try_divide(F.sum(x * w), F.sum(w)).alias(name))


def group_weighted_average(
    df: DataFrame, value: str, weight: str, by: list[str], name: str = "weighted_average"
) -> DataFrame:
    """sum(w x) / sum(w where x is present) per group; rows with a null group key are dropped."""
    x, w = F.col(value), F.col(weight)
    present = F.when(x.isNotNull(), w)
    return (
        df.dropna(subset=by).groupBy(*by).agg(F.try_divide(F.sum(x * w), F.sum(present)).alias(name))
    )


def with_group_weighted_average(
    df: DataFrame, value: str, weight: str, by: list[str], name: str
) -> DataFrame:
    """The grouped average next to every row; null for rows without a group key."""
    return attach_group_facts(df, group_weighted_average(df, value, weight, by, name), by)


def group_weighted_std(
    df: DataFrame, value: str, weight: str, by: list[str], ddof: int = 1, name: str = "weighted_std"
) -> DataFrame:
    """Weighted standard deviation per group.

    The denominator is (n - ddof) / n * sum(w) with n the number of values, zero-weight rows
    included. Two passes (mean first), so that large values do not cancel.
    """
    rows = df.select(*by, value, weight).dropna()
    means = group_weighted_average(rows, value, weight, by, "_mean")
    x, w, n = F.col(value), F.col(weight), F.count(F.lit(1))
    spread = F.sum(w * (x - F.col("_mean")) * (x - F.col("_mean")))
    scale = (n - ddof) / n * F.sum(w)
    return (
        attach_group_facts(rows, means, by, "inner")
        .groupBy(*by)
        .agg(F.sqrt(F.try_divide(spread, scale)).alias(name))
    )


def weighted_quantiles(
    df: DataFrame,
    value: str,
    weight: str | None,
    quantiles: dict[str, float],
    by: list[str] | None = None,
    old_style: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Interpolated weighted quantiles, one column per entry of ``quantiles``.

    Rows sorted by (value, weight) sit at p = (running weight - w / 2) / total weight;
    ``old_style`` stretches p to start at 0 and end at 1. A run of equal values is flat, so
    only its two end points matter: rows fold into one per distinct value before anything is
    sorted, and the running weight never needs one task for a large group (``running_totals``).
    """
    keys = by or ["_all"]
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.withColumn("_all", F.lit(0)) if not by else df
    points = stage(
        rows.select(*keys, F.col(value).cast("double").alias("_v"), w.alias("_w"))
        .dropna()
        .groupBy(*keys, "_v")
        .agg(F.sum("_w").alias("_sum"), F.min("_w").alias("_first"), F.max("_w").alias("_last")),
        "points",
    )
    summary = points.groupBy(*keys).agg(
        F.sum("_sum").alias("_total"),
        F.min(F.struct("_v", "_first"))["_first"].alias("_head"),
        F.max(F.struct("_v", "_last"))["_last"].alias("_tail"),
    )
    upto = {"_upto": F.col("_sum")}
    running = running_totals(points, keys, [F.col("_v")], upto, slice_rows)
    low = F.col("_upto") - F.col("_sum") + F.col("_first") / 2
    high = F.col("_upto") - F.col("_last") / 2
    if old_style:
        start = F.col("_head") / 2
        width = F.col("_total") - F.col("_tail") / 2 - start
    else:
        start, width = F.lit(0.0), F.col("_total")

    def position(weight_below: Column) -> Column:
        # A single point has no width; it answers every quantile.
        return F.coalesce(F.try_divide(weight_below - start, width), F.lit(0.0))

    curve = attach_group_facts(running, summary, keys, "inner").select(
        *keys, F.col("_v"), position(low).alias("_low"), position(high).alias("_high")
    )
    v, lo, hi = F.col("_v"), F.col("_low"), F.col("_high")
    # Values rise along the curve, so a neighbour's position and value are plain extremes.
    neighbours = {}
    for name, q in quantiles.items():
        neighbours[f"_bp_{name}"] = F.max(F.when(hi <= q, hi).when(lo <= q, lo))
        neighbours[f"_bv_{name}"] = F.max(F.when(lo <= q, v))
        neighbours[f"_ap_{name}"] = F.min(F.when(lo > q, lo).when(hi > q, hi))
        neighbours[f"_av_{name}"] = F.min(F.when(hi > q, v))

    def between(name: str, q: float) -> Column:
        bp, bv, ap, av = (F.col(f"_{part}_{name}") for part in ("bp", "bv", "ap", "av"))
        inner = bv + F.try_divide(F.lit(q) - bp, ap - bp) * (av - bv)
        return F.coalesce(inner, bv, av).alias(name)

    measures = [measure.alias(name) for name, measure in neighbours.items()]
    return curve.groupBy(*keys).agg(*measures).select(
        *(by or []), *[between(name, q) for name, q in quantiles.items()]
    )


def rolling_mean(
    df: DataFrame, order: str, columns: dict[str, str], window: int, min_periods: int | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Mean of the last ``window`` rows along ``order``; null until ``min_periods`` (default: all) are there.

    Rows are cut into slices along ``order``; a slice gets copies of the ``window - 1`` rows before it.
    """
    needed = min_periods or window

    def means(rows: WindowSpec) -> dict[str, Column]:
        frame = rows.rowsBetween(-(window - 1), 0)
        return {
            name: F.when(F.count(c).over(frame) >= needed, F.avg(c).over(frame))
            for name, c in columns.items()
        }

    return over_slices(df, [F.col(order)], window - 1, means, slice_rows)


def weighted_quantile_series(
    df: DataFrame,
    date: str,
    value: str,
    weight: str,
    percentiles: tuple[float, float] = (0.25, 0.75),
    window: int | None = None,
    min_periods: int | None = None,
    rescale: float = 1.0,
) -> DataFrame:
    """Per-date weighted median with a lower and an upper percentile, optionally smoothed."""
    wanted = {"median": 0.5, "lower": percentiles[0], "upper": percentiles[1]}
    series = weighted_quantiles(df, value, weight, wanted, [date])
    if window:
        series = rolling_mean(series, date, {name: name for name in wanted}, window, min_periods)
    return series.select(date, *[(F.col(name) * rescale).alias(name) for name in wanted])


def lag_by_id(
    df: DataFrame, ids: list[str], order: list[str], columns: list[str], lags: int = 1,
    prefix: str = "L", slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Value ``lags`` rows earlier within the id, in row order; null where an id is null.

    Rows are cut into slices along id and order, each with copies of the ``lags`` rows before it,
    so an id with very many rows is spread over tasks. The row that many places back counts if it
    has the same id: rows of one id are neighbours.
    """

    def lagged(rows: WindowSpec) -> dict[str, Column]:
        same = reduce(lambda a, b: a & b, [F.col(c) == F.lag(c, lags).over(rows) for c in ids])
        return {f"{prefix}{lags}_{c}": F.when(same, F.lag(c, lags).over(rows)) for c in columns}

    places = [F.col(c) for c in [*ids, *order]]
    return over_slices(df, places, lags, lagged, slice_rows)


# Calendar frequencies by name. Unit of one period, whether it is labelled by its last
# day, and whether a label on a weekend moves into the period's nearest working day.
_FREQUENCIES = {
    "us": ("microsecond", False),
    "ms": ("millisecond", False),
    "s": ("second", False),
    "min": ("minute", False),
    "h": ("hour", False),
    "D": ("day", False),
    "B": ("business day", False),
    "W": ("week", True),
    "MS": ("month", False),
    "ME": ("month", True),
    "QS": ("quarter", False),
    "QE": ("quarter", True),
    "YS": ("year", False),
    "YE": ("year", True),
    "BMS": ("month", False, True),
    "BME": ("month", True, True),
    "BQS": ("quarter", False, True),
    "BQE": ("quarter", True, True),
    "BYS": ("year", False, True),
    "BYE": ("year", True, True),
}
# Other names of the same frequencies.
_ALIASES = {
    "S": "s", "T": "min", "H": "h", "L": "ms", "U": "us", "M": "ME", "Q": "QE", "A": "YE", "Y": "YE", "AS": "YS",
    "BM": "BME", "BQ": "BQE", "BA": "BYE", "BY": "BYE", "BAS": "BYS",
}
_SECONDS = {"microsecond": 0.000001, "millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600}
_DAYS = {"day": 1, "week": 7}
_MONTHS = {"month": 1, "quarter": 3, "year": 12}
_SOME_MONDAY = "1970-01-05"


def _period_start(moment: Column, unit: str) -> Column:
    if unit in _SECONDS:
        return F.date_trunc(unit, moment)
    if unit == "business day":  # Saturday and Sunday belong to Friday
        return F.date_sub(moment, F.greatest(F.weekday(moment) - 4, F.lit(0)))
    return moment if unit == "day" else F.trunc(moment, unit)


def _period_moved(start: Column, unit: str, periods: int) -> Column:
    if unit in _SECONDS:
        seconds = F.lit(f"{periods * _SECONDS[unit]:.6f}").cast("decimal(18,6)")
        shift = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
        return start + shift
    if unit in _DAYS:
        return F.date_add(start, periods * _DAYS[unit])
    if unit == "business day":
        monday = F.lit(_SOME_MONDAY).cast("date")
        week = F.floor(F.datediff(start, monday) / 7)
        working = week * 5 + F.weekday(start) + periods
        return F.date_add(monday, (F.floor(working / 5) * 7 + F.pmod(working, F.lit(5))).cast("int"))
    return F.add_months(start, periods * _MONTHS[unit])


def lag_on_calendar(
    df: DataFrame, column: str, id_column: str, date: str = "date", lags: int = 1,
    freq: str = "MS", prefix: str = "L", order: list[str] | None = None,
) -> DataFrame:
    """Value of the period ``lags`` periods earlier, where gaps in the calendar stay gaps.

    Every id is seen on the calendar from the first to the last period of the whole panel; a
    period holds its last non-null value; rows of one instant go by the ``order`` columns, nulls
    first, then by the value, the greatest last, so it never depends on how rows are stored. A period appears in the result when its own date
    was observed or its lagged value exists. That is a full outer join of the observed rows
    with the period values moved forward, so the id x period grid is never built.
    """
    unit, at_end, working = (*_FREQUENCIES[_ALIASES.get(freq, freq)], False)[:3]
    moment = F.col(date).cast("timestamp") if unit in _SECONDS else F.to_date(date)
    start = _period_start(moment, unit)

    def label(start: Column) -> Column:
        if at_end:
            last = F.date_sub(_period_moved(start, unit, 1), 1)
            return _period_start(last, "business day") if working else last
        if working:  # Saturday and Sunday go on to Monday
            return F.date_add(start, F.pmod(7 - F.weekday(start), F.lit(7)) * (F.weekday(start) > 4).cast("int"))
        return start

    last_period = df.agg(F.max(start)).scalar()
    name = f"{prefix}{lags}_{column}"
    held = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(id_column).alias("_id"), start.alias("_start"))
        .agg(F.max_by(column, F.struct(date, *(order or []), column)).alias(name))
        .withColumn("_start", _period_moved(F.col("_start"), unit, lags))
        .filter(F.col("_start") <= last_period)
        .select("_id", label(F.col("_start")).alias("_label"), name)
    )
    observed = df.filter(moment == label(start))
    merged = observed.join(held, (F.col(id_column) == F.col("_id")) & (moment == F.col("_label")), "full")
    filled = {
        id_column: F.coalesce(id_column, "_id"),
        date: F.coalesce(F.col(date), F.col("_label").cast(df.schema[date].dataType)),
    }
    return merged.withColumns(filled).drop("_id", "_label").dropna("all", subset=[column, name])


def leave_one_out_sums(df: DataFrame, by: list[str], column: str, name: str) -> DataFrame:
    """Sum of the row's group minus its own value; null for rows without a group key."""
    sums = df.dropna(subset=by).groupBy(*by).agg(F.sum(column).alias("_sum"))
    return attach_group_facts(df, sums, by).withColumn(name, F.col("_sum") - F.col(column)).drop("_sum")
