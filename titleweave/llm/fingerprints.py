"""Document fingerprints that tell which paragraphs of two versions differ.

A text becomes the set of 60-bit digests of its paragraphs. The fingerprint is an invertible Bloom
lookup sketch of that set: three tables of cells, and in one cell of each table a digest is added
to a count, to an exclusive or of digests and to one of their checks. Cells of two versions subtract,
which cancels what they share; a cell left with one digest gives it up, and taking it out of its
other cells frees more. If that peeling stalls, larger sketches are made: digests are dealt by
their leading bits to parts of about ``PART`` digests, each with tables of its own, and a part that stalls
again is retried with tables of twice the width under another hash.

All of it is column expressions over arrays within a row, linear in the number of paragraphs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titleweave.llm.common import SPACE_CHARS, unit
from titleweave.llm.sharding import _place, _splitters

# A paragraph is a line; a longer one is cut after the sentence that its 120th character stands in,
# and a sentence that goes on for 120 characters more after these.
PARAGRAPH = r"[^\n]{120}[^\n.!?]{0,120}[.!?]*|[^\n]+"
TABLES = 3
STORED_WIDTH = 4
PART = 4
WIDTHS = (4, 8, 16, 32, 64)

_DIGEST_BITS = 60
_CELLS = "array<struct<n:int,digest:bigint,check:bigint>>"
_SIDES = "struct<left:array<bigint>,right:array<bigint>>"
SLICE_BYTES = 8 << 20
MAX_SLICES = 1 << 16


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def digests(text: Column) -> Column:
    """Distinct digests of a text's paragraphs, in order: the first 15 hex digits of their MD5."""
    pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    bare = F.filter(F.transform(pieces, lambda p: F.btrim(p, F.lit(SPACE_CHARS))), lambda p: p != "")
    number = F.transform(bare, lambda p: F.conv(F.substr(F.md5(p), F.lit(1), F.lit(15)), 16, 10).cast("bigint"))
    return F.sort_array(F.array_distinct(number))


def _own_bits(digest: Column) -> Column:
    """Twenty bits for each table: those of the digest itself, in the stored sketch."""
    return digest


def _hashed(width: Column):
    """In larger sketches, those of a hash that differs from one width to the next."""
    return lambda digest: F.xxhash64(digest, width)


def _cell(bits: Column, table: int, width: Column) -> Column:
    return F.shiftrightunsigned(bits, 20 * table).bitwiseAND(width - 1)


def _check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(-1))


def _of(n: Column, digest: Column, check: Column) -> Column:
    return F.struct(n.alias("n"), digest.alias("digest"), check.alias("check"))


def _minus(x: Column, y: Column) -> Column:
    return _of(x["n"] - y["n"], x["digest"].bitwiseXOR(y["digest"]), x["check"].bitwiseXOR(y["check"]))


def _wide(width: Column | int) -> Column:
    return (F.lit(width) if isinstance(width, int) else width).cast("bigint")


def sketch(numbers: Column, width: Column | int = STORED_WIDTH, bits=_own_bits) -> Column:
    """Cells of an array of digests: ``TABLES`` tables of ``width`` cells, one after the other.

    ``width`` is a power of two, ``bits`` gives the sixty bits that place a digest.
    """
    width = _wide(width)
    nothing = _of(F.lit(0), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"))
    entries = F.transform(
        numbers, lambda d: F.struct(d.alias("digest"), bits(d).alias("bits"), _check(d).alias("check"))
    )

    def table_of(own: Column, table: int) -> Column:
        def add(place: Column):
            def added(cell: Column, x: Column) -> Column:
                more = _of(cell["n"] + 1, cell["digest"].bitwiseXOR(x["digest"]), cell["check"].bitwiseXOR(x["check"]))
                return F.when(_cell(x["bits"], table, width) == place, more).otherwise(cell)

            return added

        places = F.sequence(F.lit(0).cast("bigint"), width - 1)
        return F.transform(places, lambda place: F.aggregate(own, nothing, add(place)))

    return _let(entries, lambda own: F.concat(*[table_of(own, t) for t in range(TABLES)])).cast(_CELLS)


def subtract(left: Column, right: Column) -> Column:
    """What two sketches of the same width and bits do not share."""
    return F.zip_with(left, right, _minus).cast(_CELLS)


def peel(cells: Column, steps: Column, width: Column | int = STORED_WIDTH, bits=_own_bits) -> Column:
    """Digests only on the left and only on the right of a difference, or null if it cannot be undone.

    Every step takes one digest out, so ``steps`` is the number there may be.
    """
    width = _wide(width)
    none = F.array().cast("array<bigint>")
    start = F.struct(cells.alias("cells"), none.alias("left"), none.alias("right"))

    def pure(x: Column) -> Column:
        return (F.abs(x["n"]) == 1) & (_check(x["digest"]) == x["check"])

    def taken(state: Column, f: Column) -> Column:
        def without(x: Column, i: Column) -> Column:
            here = F.array_contains(f["at"], i.cast("bigint"))
            return F.when(here, _minus(x, f)).otherwise(x)

        def grown(side: str, n: int) -> Column:
            return F.when(f["n"] == n, F.array_append(state[side], f["digest"])).otherwise(state[side]).alias(side)

        left = F.transform(state["cells"], without).alias("cells")
        return F.struct(left, grown("left", 1), grown("right", -1))

    def step(state: Column, _: Column) -> Column:
        def after(found: Column) -> Column:
            def placed(b: Column) -> Column:
                at = F.array(*[_cell(b, t, width) + width * t for t in range(TABLES)])
                return F.struct(found["n"].alias("n"), found["digest"].alias("digest"), found["check"].alias("check"), at.alias("at"))

            out = _let(_let(bits(found["digest"]), placed), lambda f: taken(state, f))
            return F.when(found.isNull(), state).otherwise(out)

        return _let(F.get(F.filter(state["cells"], pure), F.lit(0)), after)

    def finish(state: Column) -> Column:
        full = F.exists(state["cells"], lambda x: (x["n"] != 0) | (x["digest"] != 0) | (x["check"] != 0))
        return F.when(~full, F.struct(state["left"].alias("left"), state["right"].alias("right")))

    counted = F.filter(F.sequence(F.lit(0), steps), lambda i: i > 0)
    return F.aggregate(counted, start, step, finish).cast(_SIDES)


def _part(left: Column, right: Column) -> Column:
    """Difference of one part, by ever wider sketches; of the arrays themselves if none can be undone."""
    exact = F.struct(F.array_except(left, right).alias("left"), F.array_except(right, left).alias("right"))

    def attempt(done: Column, w: Column) -> Column:
        apart = subtract(sketch(left, w, _hashed(w)), sketch(right, w, _hashed(w)))
        return F.coalesce(done, peel(apart, F.size(left) + F.size(right), w, _hashed(w)))

    widths = F.array(*[F.lit(w).cast("bigint") for w in WIDTHS])
    return F.aggregate(widths, F.lit(None).cast(_SIDES), attempt, lambda done: F.coalesce(done, exact.cast(_SIDES)))


def _in_parts(left: Column, right: Column) -> Column:
    """Differences of all parts of two sorted arrays of digests, put together."""
    tag = lambda side: lambda d: F.struct(d.alias("digest"), F.lit(side).alias("side"))
    both = F.sort_array(F.concat(F.transform(left, tag(0)), F.transform(right, tag(1))))

    def parts(entries: Column) -> Column:
        n = F.size(entries)
        # As many leading bits as make parts of PART digests on average.
        spare = F.lit(_DIGEST_BITS) - F.greatest(F.lit(0), F.ceil(F.log2(n / F.lit(float(PART))))).cast("int")

        def cut(numbers: Column) -> Column:
            starts = F.filter(
                F.sequence(F.lit(1), n),
                lambda i: (i == 1) | (F.element_at(numbers, i) != F.element_at(numbers, F.greatest(i - 1, F.lit(1)))),
            )

            def own(all_starts: Column):
                return lambda at, i: F.slice(entries, at, F.coalesce(F.get(all_starts, i + 1), n + 1) - at)

            return _let(starts, lambda x: F.transform(x, own(x)))

        number = lambda shift: lambda x: F.call_function("shiftrightunsigned", x["digest"], shift)
        return _let(_let(spare, lambda shift: F.transform(entries, number(shift))), cut)

    def solve(part: Column) -> Column:
        side = lambda s: F.transform(F.filter(part, lambda x: x["side"] == s), lambda x: x["digest"])
        pair = F.struct(side(0).alias("left"), side(1).alias("right"))
        return _let(pair, lambda p: _part(p["left"], p["right"]))

    def joined(found: Column) -> Column:
        return F.struct(
            F.flatten(F.transform(found, lambda x: x["left"])).alias("left"),
            F.flatten(F.transform(found, lambda x: x["right"])).alias("right"),
        )

    return _let(F.transform(_let(both, parts), solve), joined).cast(_SIDES)


def difference(left: Column, right: Column, left_sketch: Column, right_sketch: Column) -> Column:
    """struct(left, right): digests that only one of two arrays of ``digests`` has.

    The stored sketches are tried first, larger ones made only if these cannot be undone.
    """
    cells = TABLES * STORED_WIDTH
    return F.coalesce(peel(subtract(left_sketch, right_sketch), F.lit(cells)), _in_parts(left, right))


def likeness(left: Column, right: Column, found: Column) -> Column:
    """Shared part of all digests of two arrays, given their ``difference``; 1 if both are empty."""
    total = F.size(left) + F.size(right)
    apart = _let(found, lambda x: F.size(x["left"]) + F.size(x["right"]))
    return F.when(total == 0, F.lit(1.0)).otherwise(_let(apart, lambda n: (total - n) / F.greatest(total + n, F.lit(1))))


def as_text(text: Column, cells: Column) -> Column:
    """The stored form: half the text's MD5, then count and digests of every cell in hex."""
    each = F.transform(cells, lambda x: F.concat(F.lower(F.hex(x["n"])), F.lit(":"), F.lower(F.hex(x["digest"]))))
    return F.concat(F.substr(F.md5(F.coalesce(text, F.lit(""))), F.lit(1), F.lit(16)), F.lit("-"), F.array_join(each, ","))


def with_fingerprint(df: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """All rows with digests, sketch and fingerprint of a text column.

    Null text counts as empty: no digests and an empty sketch. Equal texts have equal fingerprints,
    repeated rows are kept. Input columns that bear a result's name are replaced; ``prefix`` goes
    before the results' names.
    """
    names = [f"{prefix}{n}" for n in ("digests", "sketch", "fingerprint")]
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names or c == text]
    return (
        df.select(*kept, digests(F.col(text)).alias(names[0]))
        .select("*", sketch(F.col(names[0])).alias(names[1]))
        .select("*", as_text(F.col(text), F.col(names[1])).alias(names[2]))
    )


def _slices(df: DataFrame, slice_bytes: int) -> tuple[DataFrame, list]:
    """Rows (key, digest, text) with ``slice``, consecutive by key; and the last row of each slice."""
    sized = df.withColumn("size", (F.octet_length("text") + 1).cast("bigint"))
    total = sized.agg(F.sum("size")).first()[0] or 0
    n = min(MAX_SLICES, max(1, -(-total // slice_bytes)))
    splitters = _splitters(sized, "key", "size", unit("key"), total, n, 64) if n > 1 else []
    placed = _place(df, "key", "slice", splitters)
    last = placed.groupBy("slice").agg(F.max(F.struct("key", "digest")).alias("last")).collect()
    return placed, sorted((r["slice"], r["last"]["key"], r["last"]["digest"]) for r in last)


def with_next(df: DataFrame, text: str = "text", row_id: str = "doc_id", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """row_id, text, digests and sketch of every row, and as next_ those of the row with the next smaller id.

    After the smallest id comes the largest. Rows of equal ids follow by the hash of their texts;
    null ids are the smallest, null texts empty. Texts are shuffled once, into slices of consecutive ids;
    the last row of a slice is also sent to the slice after it. At most ``MAX_SLICES`` of these reach
    the driver.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(
        F.col(row_id).alias("id"), F.coalesce(F.col(row_id).cast("bigint"), F.lit(-(2**63))).alias("key"),
        F.xxhash64(whole).alias("digest"), whole.alias("text"),
    )
    placed, last = _slices(rows, slice_bytes)
    after = [x[0] for x in last[1:] + last[:1]]
    sent = df.sparkSession.createDataFrame(
        [(key, digest, to) for (_, key, digest), to in zip(last, after)], "key bigint, digest bigint, also int"
    )
    homes = F.array_compact(F.array(
        F.struct("slice", F.lit(False).alias("copy")),
        F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("slice"), F.lit(True).alias("copy"))),
    ))
    spread = (
        placed.join(F.broadcast(sent), ["key", "digest"], "left")
        .select("id", "key", "digest", "text", F.explode(homes).alias("home"))
        .select("id", "key", "digest", "text", "home.slice", "home.copy")
    )
    order = Window.partitionBy("slice").orderBy(F.desc("copy"), "key", "digest")
    return (
        spread.repartition("slice")
        .withColumn("digests", digests(F.col("text")))
        .withColumn("sketch", sketch(F.col("digests")))
        .withColumns({f"next_{c}": F.lag(c).over(order) for c in ("text", "digests", "sketch")})
        .where("not copy")
        .select(
            F.col("id").alias(row_id), F.col("text").alias(text), "digests", "sketch", "next_text", "next_digests", "next_sketch"
        )
    )
