"""Fill-in-the-middle documents: prefix, middle and suffix cut between units and put in another order.

Each text is laid out in blocks of ``BLOCK`` bytes. A Fenwick tree over the blocks stores two
counts, units that end in a block and code points that start in it. The block that holds a cut is
found by binary lifting down the tree, which also sums the code points before it; the boundary
itself is then looked for inside that one block.

The cut numbers, form and order of a document come from the SHA-256 of a seed and its id, so a
rerun cuts the same. No shuffle takes place; a task holds one Arrow batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 4096
MARKERS = ("<P>", "<S>", "<M>")
SEED = 7
RATE = 100
SPM_RATE = 50

_RESULT = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"
_FIELDS = [
    ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
    ("output", pa.string()),
]


def fenwick(counts: np.ndarray) -> np.ndarray:
    """Tree over rows of counts: node i (from 1) sums the rows from i - lowbit(i) + 1 to i."""
    tree = np.zeros((len(counts) + 1, counts.shape[1]), np.int64)
    tree[1:] = counts
    step = 1
    while 2 * step <= len(counts):
        upper = tree[2 * step :: 2 * step]
        upper += tree[step :: 2 * step][: len(upper)]
        step *= 2
    return tree


def descend(tree: np.ndarray, rank: int) -> tuple[int, np.ndarray]:
    """Most leading blocks with fewer than ``rank`` units together, and their counts."""
    place, passed = 0, np.zeros(tree.shape[1], np.int64)
    step = 1 << (len(tree) - 1).bit_length()
    while step:
        ahead = place + step
        if ahead < len(tree) and passed[0] + tree[ahead, 0] < rank:
            place, passed = ahead, passed + tree[ahead]
        step >>= 1
    return place, passed


class Layout:
    """Units and code points of one text by block."""

    def __init__(self, data: np.ndarray):
        """``data`` are the UTF-8 bytes. A unit is a line with its line end, the last may lack it."""
        self.data = data
        starts = np.arange(0, len(data), BLOCK)
        ends, points = data == 10, (data & 0xC0) != 0x80
        counts = [np.add.reduceat(x, starts, dtype=np.int64) for x in (ends, points)] if len(data) else []
        self.tree = fenwick(np.stack(counts, 1) if counts else np.zeros((0, 2), np.int64))
        self.ended = int(counts[0].sum()) if counts else 0
        self.points = int(counts[1].sum()) if counts else 0
        self.units = self.ended + int(len(data) > 0 and data[-1] != 10)

    def cut(self, rank: int) -> tuple[int, int]:
        """Bytes and code points of the first ``rank`` units."""
        if rank == 0:
            return 0, 0
        if rank > self.ended:
            return len(self.data), self.points
        block, passed = descend(self.tree, rank)
        inside = self.data[block * BLOCK : (block + 1) * BLOCK]
        size = int(np.flatnonzero(inside == 10)[rank - int(passed[0]) - 1]) + 1
        points = np.count_nonzero((inside[:size] & 0xC0) != 0x80)
        return block * BLOCK + size, int(passed[1]) + points


def rearrange(raw: bytes, h: tuple[int, int, int, int], markers: tuple[bytes, ...], rate: int, spm_rate: int) -> tuple:
    """(units, form, prefix and middle code points, output) of one text."""
    layout = Layout(np.frombuffer(raw, np.uint8))
    n = layout.units
    if not raw or h[2] % 100 >= rate or any(m in raw for m in markers):
        return n, "plain", None, None, raw
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    (a, a_points), (b, b_points) = layout.cut(low), layout.cut(high)
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    p, s, m = markers
    if h[3] % 100 < spm_rate:
        return n, "spm", a_points, b_points - a_points, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", a_points, b_points - a_points, b"".join((p, prefix, s, suffix, m, middle))


def _bytes(text: pa.Array):
    """The values one by one, so that a batch's texts are not all copied at once."""
    for value in text.cast(pa.binary()):
        yield value.as_py()


def _rearranger(markers: tuple[str, ...], rate: int, spm_rate: int):
    encoded = tuple(m.encode() for m in markers)

    def rearranged(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        numbers = np.stack([h.to_numpy(zero_copy_only=False) for h in (h1, h2, h3, h4)], 1).tolist()
        rows = (
            rearrange(raw or b"", h, encoded, rate, spm_rate)
            for raw, h in zip(_bytes(text), numbers)
        )
        columns = list(zip(*rows)) or [()] * len(_FIELDS)
        arrays = [pa.array(values, pa.binary() if name == "output" else kind) for values, (name, kind) in zip(columns, _FIELDS)]
        arrays[-1] = arrays[-1].cast(pa.string())
        return pa.StructArray.from_arrays(arrays, [name for name, _ in _FIELDS])

    return F.arrow_udf(rearranged, _RESULT)


def draws(row_id: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from the hex SHA-256 of the seed, a colon and the id; a null id is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substr(digest, F.lit(1 + 8 * i), F.lit(8)), 16, 10).cast("bigint") for i in range(4)]


def check_markers(markers: tuple[str, ...]) -> None:
    """Markers must be found again in an output whose parts hold none of them: none may be empty,
    lie in another, or begin as it or another one ends."""
    for x in markers:
        for y in markers:
            overlaps = any(x.endswith(y[:k]) for k in range(1, min(len(x), len(y)) + (x != y)))
            if not x or overlaps or (x != y and x in y):
                raise ValueError(f"markers {x!r} and {y!r} can overlap")
    if len(set(markers)) != 3:
        raise ValueError("three different markers are needed")


def fill_in_middle(
    df: DataFrame, text: str = "text", row_id: str = "doc_id", *, markers: tuple[str, str, str] = MARKERS,
    rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED,
) -> DataFrame:
    """All rows with n (units), form, prefix_chars, middle_chars and output.

    Units are lines with their line ends. ``rate`` of a hundred texts are cut, ``spm_rate`` of a
    hundred of these put the suffix first. Form is ``plain`` for a text left as it is, ``psm`` for
    prefix, suffix, middle and ``spm`` for suffix, prefix, middle, each after its marker.

    Null text counts as empty; an empty text, or one that holds a marker, stays plain. Equal ids
    draw the same numbers, so repeated rows give equal results; a null id draws as an empty one.
    Input columns that bear a result's name are replaced, all others kept. An empty table gives no
    rows. Memory of a task follows the Arrow batch, or the longest text.
    """
    check_markers(markers)
    names = [name for name, _ in _FIELDS]
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in names]
    made = _rearranger(markers, rate, spm_rate)(F.coalesce(text, F.lit("")), *draws(F.col(row_id), seed))
    return df.select(*kept, made.alias("_made")).select(*kept, *[F.col(f"_made.{n}") for n in names])


def restore(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``output`` was made from, by the places of its markers."""
    p, s, m = markers

    def between(first: str | None, last: str | None) -> Column:
        start = F.locate(first, output) + len(first) if first else F.lit(1)
        stop = F.locate(last, output) if last else F.char_length(output) + 1
        return F.substr(output, start, stop - start)

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
