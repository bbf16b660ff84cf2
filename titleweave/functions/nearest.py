"""Best partners of many keys among many others, by token-sort similarity, in numpy.

All pairs of two bins of keys are held against proven bounds; what may reach the score is scored.

* Keys come in tiles consecutive by length and vowels. Tiles whose length and letter sums are too
  far apart are left out.
* Letter counts are written in unary: one 0/1 column for "at least k times c". Columns in which two
  keys differ never exceed the insertions and deletions between them, whichever columns are
  taken, so the bound of all pairs is one matrix product. The columns that tell the sides apart best are taken.
* Pairs that pass run through the bit-parallel recurrence together and are dropped once the
  characters left cannot make up for those missed: with r characters of the right key left, at most
  r are still to be matched, and what matched before ends r places before the end of the left key
  or loses as many matches there.

A left key's own best score so far is its threshold, so partners found early spare later ones.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from titleweave.functions.similarity import _LONG, _SLACK, _symbols, LETTER_GROUPS, lcs_length_long

# Symbols counted on their own (rarer ones share a column), levels and columns of the unary code.
_COUNTED = 64
_LEVELS = 64
COLUMNS = 192
# Keys, and characters, of the blocks whose pairs are held against the bound at once.
_LEFT_ROWS, _RIGHT_ROWS = 1024, 2048
_BLOCK_CHARACTERS = 1 << 20
# Pairs scored at once, and the parts of the longer key after which hopeless ones are dropped.
_SCORED = 1 << 15
_LOOKS = (0.3, 0.4, 0.5, 0.6, 0.75, 0.9)
# Masks of the first 0 to 64 bits.
_BELOW = np.array([(1 << bits) - 1 for bits in range(65)], dtype=np.uint64)


def _blocks(length: np.ndarray, rows: int) -> list[tuple[int, int]]:
    """Runs of keys (sorted by tile) of bounded number, characters and, beyond 64, spread of lengths."""
    found, start = [], 0
    while start < len(length):
        part = length[start : start + rows]
        low, high = np.minimum.accumulate(part), np.maximum.accumulate(part)
        fits = ((high + 1) * np.arange(1, len(part) + 1) <= _BLOCK_CHARACTERS) & (high <= 2 * low + 64)
        size = len(part) if fits.all() else max(1, int(np.argmin(fits)))
        found.append((start, start + size))
        start += size
    return found


@dataclass
class Side:
    """Keys of one bin, in the order of their tiles."""

    keys: list[str]
    tile: np.ndarray
    length: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.length = np.array([len(k) for k in self.keys], dtype=np.int64)
        self.owner, self.place, point = _symbols(self.keys)
        self.points, self.symbol = np.unique(point, return_inverse=True)
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        groups = np.full(len(self.points), len(LETTER_GROUPS))
        for i, group in enumerate(LETTER_GROUPS):
            groups[np.isin(self.points, [ord(c) for c in group])] = i
        width = len(LETTER_GROUPS) + 1
        sums = np.bincount(self.owner * width + groups[self.symbol], minlength=len(self.keys) * width)
        #: length and letter sums of each key, which bound a tile
        self.measures = np.column_stack([self.length, sums.reshape(-1, width)])

    def counts(self, counted: np.ndarray) -> np.ndarray:
        """Occurrences of the ``counted`` code points (sorted) in each key, and of all others."""
        at = np.minimum(np.searchsorted(counted, self.points), len(counted) - 1)
        column = np.where(counted[at] == self.points, at, len(counted))
        width = len(counted) + 1
        found = np.bincount(self.owner * width + column[self.symbol], minlength=len(self.keys) * width)
        return np.minimum(found.reshape(-1, width), _LEVELS)

    def codes(self, lo: int, hi: int, points: np.ndarray) -> np.ndarray:
        """Number of each character among ``points`` (sorted), a row a place; one more than there are for others."""
        at = np.minimum(np.searchsorted(points, self.points), max(len(points) - 1, 0))
        known = points[at] == self.points if len(points) else np.zeros(len(self.points), bool)
        number = np.where(known, at, len(points))
        span = slice(self.first[lo], self.first[hi])
        out = np.full((int(self.length[lo:hi].max(initial=0)), hi - lo), len(points), dtype=np.int64)
        out[self.place[span], self.owner[span] - lo] = number[self.symbol[span]]
        return out

    def zones(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tile number of each key of a block from 0, keys, least and largest measures of each tile."""
        starts = np.flatnonzero(np.diff(self.tile[lo:hi], prepend=-1))
        number = np.cumsum(np.bincount(starts, minlength=hi - lo)) - 1
        part = self.measures[lo:hi]
        return number, np.diff(starts, append=hi - lo), np.minimum.reduceat(part, starts), np.maximum.reduceat(part, starts)


def _tiles_meet(left: tuple, right: tuple, t: float) -> np.ndarray:
    """Which tiles of two blocks may hold a pair that reaches ``t``; as ``similarity.zones_may_reach``."""
    (low, high), (other_low, other_high) = left[2:], right[2:]
    shorter, longer = np.minimum.outer(high[:, 0], other_high[:, 0]), np.maximum.outer(low[:, 0], other_low[:, 0])
    gaps = sum(
        np.maximum(0, np.maximum(np.subtract.outer(low[:, s], other_high[:, s]), -np.subtract.outer(high[:, s], other_low[:, s])))
        for s in range(1, low.shape[1])
    )
    return (shorter * (200 - t) >= longer * t) & (gaps * 100 <= np.add.outer(high[:, 0], other_high[:, 0]) * (100 - t))


def _columns(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, level) of the unary columns in which the two sides differ most often."""
    width = left.shape[1]

    def share(counts: np.ndarray) -> np.ndarray:
        cells = np.bincount((np.arange(width) * (_LEVELS + 1) + counts).ravel(), minlength=width * (_LEVELS + 1))
        return np.cumsum(cells.reshape(width, -1)[:, ::-1], axis=1)[:, ::-1][:, 1:] / len(counts)

    a, b = share(left), share(right)
    differ = a * (1 - b) + b * (1 - a)
    best = np.argsort(-differ, axis=None, kind="stable")[:COLUMNS]
    best = best[differ.ravel()[best] > 0]
    return best // _LEVELS, best % _LEVELS + 1


def _most(state: list[np.ndarray], n: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Longest common subsequence that pairs can still come to, with ``rest`` characters of the right key to go.

    Zero bits below a place are the matches with the left key up to there. Beyond place n - rest, a
    match won is one place fewer for the rest, so what counts are the matches before it.
    """
    place = np.maximum(n - rest, 0)
    got = sum(np.bitwise_count(~s & _BELOW[np.clip(place - 64 * w, 0, 64)]).astype(np.int64) for w, s in enumerate(state))
    return got + np.minimum(rest, n)


def _score(left: Side, lo: int, masks: list[np.ndarray], width: int, right: Side, rlo: int, codes: np.ndarray,
           i: np.ndarray, j: np.ndarray, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (by number) whose common subsequence is at least ``floor`` characters, and its length."""
    n, m = left.length[lo + i], right.length[rlo + j]
    base, state, alive = i * width, [np.full(len(i), ~np.uint64(0)) for _ in masks], np.arange(len(i))
    steps = int(m.max(initial=0))
    done_at = {int(steps * x) for x in _LOOKS}
    for step in range(steps):
        if step and step in done_at:
            keep = _most(state, n, np.maximum(m - step, 0)) >= floor
            alive, base, j, n, m, floor = alive[keep], base[keep], j[keep], n[keep], m[keep], floor[keep]
            state = [s[keep] for s in state]
        at = base + codes[step].take(j)
        carry = None
        for w, mask in enumerate(masks):
            s = state[w]
            u = mask.take(at)
            u &= s
            total = s + u
            over = total < s if w + 1 < len(masks) else None
            if carry is not None:
                total += carry
                if over is not None:
                    over |= (total == 0) & carry.astype(bool)
            s -= u
            total |= s
            state[w] = total
            carry = over.astype(np.uint64) if over is not None else None
    got = sum(np.bitwise_count(~s).astype(np.int64) for s in state) if len(state) else np.zeros(0, np.int64)
    keep = got >= floor
    return alive[keep], got[keep]


def _masks(left: Side, lo: int, hi: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Positions of each symbol in each left key, a list of machine words; the symbols."""
    span = slice(left.first[lo], left.first[hi])
    used, number = np.unique(left.symbol[span], return_inverse=True)
    width, words = len(used) + 1, max(int(left.length[lo:hi].max(initial=0)) - 1, 0) // 64 + 1
    masks = [np.zeros((hi - lo) * width, dtype=np.uint64) for _ in range(words)]
    at, place = (left.owner[span] - lo) * width + number, left.place[span]
    for w in range(words):
        own = place // 64 == w
        np.bitwise_or.at(masks[w], at[own], np.left_shift(np.uint64(1), (place[own] % 64).astype(np.uint64)))
    return masks, left.points[used]


def best_partners(left: Side, right: Side, min_score: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, int, int]:
    """(left number, right number, score) of every pair that ties for its left key's best, if that
    reaches ``min_score``; the pairs in tiles that meet, and the pairs scored."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    best = np.full(len(left.keys), min_score)
    met_pairs = scored_pairs = 0
    points = np.union1d(left.points, right.points)
    often = np.zeros(len(points), np.int64)
    for side in (left, right):
        often[np.searchsorted(points, side.points)] += np.bincount(side.symbol, minlength=len(side.points))
    counted = np.sort(points[np.argsort(-often, kind="stable")[:_COUNTED]])
    if not len(counted):
        counted = np.zeros(1, np.uint32)
    a_counts, b_counts = left.counts(counted), right.counts(counted)
    symbol, level = _columns(a_counts, b_counts)
    right_blocks = [(lo, hi, right.zones(lo, hi)) for lo, hi in _blocks(right.length, _RIGHT_ROWS)]
    coded = [None] * len(right_blocks)
    for lo, hi in _blocks(left.length, _LEFT_ROWS):
        zone = left.zones(lo, hi)
        x = (a_counts[lo:hi, symbol] >= level).astype(np.float32)
        x_sum, n = x.sum(axis=1), left.length[lo:hi]
        masks = None
        for k, (rlo, rhi, other) in enumerate(right_blocks):
            meet = _tiles_meet(zone, other, min_score - _SLACK)
            if not meet.any():
                continue
            met_pairs += int(zone[1] @ meet @ other[1])
            if coded[k] is None:
                y = (b_counts[rlo:rhi, symbol] >= level).astype(np.float32)
                coded[k] = (np.packbits(y.astype(bool), axis=1), y.sum(axis=1))
            y = np.unpackbits(coded[k][0], axis=1, count=len(symbol)).astype(np.float32)
            y_sum, m = coded[k][1], right.length[rlo:rhi]
            # Twice the columns both have >= all they have - the differences allowed by the left key's threshold.
            allowed = (100 - (best[lo:hi] - _SLACK)) / 100
            own = np.column_stack([x, (n * allowed - x_sum) / 2, np.ones(len(n)), allowed / 2]).astype(np.float32)
            theirs = np.column_stack([y, np.ones(len(m)), -y_sum / 2, m]).astype(np.float32)
            margin = -0.01 - 1e-6 * float(n.max() + m.max())
            i, j = np.divmod(np.flatnonzero(own @ theirs.T >= margin), rhi - rlo)
            keep = meet[zone[0][i], other[0][j]]
            total, least = n[i] + m[j], (best[lo:hi] - _SLACK)[i]
            keep &= 200 * np.minimum(n[i], m[j]) >= least * total
            i, j, total, least = i[keep], j[keep], total[keep], least[keep]
            if not len(i):
                continue
            scored_pairs += len(i)
            floor = np.ceil(np.maximum(least, 0) * total / 200 - 1e-9).astype(np.int64)
            if int(n.max()) >= 64 * _LONG:
                got = np.array([lcs_length_long(*sorted((left.keys[lo + a], right.keys[rlo + b]), key=len)) for a, b in zip(i, j)])
                pair = np.flatnonzero(got >= floor)
                got = got[pair]
            else:
                if masks is None:
                    masks, used = _masks(left, lo, hi)
                codes = right.codes(rlo, rhi, used)
                parts = [
                    (s + p, g) for s in range(0, len(i), _SCORED)
                    for p, g in [_score(left, lo, masks, len(used) + 1, right, rlo, codes, i[s : s + _SCORED], j[s : s + _SCORED], floor[s : s + _SCORED])]
                ]
                pair, got = (np.concatenate(c) for c in zip(*parts))
            if not len(pair):
                continue
            whole = total[pair].astype(np.float64)
            ratio = np.divide(whole - 2 * got, whole, out=np.zeros_like(whole), where=whole > 0)
            # Single precision, as token_sort_ratio gives it.
            score = (100.0 * (1.0 - ratio)).astype(np.float32).astype(np.float64)
            a, b = lo + i[pair], rlo + j[pair]
            ok = score >= best[a]
            a, b, score = a[ok], b[ok], score[ok]
            np.maximum.at(best, a, score)
            found.append((a, b, score))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), met_pairs, scored_pairs
    a, b, score = (np.concatenate(c) for c in zip(*found))
    ties = score == best[a]
    return a[ties], b[ties], score[ties], met_pairs, scored_pairs
