"""Token-sort similarity: 100 * 2 * LCS / (len a + len b) on two keys.

``letter_profile`` and ``may_reach`` give a lossless upper bound in plain JVM arithmetic, so
that only pairs able to reach the threshold are ever handed to the Arrow scorer.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# One eight-bit slot per symbol, eight slots per word; the last slot counts everything else.
_SYMBOLS = "abcdefghijklmnopqrstuvwxyz0123456789 "
PROFILE_WORDS = 5
_SLOT = 8

# Scores are rounded to float32, so the bound must not be stricter than that rounding.
_SLACK = 1e-3


def letter_profile(key: str) -> list[Column]:
    """Letter counts in unary ("thermometer") code, packed into ``PROFILE_WORDS`` longs.

    The population count of two profiles' XOR is sum |min(a_c, 8) - min(b_c, 8)|, which never
    exceeds the number of single-character insertions and deletions between the two keys.
    """
    counts = [f"length({key}) - length(replace({key}, '{c}', ''))" for c in _SYMBOLS]
    counts.append(f"length(translate({key}, '{_SYMBOLS}', ''))")
    slots = [
        f"shiftleft(shiftleft(1L, least({count}, {_SLOT})) - 1L, {i % _SLOT * _SLOT})"
        for i, count in enumerate(counts)
    ]
    return [F.expr(" | ".join(slots[w : w + _SLOT])) for w in range(0, len(slots), _SLOT)]


# Groups of letters whose sums bound a tile of keys; everything else is the last group.
LETTER_GROUPS = ("aeiou", "nrst", "bcdfg", "hlmpy")


def letter_sums(key: str) -> list[Column]:
    """Characters of each group in a key, and of none of them; together its length."""
    own = [F.expr(f"length({key}) - length(translate({key}, '{g}', ''))") for g in LETTER_GROUPS]
    return [*own, F.expr(f"length(translate({key}, '{''.join(LETTER_GROUPS)}', ''))")]


def zones_may_reach(min_score: float, sums: list[str], left: str = "l", right: str = "r") -> str:
    """SQL condition on ``_len`` and ``sums`` with ``_min`` and ``_max``: can any pair within the bounds
    of two tiles reach ``min_score``?

    An insertion or deletion changes one sum by one, so two keys are at least as far apart as the
    gaps between the tiles' sums together.
    """
    t = min_score - _SLACK
    gaps = (
        f"greatest(0, {left}{s}_min - {right}{s}_max, {right}{s}_min - {left}{s}_max)" for s in sums
    )
    return (
        f"least({left}_len_max, {right}_len_max) * {200 - t}D >= greatest({left}_len_min, {right}_len_min) * {t}D"
        f" and ({' + '.join(gaps)}) * 100D <= ({left}_len_max + {right}_len_max) * {100 - t}D"
    )


def may_reach(min_score: float, left: str, right: str) -> str:
    """SQL condition on ``{side}len`` and ``{side}p0..p4``: can the pair reach ``min_score``?"""
    t = min_score - _SLACK
    gap = " + ".join(f"bit_count({left}p{i} ^ {right}p{i})" for i in range(PROFILE_WORDS))
    return (
        f"least({left}len, {right}len) * {200 - t}D >= greatest({left}len, {right}len) * {t}D"
        f" and ({gap}) * 100D <= ({left}len + {right}len) * {100 - t}D"
    )


def length_reach(min_score: float, length: int | Column) -> tuple[float | Column, float | Column]:
    """Shortest and longest partner length that can reach ``min_score``."""
    t = max(min_score - _SLACK, _SLACK)
    return length * t / (200 - t), length * (200 - t) / t


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All characters of ``texts`` as (text number, position, code point) columns."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    start = np.cumsum(sizes) - sizes
    return owner, np.arange(len(points)) - np.repeat(start, sizes), points


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Longest-common-subsequence length of each pair, one bit per character of ``left``.

    Bit-parallel recurrence (Hyyro 2004), run for all pairs at once; keys longer than a
    machine word use several words with a carry between them. Candidates arrive grouped by
    left key, so the per-character bit masks are built once per distinct key.
    """
    n = len(left)
    a_of, a_keys = pd.factorize(np.array(left, dtype=object))
    b_of, b_keys = pd.factorize(np.array(right, dtype=object))
    a_text, a_place, a_point = _symbols(list(a_keys))
    b_text, b_place, b_point = _symbols(list(b_keys))
    if n == 0 or len(a_point) == 0 or len(b_point) == 0:
        return np.zeros(n, dtype=np.int64)
    alphabet, dense = np.unique(np.concatenate([a_point, b_point]), return_inverse=True)
    words = int(a_place.max()) // 64 + 1
    # One mask more than there are symbols: the last one is empty and pads short keys.
    masks = np.zeros((len(a_keys), len(alphabet) + 1, words), dtype=np.uint64)
    bits = np.left_shift(np.uint64(1), (a_place % 64).astype(np.uint64))
    np.bitwise_or.at(masks, (a_text, dense[: len(a_point)], a_place // 64), bits)
    codes = np.full((len(b_keys), int(b_place.max()) + 1), len(alphabet), dtype=np.int64)
    codes[b_text, b_place] = dense[len(a_point) :]

    # Longest right keys first: at character j only a leading part is still running.
    length = np.array([len(t) for t in b_keys], dtype=np.int64)[b_of]
    order = np.argsort(-length, kind="stable")
    own, other, length = a_of[order], codes[b_of[order]], length[order]
    running = np.searchsorted(-length, -np.arange(int(length[0])), side="left")
    state = np.full((n, words), np.uint64(0xFFFFFFFFFFFFFFFF))
    for j, active in enumerate(running):
        hit = masks[own[:active], other[:active, j]]
        carry = np.zeros(active, dtype=bool)
        for w in range(words):
            s = state[:active, w]
            u = s & hit[:, w]
            added = s + u
            total = added + carry
            carry = (added < s) | (total < added)
            state[:active, w] = total | (s - u)
    # Bits beyond a key's end never change, so every zero bit is one matched character.
    lcs = np.empty(n, dtype=np.int64)
    lcs[order] = np.bitwise_count(~state).sum(axis=1)
    return lcs


# From this many machine words on, whole-number arithmetic of any length beats word-wise carries.
_LONG = 3
# From this many on, the other key's characters go one by one instead of into a matrix.
_WIDE = 16


def lcs_length_long(left: str, right: str) -> int:
    """The same recurrence for one pair of long keys: one big integer holds all of ``left``."""
    masks: dict[str, int] = {}
    for place, character in enumerate(left):
        masks[character] = masks.get(character, 0) | 1 << place
    full = (1 << len(left)) - 1
    state = full
    for character in right:
        hit = state & masks.get(character, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(left) - state.bit_count()


def score_pairs(left: pd.Series, right: pd.Series) -> np.ndarray:
    """Similarity of each pair in [0, 100]; two empty keys are identical."""
    a, b = left.tolist(), right.tolist()
    sizes = np.array([(len(x), len(y)) for x, y in zip(a, b)], dtype=np.float64).reshape(-1, 2)
    total = sizes.sum(axis=1)
    lcs = np.zeros(len(a), dtype=np.int64)
    # Keys needing equally many words go together, and right keys of about one length, so one long
    # key does not widen the rest: a matrix holds at most twice the characters it is made of.
    words, wide = sizes[:, 0] // 64, np.ceil(np.log2(sizes[:, 1] // 64 + 1))
    alone = (words >= _LONG) | (sizes[:, 1] >= 64 * _WIDE)
    for i in np.flatnonzero(alone):
        lcs[i] = lcs_length_long(*sorted((a[i], b[i]), key=len))
    groups = words * 64 + wide
    for group in np.unique(groups[~alone]):
        part = np.flatnonzero(~alone & (groups == group))
        lcs[part] = lcs_lengths([a[i] for i in part], [b[i] for i in part])
    distance = total - 2 * lcs
    ratio = np.divide(distance, total, out=np.zeros_like(total), where=total > 0)
    return 100.0 * (1.0 - ratio)


@F.pandas_udf(DoubleType())
def _ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    # float32 first: the reference scores are single precision.
    return pd.Series(score_pairs(left, right).astype(np.float32).astype(np.float64))


def token_sort_ratio(left_key: Column, right_key: Column) -> Column:
    """Score of two keys made by ``token_sort_key``."""
    return _ratio(left_key, right_key)
