"""Seating of many Pitman-Yor restaurants at once, by Markov chains over table openings.

The customers of a dish arrive in a row; its state is which of them opened a table (the first
always did). Given the tables of the other dishes, a row with t tables before customer k has the weight

    opening: (strength + discount * all tables) * parent        joining: k - 1 - discount * t

and summing over rows gives the restaurant's law of tables. A sweep reseats every customer but the
first, in blocks: the last half of each dish's row, the quarter before it, and so on. A block is drawn
in sequence and accepted by Metropolis-Hastings with the exact ratio of weights, later customers
included. All dishes move at once; within a block they see the others' tables of before it.

A dish of few customers needs no row: its number of tables is drawn from its law given the others' tables,
by the generalised Stirling numbers of its customers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FEW = 32


@dataclass
class Seating:
    """Openings sorted by dish and customer: ``when[i]`` is the customer of ``dish[i]`` who opened a table."""

    dish: np.ndarray
    when: np.ndarray

    def tables(self, n: int) -> np.ndarray:
        return np.bincount(self.dish, minlength=n)


def _sorted(dish: np.ndarray, when: np.ndarray) -> Seating:
    bits = int(when.max(initial=0)).bit_length()
    if bits + int(dish.max(initial=0)).bit_length() > 63:
        order = np.lexsort((when, dish))
        return Seating(dish[order], when[order])
    both = np.sort(dish << bits | when)  # one number each: several times as fast as by two columns
    return Seating(both >> bits, both & ((1 << bits) - 1))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Of positive numbers: Stirling's series at x + 8, less the log of x (x + 1) ... (x + 7)."""
    y = x + 8.0
    r = 1.0 / y
    q = r * r
    series = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + r * (1 / 12 - q * (1 / 360 - q / 1260))
    z = x * (x + 7.0)
    return series - np.log(z * (z + 6.0) * (z + 10.0) * (z + 12.0))


def _open(draw, at, end, tables, others, parent, discount: float, strength: float) -> tuple[np.ndarray, np.ndarray]:
    """Dishes and customers of the tables that customers at+1..end open, one after another.

    ``others``: tables of the other dishes of a restaurant.
    """
    at, tables = at.astype(np.float64), tables.astype(np.float64)
    who, when = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    active = np.flatnonzero(end > at)
    while len(active):
        weight = (strength + discount * (others[active] + tables[active])) * parent[active]
        rest = at[active] - discount * tables[active]
        # Guests join an urn whose weight grows by one each time, until one opens a table: the
        # chance is a Beta variable that is fixed for all of them, the wait is geometric.
        chance = np.clip(draw.beta(np.maximum(weight, 1e-12), np.maximum(rest, 1e-9)), 1e-15, 1 - 1e-12)
        after = at[active] + 1 + np.floor(np.log(draw.random(len(active)) + 1e-300) / np.log1p(-chance))
        hit = after <= end[active]
        active, after = active[hit], after[hit]
        at[active] = after
        tables[active] += 1
        who.append(active)
        when.append(after.astype(np.int64))
    return np.concatenate(who), np.concatenate(when)


def _stretches(dish, when, start, end, tables) -> tuple[np.ndarray, ...]:
    """Dish, start, end and tables of the stretches between openings, from ``start`` to ``end`` of each dish.

    Openings come sorted by dish and customer and lie behind ``start``, so every stretch's place is known.
    """
    n = len(start)
    openings = np.bincount(dish, minlength=n)
    behind = np.cumsum(openings + 1)
    first = behind - openings - 1
    of = np.repeat(np.arange(n), openings + 1)
    opened, last = np.ones(len(of), bool), np.zeros(len(of), bool)
    opened[first], last[behind - 1] = False, True
    since, until = np.empty(len(of), np.int64), np.empty(len(of), np.int64)
    since[first], since[opened] = start, when
    until[:-1], until[behind - 1] = since[1:], end
    return of, since, until, tables[of] + np.arange(len(of)) - first[of], last


def _drawn(dish, when, start, end, tables, others, parent, discount, strength) -> np.ndarray:
    """Log weight of a block over the chance of drawing it in sequence, of each dish."""
    d, s, e, t, _ = _stretches(dish, when, start, end, tables)
    x = (strength + discount * (others[d] + t)) * parent[d] - discount * t
    return np.bincount(d, log_gamma(e + x) - log_gamma(s + x), len(start))


def _later(dish, when, start, end, tables, others, discount, strength) -> np.ndarray:
    """Log weight of the customers after a block, as far as it depends on the tables at its end."""
    d, s, e, t, last = _stretches(dish, when, start, end, tables)
    joined = np.where(last, e, e - 1) - discount * t
    opened = np.where(last, 0.0, np.log(strength + discount * (others[d] + t)))
    return np.bincount(d, log_gamma(joined) - log_gamma(s - discount * t) + opened, len(start))


def extend(old: Seating | None, counts: np.ndarray, group: np.ndarray, parent: np.ndarray, discount: float,
           strength: float, draw: np.random.Generator, before: np.ndarray | None = None,
           elsewhere: np.ndarray | int = 0) -> Seating:
    """A seating of ``counts`` customers: ``old``, of ``before`` customers, without those who are gone and with new ones in turn.

    ``elsewhere``: tables of each dish's restaurant that stay as they are, of dishes that are not among these.
    """
    n = len(counts)
    if old is None:
        old, there = Seating(np.arange(n), np.ones(n, np.int64)), np.ones(n, np.int64)
    else:
        there = np.minimum(before, counts)
        kept = old.when <= counts[old.dish]
        fresh = np.flatnonzero(there == 0)
        old = Seating(np.concatenate([old.dish[kept], fresh]), np.concatenate([old.when[kept], np.ones(len(fresh), np.int64)]))
        there = np.maximum(there, 1)
    tables = old.tables(n)
    others = np.bincount(group, tables)[group] - tables + elsewhere
    who, when = _open(draw, there, counts, tables, others, parent, discount, strength)
    return _sorted(np.concatenate([old.dish, who]), np.concatenate([old.when, when]))


def sweep(now: Seating, counts: np.ndarray, group: np.ndarray, parent: np.ndarray, discount: float,
          strength: float, draw: np.random.Generator, elsewhere: np.ndarray | int = 0) -> Seating:
    """Reseat every customer but the first of each dish once. ``group`` is the restaurant of each dish."""
    n = len(counts)
    place = np.empty(n, np.int64)
    for level in range(int(counts.max(initial=1)).bit_length() - 1):
        low, high = counts >> (level + 1), counts >> level
        own = np.flatnonzero(low >= 1)
        place[:] = -1
        place[own] = np.arange(len(own))
        tables = now.tables(n)
        others = (np.bincount(group, tables)[group] - tables + elsewhere)[own]
        at = place[now.dish]
        block = (at >= 0) & (now.when > low[now.dish]) & (now.when <= high[now.dish])
        late = (at >= 0) & (now.when > high[now.dish])
        before = tables[own] - np.bincount(at[block | late], minlength=len(own))
        start, end, total, base = low[own], high[own], counts[own], parent[own]
        came = _sorted(*_open(draw, start, end, before, others, base, discount, strength))
        who, when = came.dish, came.when
        ratio = _drawn(who, when, start, end, before, others, base, discount, strength)
        ratio -= _drawn(at[block], now.when[block], start, end, before, others, base, discount, strength)
        if level:
            rest = (at[late], now.when[late], end, total)
            ratio += _later(*rest, before + np.bincount(who, minlength=len(own)), others, discount, strength)
            ratio -= _later(*rest, before + np.bincount(at[block], minlength=len(own)), others, discount, strength)
        taken = np.log(draw.random(len(own)) + 1e-300) < ratio
        gone = block.copy()
        gone[block] = taken[at[block]]
        kept, new = ~gone, taken[who]
        now = _sorted(np.concatenate([now.dish[kept], own[who[new]]]), np.concatenate([now.when[kept], when[new]]))
    return now


def stirling(discount: float, most: int = FEW) -> list[np.ndarray]:
    """For every number of customers, the weight of t + 1 tables over that of t, apart from the parent's chance
    and the strength."""
    row, out = np.array([0.0, 1.0]), [np.empty(0), np.empty(0)]
    for k in range(1, most):
        t = np.arange(len(row))
        row = np.append(row * (k - discount * t), 0.0) + np.append(0.0, row)
        out.append(row[2:] / row[1:-1])
    return out


def reseat_few(tables: np.ndarray, counts: np.ndarray, group: np.ndarray, parent: np.ndarray, discount: float,
               strength: float, draw: np.random.Generator, all_tables: np.ndarray) -> np.ndarray:
    """New numbers of tables of dishes of ``FEW`` customers at most. Dishes of as many customers move at once.

    ``all_tables`` of each restaurant, of other dishes too, are kept up to date in place."""
    out = tables.copy()
    order = np.argsort(counts.astype(np.uint8), kind="stable")
    bounds = np.searchsorted(counts[order], np.arange(2, FEW + 2))
    for c, ratios in enumerate(stirling(discount)):
        at = order[bounds[c - 2] : bounds[c - 1]] if c >= 2 else order[:0]
        if not len(at):
            continue
        own, base = group[at], parent[at]
        weight = (strength + discount * (all_tables[own] - tables[at])) * base
        step, chance, total, sums = discount * base, 1.0, 1.0, []
        for t, ratio in enumerate(ratios, 1):
            sums.append(total)
            chance = chance * (ratio * (weight + step * t))
            total = total + chance
        place = draw.random(len(at)) * total
        new = np.ones(len(at), np.int64)
        for below in sums:
            new += place >= below
        change = new - tables[at]
        moved = np.flatnonzero(change)
        np.add.at(all_tables, own[moved], change[moved])
        out[at] = new
    return out
