"""Quality rules: measures of every text, and decision lists learned from labelled documents.

The list is learned by sequential covering. A rule is a conjunction of at most three thresholds
that grows by information gain on two thirds of the labelled rows, is pruned on the other third,
and is kept only if it is precise there; rows that it covers are set aside and the next rule is
learned. The rules become one Spark ``CASE WHEN`` over the measures: the first that holds rejects.

Learning sees a bounded sample of labelled rows (``max_labelled``, drawn by the hash of the id);
measuring and judging cover all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from titleweave.llm.common import free_name, unit
from titleweave.llm.wordhash import U, Run, runs, scatter

REPEAT_WINDOW = 8
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_upper", "n_digits", "n_exclaims", "n_stops", "n_lines", "n_distinct", "n_short_words",
)
MEASURES = StructType([StructField(name, LongType()) for name in COUNTS])


def _flags(characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table


_SYMBOLS, _UPPER, _DIGITS = _flags(b"#*$%&|<>"), _flags(bytes(range(65, 91))), _flags(b"0123456789")
_STOPS, _EXCLAIM, _NEWLINE = _flags(b".,;:?"), _flags(b"!"), _flags(b"\n")


def _repeated_words(run: Run, hashes: np.ndarray) -> np.ndarray:
    """Per document: words in windows that its text has twice or more."""
    at, window = run.windows(hashes, REPEAT_WINDOW)
    own = scatter(window + run.document_of_words()[at].astype(U) * U(0x9E3779B97F4A7C15))
    order = np.sort(own)
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    change = np.zeros(len(hashes) + REPEAT_WINDOW + 1, np.int64)
    if len(twice):
        place = np.minimum(np.searchsorted(twice, own), len(twice) - 1)
        hit = at[twice[place] == own]
        change[hit] += 1
        change[hit + REPEAT_WINDOW] -= 1
    return run.per_document_words(np.cumsum(change)[: len(hashes)] > 0)


def _duplicate_lines(run: Run) -> list[int]:
    text, bounds, out = run.data.tobytes(), run.bounds.tolist(), []
    for a, b in zip(bounds, bounds[1:]):
        lines = [line for line in text[a:b].split(b"\n") if line.strip()]
        out.append(len(lines) - len(set(lines)))
    return out


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The counts of ``COUNTS`` for every text of a column."""
    found: dict[str, list] = {name: [] for name in COUNTS}
    for run in runs(column):
        hashes = run.hashes()
        head = (run.data & 0xC0) != 0x80  # first byte of a code point
        points = np.concatenate([[0], np.cumsum(head, dtype=np.int64)])
        length = points[run.ends] - points[run.starts]
        owner = run.document_of_words()
        order = np.lexsort((hashes, owner))
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[1:] != owner[:-1])
        values = {
            "n_words": np.diff(run.word_bounds),
            "word_chars": run.per_document_words(length),
            "n_symbols": run.per_document(_SYMBOLS[run.data]),
            "n_dup_lines": _duplicate_lines(run),
            "n_repeat_words": _repeated_words(run, hashes),
            "n_upper": run.per_document(_UPPER[run.data]),
            "n_digits": run.per_document(_DIGITS[run.data]),
            "n_exclaims": run.per_document(_EXCLAIM[run.data]),
            "n_stops": run.per_document(_STOPS[run.data]),
            "n_lines": run.per_document(_NEWLINE[run.data]) + 1,
            "n_distinct": run.per_document_words(new),
            "n_short_words": run.per_document_words(length <= 2),
        }
        for name in COUNTS:
            found[name].append(np.asarray(values[name], np.int64))
    return {name: np.concatenate(parts) if parts else np.empty(0, np.int64) for name, parts in found.items()}


@F.arrow_udf(MEASURES)
def text_measures(texts: pa.Array) -> pa.Array:
    found = measure(texts)
    return pa.StructArray.from_arrays([pa.array(found[n]) for n in COUNTS], names=list(COUNTS))


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with one struct column ``measures``; null text counts as empty."""
    return df.withColumn("measures", text_measures(F.col(text)))


def _ratio(top: str, bottom: str) -> Column:
    return F.col(f"measures.{top}") / F.greatest(F.col(f"measures.{bottom}"), F.lit(1))


def features() -> dict[str, Column]:
    """What rules may test, as expressions over ``measures``."""
    return {
        "words": F.col("measures.n_words").cast("double"),
        "chars_per_word": _ratio("word_chars", "n_words"),
        "symbol_share": _ratio("n_symbols", "word_chars"),
        "duplicate_line_share": _ratio("n_dup_lines", "n_lines"),
        "repeated_word_share": _ratio("n_repeat_words", "n_words"),
        "upper_share": _ratio("n_upper", "word_chars"),
        "digit_share": _ratio("n_digits", "word_chars"),
        "exclaims_per_word": _ratio("n_exclaims", "n_words"),
        "stops_per_word": _ratio("n_stops", "n_words"),
        "words_per_line": _ratio("n_words", "n_lines"),
        "distinct_word_share": _ratio("n_distinct", "n_words"),
        "short_word_share": _ratio("n_short_words", "n_words"),
    }


@dataclass(frozen=True)
class Test:
    feature: str
    at_least: bool
    threshold: float

    def on(self, rows: pd.DataFrame) -> np.ndarray:
        values = rows[self.feature].to_numpy()
        return values >= self.threshold if self.at_least else values <= self.threshold

    def column(self) -> Column:
        value = features()[self.feature]
        return value >= self.threshold if self.at_least else value <= self.threshold


Rule = tuple[Test, ...]


def _covers(rule: Rule, rows: pd.DataFrame) -> np.ndarray:
    hit = np.ones(len(rows), bool)
    for test in rule:
        hit &= test.on(rows)
    return hit


def _grow(rows: pd.DataFrame, bad: np.ndarray, names: list[str], cuts: int, most_tests: int) -> Rule:
    """Add the test with the best gain until only bad rows are left or nothing is gained."""
    rule: Rule = ()
    for _ in range(most_tests):
        p0, n0 = bad.sum(), (~bad).sum()
        if n0 == 0 or p0 == 0:
            break
        base, best = np.log2(p0 / (p0 + n0)), (1e-9, None)
        for name in names:
            values = rows[name].to_numpy()
            for threshold in np.unique(np.quantile(values, np.linspace(0, 1, cuts + 1))):
                for at_least in (True, False):
                    hit = values >= threshold if at_least else values <= threshold
                    p = (hit & bad).sum()
                    if p:
                        gain = p * (np.log2(p / hit.sum()) - base)
                        if gain > best[0]:
                            best = (gain, Test(name, at_least, float(threshold)))
        if best[1] is None:
            break
        rule += (best[1],)
        hit = best[1].on(rows)
        rows, bad = rows[hit], bad[hit]
    return rule


def _prune(rule: Rule, rows: pd.DataFrame, bad: np.ndarray) -> tuple[Rule, float, int]:
    """The prefix that is best on rows it has not seen, its precision there and its bad rows."""
    best = ((), -1.0, 0)
    for end in range(1, len(rule) + 1):
        hit = _covers(rule[:end], rows)
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        if p + n and (p - n) / (p + n) > best[1]:
            best = (rule[:end], (p - n) / (p + n), int(p))
    return best[0], (best[1] + 1) / 2, best[2]


def learn_rules(
    rows: pd.DataFrame, label: str = "quality", most_rules: int = 12, most_tests: int = 3,
    cuts: int = 48, least_precision: float = 0.9, least_covered: int = 3,
) -> list[Rule]:
    """Decision list rejecting rows whose label is 0. Too few or one-sided rows give no rules."""
    names = [n for n in features() if n in rows]
    turn = np.arange(len(rows)) % 3 == 2
    grow, prune = rows[~turn], rows[turn]
    rules: list[Rule] = []
    while len(rules) < most_rules:
        bad, bad_kept = (grow[label] == 0).to_numpy(), (prune[label] == 0).to_numpy()
        if bad.sum() < least_covered or bad_kept.sum() < least_covered:
            break
        rule, precision, covered = _prune(_grow(grow, bad, names, cuts, most_tests), prune, bad_kept)
        if not rule or precision < least_precision or covered < least_covered:
            break
        rules.append(rule)
        grow, prune = grow[~_covers(rule, grow)], prune[~_covers(rule, prune)]
    return rules


def labelled_rows(table: DataFrame, labels: DataFrame, row_id: str = "doc_id", label: str = "quality",
                  max_labelled: int = 40_000) -> pd.DataFrame:
    """Features and label of at most about ``max_labelled`` labelled rows, in a fixed order."""
    marks = labels.where(F.col(label).isNotNull() & F.col(row_id).isNotNull()).groupBy(row_id).agg(
        F.max(label).alias(label)
    )
    joined = table.select(row_id, "measures").join(marks, row_id)
    chance = unit(F.col(row_id), F.lit("rules"))
    share = max_labelled / max(marks.count(), 1)
    drawn = joined.where(chance < share) if share < 1 else joined
    found = drawn.select(row_id, chance.alias("chance"), label, *[c.alias(n) for n, c in features().items()]).toPandas()
    return found.sort_values(["chance", row_id]).reset_index(drop=True)


def base_failed() -> Column:
    words, repeats = F.col("measures.n_words"), F.col("measures.n_repeat_words")
    return (words < 20) | (100 * repeats > 30 * words)


def verdict(rules: list[Rule]) -> Column:
    """The ordered conditional: false where a rule rejects."""
    out = None
    for rule in rules:
        condition = rule[0].column()
        for test in rule[1:]:
            condition = condition & test.column()
        out = F.when(condition, F.lit(False)) if out is None else out.when(condition, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def kept(rules: list[Rule]) -> Column:
    return ~base_failed() & verdict(rules)


def keep_good(df: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The rows of ``df`` that pass, same columns, whatever they are called."""
    name = free_name(df, "rule_text")
    own = df.select(F.struct("*").alias("row"), F.col(text).alias(name))
    return measured(own, name).where(kept(rules)).select("row.*")
