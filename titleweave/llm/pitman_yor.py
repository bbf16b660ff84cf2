"""Language-model scores by a hierarchical Pitman-Yor model over word classes.

Every word belongs to one class: a frequent word is a class of its own, other words share a
class with the words of the same ending, and the end of a text is a class. The model is a restaurant for
each previous word, whatever its frequency, that seats the words that follow it. Its parent is

    P0(word | previous word) = P(class | class of the previous word) * P(word | its class)

* One restaurant for each previous class seats the classes that follow it. All of them share
  one parent, the restaurant of all classes: each table of a child is a customer of the parent.
  Seatings are Markov chains that go on from round to round in a staged table: a round sweeps
  over all customers ``SWEEPS`` times, child restaurants in Spark, then the parent; predictive
  probabilities are averaged over the rounds after ``BURN_IN``.
* Within a class, words are dishes of a restaurant whose base measure is continuous: every word
  has one table, and what its discount leaves is the probability of words never seen. The
  discount follows from the words seen once and twice.
* Above the classes, the restaurant of a word seats the words that follow it. ``fit_words`` seats all of them by
  chains too, in turn with the classes, whose customers are then the tables of all word restaurants. Without it
  every kind of follower has one table, and the classes learn from all tokens. The discount follows from the
  pairs seen once and twice. All word pairs are counted, none is dropped.

The classes number ``CLASSES``, so class probabilities are one matrix of bounded size that goes to
every task. Words and word pairs grow with the corpus: a chunk of documents sends its distinct pairs, with
their counts, to parts by previous word, and gets back the sums of the corpus in the order it
asked. The pairs of the most frequent words are spread over all parts; any other word has at most one in
``FREQUENT`` of all tokens, so no part becomes hot. Restaurants are seated by part; the slices of a frequent
word's restaurant see each other's tables of the round before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleweave.llm.common import drop_folder, stage, stage_and_free
from titleweave.llm.quality_net import held_out
from titleweave.llm.seating import FEW, Seating, extend, reseat_few, sweep
from titleweave.llm.wordhash import U, Run, runs, scatter, sums, _LOWER
from titleweave.session import new_folder, shared_folder

CLASSES = 1024
ENDINGS = 256
FREQUENT = CLASSES - ENDINGS - 1
END = CLASSES - 1
END_HASH = np.array([0x2545F4914F6CDD1D], np.uint64).view(np.int64)[0]
CHUNK_BYTES = 8 << 20
STRENGTH = 5.0
ROUNDS, BURN_IN, SWEEPS = 4, 1, 8
WORD_SWEEPS = 2
BUCKETS = 64
STRETCH_BYTES = CHUNK_BYTES // 2


def _words(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Hash and ending class of every word of a run, lower-cased in A-Z."""
    hashes = run.hashes(lower=True)
    last = _LOWER[run.data[run.ends - 1]] if len(run.ends) else np.empty(0, U)
    before = _LOWER[run.data[np.maximum(run.ends - 2, run.starts)]] if len(run.ends) else np.empty(0, U)
    ending = FREQUENT + (scatter(last * U(31) + before) % U(ENDINGS)).astype(np.int64)
    return hashes.view(np.int64), ending


def _classes(hashes: np.ndarray, ending: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Class of each word; ``frequent`` is sorted, ``rank`` its classes."""
    if not len(frequent):
        return ending
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    return np.where(frequent[at] == hashes, rank[at], ending)


def _with_ends(run: Run, values: np.ndarray, end) -> tuple[np.ndarray, np.ndarray]:
    """Values of the words of each document followed by ``end``; first position of each document."""
    counts = np.diff(run.word_bounds) + 1
    first = np.concatenate([[0], np.cumsum(counts)])
    out = np.full(first[-1], end, values.dtype)
    inner = np.ones(first[-1], bool)
    inner[first[1:] - 1] = False
    out[inner] = values
    return out, first


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each batch with their counts and ending classes."""
    for batch in batches:
        hashes, endings = [], []
        for run in runs(batch.column("text")):
            h, e = _words(run)
            hashes += [h, np.full(len(run), END_HASH)]
            endings += [e, np.full(len(run), END)]
        if not hashes:
            continue
        number, word = pd.factorize(np.concatenate(hashes))
        ending = np.empty(len(word), np.int32)
        ending[number] = np.concatenate(endings)
        count = np.bincount(number, minlength=len(word))
        yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(ending), pa.array(count)], ["word", "ending", "count"])


def word_counts(training: DataFrame) -> DataFrame:
    """word (hash), ending, count over all training texts, the end of a text included."""
    counted = training.select("text").mapInArrow(_count_words, "word bigint, ending int, count bigint")
    return counted.groupBy("word").agg(F.min("ending").alias("ending"), F.sum("count").alias("count"))


def _count_pairs(frequent: np.ndarray, rank: np.ndarray):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for run in runs(batch.column("text")):
                klass, first = _with_ends(run, _classes(*_words(run), frequent, rank), END)
                before = np.empty(len(klass), np.int64)
                before[1:] = klass[:-1]
                before[first[:-1]] = END
                table += np.bincount(before * CLASSES + klass, minlength=len(table))
        yield _class_pairs(table)

    return count


_CLASS_PAIRS = "before int, class int, count bigint"


def seat(counts: np.ndarray, parent: np.ndarray, discount: float, strength: float, seed: int,
         sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """One sample of a restaurant: tables of each dish, and its customers.

    ``counts`` customers of each dish, ``parent`` the parent's probability of each dish. First all
    are seated in turn; then each sweep reseats all customers of every dish.
    """
    draw = np.random.default_rng(seed)
    group = np.zeros(len(counts), np.int64)
    now = extend(None, counts, group, parent, discount, strength, draw)
    for _ in range(sweeps):
        now = sweep(now, counts, group, parent, discount, strength, draw)
    return now.tables(len(counts)), counts


@dataclass
class Model:
    """Log probabilities of classes, and what words within classes need."""

    frequent: np.ndarray
    rank: np.ndarray
    log_class: np.ndarray
    discount: np.ndarray
    size: np.ndarray
    kinds: np.ndarray
    tokens: int
    distinct: int

    def log_word(self, klass: np.ndarray, count: np.ndarray) -> np.ndarray:
        """log10 P(word | class): a class of one word has probability one."""
        many = klass >= FREQUENT
        many &= klass != END
        total = self.size[klass] + 1.0
        known = (count - self.discount[klass]) / total
        unseen = (1.0 + self.discount[klass] * self.kinds[klass]) / total
        return np.where(many, np.log10(np.where(count > 0, np.maximum(known, 1e-300), unseen)), 0.0)


def _predictive(counts: np.ndarray, tables: np.ndarray, parent: np.ndarray, discount: float) -> np.ndarray:
    total = counts.sum()
    if not total:
        return parent
    new = (STRENGTH + discount * tables.sum()) / (STRENGTH + total)
    return np.maximum(counts - discount * tables, 0) / (STRENGTH + total) + new * parent


_CHAINS = "bucket int, before binary, class binary, count binary, dish binary, when binary, tables binary, chance binary"


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _gather(rows: pa.Table) -> pa.Table:
    """The restaurants of a bucket as one row, nobody seated yet."""
    before, klass = rows.column("before").to_numpy(), rows.column("class").to_numpy()
    order = np.lexsort((klass, before))
    values = (before, klass, rows.column("count").to_numpy().astype(np.int64))
    packed = [v[order].tobytes() for v in values] + [b""] * 4
    columns = [pa.array([int(before[0]) % BUCKETS], pa.int32())] + [pa.array([v], pa.binary()) for v in packed]
    return pa.Table.from_arrays(columns, ["bucket", "before", "class", "count", "dish", "when", "tables", "chance"])


def _sample_children(chains: DataFrame, parent: np.ndarray, discount: float, turn: int, folder: str) -> DataFrame:
    """One round of the chains of all child restaurants; tables and chances are matrices, a row a restaurant.

    A column ``was`` has the customers that the chains seat, where others are counted now."""

    names = _names(_CHAINS)

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = {name: batch.column(name)[n].as_py() for name in batch.schema.names}
                before, klass = np.frombuffer(row["before"], np.int32), np.frombuffer(row["class"], np.int32)
                counts = np.frombuffer(row["count"], np.int64)
                own, group = np.unique(before, return_inverse=True)
                draw = np.random.default_rng([turn, row["bucket"]])
                base = parent[klass]
                if row["dish"]:
                    now = Seating(np.frombuffer(row["dish"], np.int32).astype(np.int64), np.frombuffer(row["when"], np.int64))
                    if "was" in row:
                        now = extend(now, counts, group, base, discount, STRENGTH, draw, np.frombuffer(row["was"], np.int64))
                else:
                    now = extend(None, counts, group, base, discount, STRENGTH, draw)
                for _ in range(SWEEPS):
                    now = sweep(now, counts, group, base, discount, STRENGTH, draw)
                tables, all_counts = np.zeros((len(own), CLASSES), np.int64), np.zeros((len(own), CLASSES), np.int64)
                tables[group, klass], all_counts[group, klass] = now.tables(len(counts)), counts
                chance = np.array([_predictive(c, t, parent, discount) for c, t in zip(all_counts, tables)])
                row |= {"dish": now.dish.astype(np.int32).tobytes(), "when": now.when.tobytes(),
                        "tables": tables.tobytes(), "chance": chance.tobytes()}
                yield pa.RecordBatch.from_arrays([pa.array([row[k]], batch.schema.field(k).type) for k in names], names)

    return stage_and_free(chains.mapInArrow(sample, _CHAINS), folder, "seating")


def _discount(once: float, twice: float) -> float:
    return float(np.clip((once + 0.5) / (once + 2 * twice + 1.5), 0.05, 0.95))


def _vocabulary(counts: DataFrame) -> Model:
    """Classes of words and the restaurants of words within classes; class probabilities are still alike."""
    top = counts.where(F.col("word") != int(END_HASH)).orderBy(F.col("count").desc(), "word").limit(FREQUENT).toPandas()
    order = np.argsort(top["word"].to_numpy(np.int64))
    frequent, rank = top["word"].to_numpy(np.int64)[order], order.astype(np.int64)
    known = F.col("word").isin([]) if not len(frequent) else F.array_contains(
        F.split(F.lit(",".join(map(str, frequent))), ",").cast("array<bigint>"), F.col("word"))
    facts = counts.groupBy(F.when(known, -1).otherwise(F.col("ending")).alias("class")).agg(
        F.sum("count").alias("tokens"), F.count("*").alias("kinds"),
        F.count_if(F.col("count") == 1).alias("once"), F.count_if(F.col("count") == 2).alias("twice"),
    ).toPandas()
    size, kinds, discount = np.zeros(CLASSES), np.zeros(CLASSES), np.full(CLASSES, 0.5)
    for r in facts[facts["class"] >= 0].itertuples():
        n = int(r[1])
        size[n], kinds[n], discount[n] = r.tokens, r.kinds, _discount(r.once, r.twice)
    alike = np.full((CLASSES, CLASSES), -np.log10(CLASSES), np.float32)
    return Model(frequent, rank, alike, discount, size, kinds, int(facts["tokens"].sum()), int(facts["kinds"].sum()))


def _log(chances: np.ndarray) -> np.ndarray:
    return np.log10(chances / chances.sum(axis=1, keepdims=True)).astype(np.float32)


class _Classes:
    """Rounds of the class restaurants: children in Spark, then their parent, here. Chains are staged in ``folder``."""

    def __init__(self, pairs: DataFrame, folder: str):
        self.folder = folder
        rare = pairs.agg(F.count_if(F.col("count") == 1), F.count_if(F.col("count") == 2)).first()
        self.child = _discount(rare[0] or 0, rare[1] or 0)
        self.parent = np.full(CLASSES, 1 / CLASSES)
        self.base = self.parent.copy()
        self.total, self.samples = np.zeros((CLASSES, CLASSES)), 0
        self.top_chain, self.top_counts, self.draw = None, None, np.random.default_rng(7919)
        self.chains = self._gathered(pairs)

    def _gathered(self, pairs: DataFrame) -> DataFrame:
        bucket = F.pmod(F.col("before"), F.lit(BUCKETS)).alias("bucket")
        return stage_and_free(pairs.select(bucket, "before", "class", "count").repartition(BUCKETS // 4, "bucket")
                     .groupBy("bucket").applyInArrow(_gather, _CHAINS), self.folder, "seating")

    def recount(self, pairs: DataFrame) -> None:
        """Other counts of the same dishes: chains go on without the customers who are gone and with new ones."""
        chains = self.chains.select("bucket", "dish", "when", F.col("count").alias("was"))
        self.chains = self._gathered(pairs).drop("dish", "when").join(chains, "bucket")

    def round(self, turn: int) -> np.ndarray:
        """Chances of the classes after each class, in one sample."""
        self.chains = _sample_children(self.chains, self.parent, self.child, turn, self.folder)
        found = self.chains.select("bucket", "before", "tables", "chance").toPandas().sort_values("bucket")
        sent, rows = np.zeros(CLASSES, np.int64), np.tile(self.parent, (CLASSES, 1))
        for r in found.itertuples():
            sent += np.frombuffer(r.tables, np.int64).reshape(-1, CLASSES).sum(axis=0)
            rows[np.unique(np.frombuffer(r.before, np.int32))] = np.frombuffer(r.chance, np.float64).reshape(-1, CLASSES)
        used = np.flatnonzero(sent)  # the same each round: every dish has a table
        tables = np.zeros(CLASSES)
        if len(used):
            home = (sent[used], np.zeros(len(used), np.int64), self.base[used], 0.5, STRENGTH, self.draw)
            self.top_chain, self.top_counts = extend(self.top_chain, *home, self.top_counts), sent[used]
            for _ in range(SWEEPS):
                self.top_chain = sweep(self.top_chain, *home)
            tables[used] = self.top_chain.tables(len(used))
        if turn >= BURN_IN:
            self.samples += 1
            self.total += rows
        self.parent = _predictive(sent.astype(np.float64), tables, self.base, 0.5)
        self.parent /= self.parent.sum()
        return rows


def fit(training: DataFrame, counts: DataFrame) -> Model:
    """Classes, seating samples and word discounts. ``counts`` is the staged table of ``word_counts``.

    To the driver come the frequent words, one row a class and the restaurants' tables and chances.
    """
    model = _vocabulary(counts)
    classes = _Classes(stage(
        training.select("text").mapInArrow(_count_pairs(model.frequent, model.rank), _CLASS_PAIRS)
        .groupBy("before", "class").agg(F.sum("count").alias("count")), "class-pairs",
    ), shared_folder(training.sparkSession))
    for turn in range(ROUNDS):
        classes.round(turn)
    return replace(model, log_class=_log(classes.total / classes.samples))


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, sorted, and the number of each value among them: only the distinct ones are sorted."""
    number, found = pd.factorize(values)
    order = np.argsort(found)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return found[order], place[number]


def _numbered_pairs(first: np.ndarray, second: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of numbers below ``n``, sorted, and the number of each pair among them."""
    width, places = max(n - 1, 1).bit_length(), max(len(first) - 1, 1).bit_length()
    if 2 * width + places > 63:
        found, pair = np.unique(first << 32 | second, return_inverse=True)
        return found >> 32, found & 0xFFFFFFFF, pair
    both = np.sort((first << width | second) << places | np.arange(len(first)))  # sorted with its place: twice as fast
    found = both >> places
    new = np.ones(len(found), bool)
    new[1:] = found[1:] != found[:-1]
    pair = np.empty(len(found), np.int64)
    pair[both & ((1 << places) - 1)] = np.cumsum(new) - 1
    found = found[new]
    return found >> width, found & ((1 << width) - 1), pair


@dataclass
class Pairs:
    """Tokens of a chunk, and its distinct word pairs in the order in which they are asked for.

    ``first`` is the first token of each document, ``word`` and ``pair`` are numbers of each token's word and
    of its pair with the word before it. Pairs are sorted by part, previous word and word, whatever the order of the
    documents; ``head`` is the first pair of each previous word in a part.
    """

    first: np.ndarray
    distinct: np.ndarray
    ending: np.ndarray
    word: np.ndarray
    pair: np.ndarray
    key: np.ndarray
    before: np.ndarray
    follower: np.ndarray
    part: np.ndarray
    head: np.ndarray


def _pairs(docs: pa.Table, hot: np.ndarray, parts: int) -> Pairs:
    """``hot`` previous words (sorted) are spread over all parts; any other lies whole in one part."""
    hashes, endings, lengths = ([np.empty(0, np.int64)] for _ in range(3))
    for run in runs(docs.column("text")):
        h, e = _words(run)
        hashes.append(_with_ends(run, h, END_HASH)[0])
        endings.append(_with_ends(run, e, END)[0])
        lengths.append(np.diff(run.word_bounds) + 1)
    distinct, word = _numbered(np.concatenate(hashes))
    ending = np.empty(len(distinct), np.int64)
    ending[word] = np.concatenate(endings)
    end = np.searchsorted(distinct, END_HASH)
    last = np.empty(len(word), np.int64)
    last[:1] = end
    last[1:] = word[:-1]  # the word after an end follows that end
    before, follower, pair = _numbered_pairs(last, word, len(distinct))
    key = _pair_keys(distinct[before], distinct[follower])
    home = (scatter(distinct.view(U)) % U(parts)).astype(np.int32)
    spread = np.isin(distinct, hot)
    part = np.where(spread[before], (key.view(U) >> U(20)) % U(parts), home[before]).astype(np.int32)
    # Pairs are in order of their words; few bytes of a part are sorted by counting.
    order = np.argsort(part.astype(np.min_scalar_type(parts)), kind="stable")
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    before, part = before[order], part[order]
    new = np.ones(len(order), bool)
    new[1:] = (before[1:] != before[:-1]) | (part[1:] != part[:-1])
    return Pairs(sums(np.concatenate(lengths), np.int64), distinct, ending, word.astype(np.int32), place[pair],
                 key[order], before, follower[order], part, np.flatnonzero(new))


def _pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return scatter(before.view(U) * U(0x9E3779B97F4A7C15) + word.view(U))


# Bytes of a pair's hash that are sent: it need only differ from the other followers of one word in one part.
KEY_BYTES = 6


def _binaries(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive stretches of rows of ``values`` as binary values; ``sizes`` counts their rows."""
    offsets = sums(sizes * values[:1].nbytes if len(values) else sizes * 0, np.int32)
    data = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), data])


def _bytes(column: pa.ChunkedArray) -> np.ndarray:
    """The bytes of all values of a binary column, one after another."""
    parts = [np.empty(0, np.uint8)]
    for values in column.chunks:
        if not len(values):
            continue
        offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
        if values.buffers()[2] is not None:
            parts.append(np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]])
    return np.concatenate(parts)


def _sizes(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """How many numbers of ``width`` bytes each value of a binary column holds."""
    return pc.binary_length(column).to_numpy().astype(np.int64) // width


def _counts(name: str, values: np.ndarray, sizes: np.ndarray) -> dict[str, pa.Array]:
    """Counts as two binary columns: a byte each, and those beyond a byte in full."""
    large = values >= 255
    of = np.diff(sums(large, np.int64)[sums(sizes, np.int64)])
    return {name: _binaries(np.minimum(values, 255).astype(np.uint8), sizes),
            f"{name}_large": _binaries(values[large].astype(np.int64), of)}


def _counted(rows: pa.Table, name: str) -> np.ndarray:
    values = _bytes(rows.column(name)).astype(np.int64)
    values[values == 255] = _bytes(rows.column(f"{name}_large")).view(np.int64)
    return values


def _binary_columns(*names: str) -> str:
    return ", ".join(f"{n} binary, {n}_large binary" for n in names)


_ASKED = f"part int, chunk int, words binary, pairs binary, {_binary_columns('counts', 'followers', 'seen')}"


def _by_part(p: Pairs) -> tuple[np.ndarray, ...]:
    """Parts; each restaurant's previous word and number of pairs; restaurants and pairs of each part."""
    own, first, groups = np.unique(p.part[p.head], return_index=True, return_counts=True)
    return own, p.before[p.head], np.diff(np.append(p.head, len(p.key))), groups, np.diff(np.append(p.head[first], len(p.key)))


def _ask(hot: np.ndarray, parts: int):
    """One row a part: a chunk's previous words there, how often each occurs in training texts, how many
    pairs it begins, and each pair's hash and training count."""

    def ask(docs: pa.Table) -> pa.Table:
        p = _pairs(docs, hot, parts)
        train = np.repeat(docs.column("train").to_numpy(), np.diff(p.first))
        counts = np.bincount(p.word[train], minlength=len(p.distinct))
        seen = np.bincount(p.pair[train], minlength=len(p.key))
        own, owner, followers, groups, sizes = _by_part(p)
        key = p.key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
        return pa.table({
            "part": own, "chunk": np.full(len(own), docs.column("chunk")[0].as_py(), np.int32),
            "words": _binaries(p.distinct[owner], groups), "pairs": _binaries(key, sizes),
            **_counts("counts", counts[owner], groups), **_counts("followers", followers, groups),
            **_counts("seen", seen, sizes),
        })

    return ask


_SENT = f"chunk int, part int, {_binary_columns('counts', 'kinds', 'totals')}, sums array<bigint>"


def _answer(hot: np.ndarray, samples: int = 0):
    """Training counts of the words and pairs of a part and each word's kinds of followers, sent back in the
    order they were asked for. One more row (no chunk) has the kinds that follow each hot word here, and how many
    pairs were seen once and twice. Of seated restaurants the part's tables are told too, as sums over the
    samples: of each pair what is above one table, and of each word all in place of its kinds."""

    def answer(asked: pa.Table, seated: pa.Table | None) -> pa.Table:
        words, groups = _bytes(asked.column("words")).view(np.int64), _sizes(asked.column("words"), 8)
        sizes = _sizes(asked.column("pairs"), KEY_BYTES)
        key = np.zeros((sizes.sum(), 8), np.uint8)
        key[:, :KEY_BYTES] = _bytes(asked.column("pairs")).reshape(-1, KEY_BYTES)
        own, word = _numbered(words)
        counts = np.bincount(word, _counted(asked, "counts"), len(own)).astype(np.int64)
        before = np.repeat(word, _counted(asked, "followers"))
        key = _pair_keys(own[before], key.view("<u8").ravel())
        pair, found = pd.factorize(key)
        owner = np.empty(len(found), np.int64)
        owner[pair] = before
        totals = np.bincount(pair, _counted(asked, "seen"), len(found)).astype(np.int64)
        kinds = np.bincount(owner[totals > 0], minlength=len(own))
        tables = {}
        if samples:
            above = np.zeros(len(found), np.int64)
            above[_repeated(totals, owner, found)] = _counted(seated, "sums") - samples
            kinds = samples * kinds + np.bincount(owner, above, len(own)).astype(np.int64)
            tables = _counts("tables", above[pair], sizes)
        at = np.minimum(np.searchsorted(own, hot), len(own) - 1)
        facts = [*np.where(own[at] == hot, kinds[at], 0).tolist(), int((totals == 1).sum()), int((totals == 2).sum())]
        rows = pa.table({
            "chunk": asked.column("chunk"), "part": asked.column("part"), **_counts("counts", counts[word], groups),
            **_counts("kinds", kinds[word], groups), **_counts("totals", totals[pair], sizes),
            "sums": pa.nulls(asked.num_rows, pa.list_(pa.int64())), **tables,
        })
        last = {f.name: pa.nulls(1, f.type) for f in rows.schema} | {"sums": pa.array([facts], pa.list_(pa.int64()))}
        return pa.concat_tables([rows, pa.table(last)])

    return answer if samples else lambda asked: answer(asked, None)


def _repeated(totals: np.ndarray, owner: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Pairs that occur more than once in training texts, by previous words and keys: only these can have more
    than one table."""
    many = np.flatnonzero(totals > 1)
    return many[np.lexsort((keys[many], owner[many]))]


_GATHERED = f"part int, words binary, endings binary, pairs binary, pair_endings binary, {_binary_columns('followers', 'seen')}"


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Documents in stretches of about ``STRETCH_BYTES`` of text."""
    kept, size = [], 0
    for batch in batches:
        docs = pa.Table.from_batches([batch])
        ends = np.cumsum(pc.fill_null(pc.binary_length(docs.column("text")), 0).to_numpy().astype(np.int64))
        first = 0
        while first < len(ends):
            passed = ends[first - 1] if first else 0
            last = min(int(np.searchsorted(ends, passed + STRETCH_BYTES - size)) + 1, len(ends))
            kept.append(docs.slice(first, last - first))
            size += int(ends[last - 1] - passed)
            if size >= STRETCH_BYTES:
                yield pa.concat_tables(kept)
                kept, size = [], 0
            first = last
    if kept:
        yield pa.concat_tables(kept)


def _count_word_pairs(hot: np.ndarray, parts: int):
    """One row a part and stretch of documents: previous words, how many pairs each begins, the words that
    follow and how often; endings tell the classes of words that are not frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs in _stretches(batches):
            p = _pairs(docs, hot, parts)
            own, owner, followers, groups, sizes = _by_part(p)
            ending = (p.ending - FREQUENT).astype(np.uint8)  # the end of a text is known by its hash
            yield from pa.table({
                "part": own, "words": _binaries(p.distinct[owner], groups), "endings": _binaries(ending[owner], groups),
                "pairs": _binaries(p.distinct[p.follower], sizes), "pair_endings": _binaries(ending[p.follower], sizes),
                **_counts("followers", followers, groups), **_counts("seen", np.bincount(p.pair, minlength=len(p.key)), sizes),
            }).to_batches()

    return count


_CELLS = _binary_columns("cells", "times")
_OPEN = f"part int, before binary, hot binary, class binary, {_binary_columns('single', 'dishes', 'count')}"
_RESTAURANTS = f"{_OPEN}, word binary, {_CELLS}, sums array<bigint>"


def _one_row(schema: str, counts: dict[str, np.ndarray], **columns) -> pa.Table:
    """Arrays as binary values of one row, ``counts`` in two columns each; Arrow arrays as they are."""
    out = {k: v if isinstance(v, (pa.Array, pa.ChunkedArray)) else pa.array([v.tobytes()], pa.binary())
           for k, v in columns.items()}
    for name, values in counts.items():
        out |= _counts(name, values, np.array([len(values)]))
    return pa.table(out).select(_names(schema))


def _array(row: pa.Table, name: str, dtype) -> np.ndarray:
    return _bytes(row.column(name)).view(dtype)


def _cells(before: np.ndarray, klass: np.ndarray, tables: np.ndarray) -> dict[str, np.ndarray]:
    """Tables of each pair of classes, as customers of the class restaurants; of the pairs the steps between them."""
    cell, number = np.unique(before * CLASSES + klass, return_inverse=True)
    return {"cells": np.diff(cell, prepend=0), "times": np.bincount(number, tables, len(cell)).astype(np.int64)}


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    for batch in batches:
        for n in range(batch.num_rows):
            yield pa.Table.from_batches([batch.slice(n, 1)])


def _class_pairs(table: np.ndarray) -> pa.RecordBatch:
    used = np.flatnonzero(table)
    return pa.RecordBatch.from_arrays(
        [pa.array(used // CLASSES, pa.int32()), pa.array(used % CLASSES, pa.int32()), pa.array(table[used])],
        ["before", "class", "count"],
    )


def _sum_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The class pairs of all rows of a task, with their tables."""
    table = np.zeros(CLASSES * CLASSES, np.int64)
    for row in _rows(batches):
        table[np.cumsum(_counted(row, "cells"))] += _counted(row, "times")
    yield _class_pairs(table)


def _sum_dishes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The class pairs of all dishes of a task, with one table each."""
    table = np.zeros(CLASSES * CLASSES, np.int64)
    for row in _rows(batches):
        before, klass = (_array(row, k, np.int16).astype(np.int64) for k in ("before", "class"))
        table += np.bincount(np.repeat(before, _counted(row, "dishes")) * CLASSES + klass, minlength=len(table))
    yield _class_pairs(table)


def _restaurants(frequent: np.ndarray, rank: np.ndarray, hot: np.ndarray):
    """The restaurants of a part as one row: class of each previous word, its number if it is hot, how many
    followers were seen once, each at its own table, and how many more than once. Those are the dishes that are
    seated: class, count, and the word if it shares its class. With the class pairs of the pairs seen once, the kinds
    that follow each hot word here, and how many pairs were seen once and twice."""

    def gather(rows: pa.Table) -> pa.Table:
        own, word = _numbered(_array(rows, "words", np.int64))
        ending = np.empty(len(own), np.int64)
        ending[word] = _array(rows, "endings", np.uint8)
        klass = _classes(own, FREQUENT + ending, frequent, rank)
        klass[own == END_HASH] = END
        before, follower = np.repeat(word, _counted(rows, "followers")), _array(rows, "pairs", np.int64)
        sent = _pair_keys(own[before], follower) & U((1 << 8 * KEY_BYTES) - 1)
        pair, found = pd.factorize(_pair_keys(own[before], sent))
        totals = np.bincount(pair, _counted(rows, "seen"), len(found)).astype(np.int64)
        at = np.empty(len(found), np.int64)
        at[pair] = np.arange(len(pair))
        owner, follower = before[at], follower[at]
        follows = _classes(follower, FREQUENT + _array(rows, "pair_endings", np.uint8)[at].astype(np.int64), frequent, rank)
        follows[follower == END_HASH] = END
        number = np.minimum(np.searchsorted(hot, own), len(hot) - 1)
        number = np.where(hot[number] == own, number, -1)
        once, many = totals == 1, _repeated(totals, owner, found)
        kinds = np.bincount(number[owner][number[owner] >= 0], minlength=len(hot))
        dishes = np.bincount(owner[many], minlength=len(own))
        open_ = (dishes > 0) | (number >= 0)
        return _one_row(
            _RESTAURANTS,
            {"single": np.bincount(owner[once], minlength=len(own))[open_], "dishes": dishes[open_], "count": totals[many],
             **_cells(klass[owner[once]], follows[once], np.ones(once.sum()))},
            part=rows.column("part")[:1], before=klass[open_].astype(np.int16), hot=number[open_].astype(np.int16),
            word=follower[many][_many_words(follows[many])], **{"class": follows[many].astype(np.int16)},
            sums=pa.array([[*kinds.tolist(), int(once.sum()), int((totals == 2).sum())]], pa.list_(pa.int64())),
        )

    return gather


def _many_words(klass: np.ndarray) -> np.ndarray:
    return (klass >= FREQUENT) & (klass != END)


def _words_of_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct words among the dishes of each part."""
    for row in _rows(batches):
        word = np.unique(_array(row, "word", np.int64))
        part = np.full(len(word), row.column("part")[0].as_py(), np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(word)], ["part", "word"])


def _by_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a task with their counts, one row a part."""
    columns = [[np.empty(0, np.int64)] for _ in range(3)]
    for batch in batches:
        for values, name in zip(columns, ("part", "word", "count")):
            values.append(batch.column(name).to_numpy().astype(np.int64))
    part, word, count = map(np.concatenate, columns)
    order = np.argsort(part, kind="stable")
    own, sizes = np.unique(part, return_counts=True)
    yield pa.RecordBatch.from_arrays(
        [pa.array(own, pa.int32()), _binaries(word[order], sizes), _binaries(count[order], sizes)], ["part", "word", "count"])


def _with_shares(model: Model):
    """Restaurants of a part with each dish's chance within its class, in place of the word."""

    def share(here: pa.Table, words: pa.Table) -> pa.Table:
        klass = _array(here, "class", np.int16).astype(np.int64)
        known, count = _array(words, "word", np.int64), _array(words, "count", np.int64)
        order = np.argsort(known)
        at = np.searchsorted(known[order], _array(here, "word", np.int64))
        many = _many_words(klass)
        shares = 10.0 ** model.log_word(klass[many], count[order][at])
        return here.drop_columns(["word"]).append_column("share", pa.array([shares.astype(np.float32).tobytes()]))

    return share


_STATE = f"part int, {_binary_columns('tables', 'when', 'sums')}, {_CELLS}, hot array<bigint>"


def _seat_words(log_class: np.ndarray, discount: float, turn: int, hot_tables: np.ndarray):
    """One round of the word restaurants of a part, over ``log_class``; ``hot_tables`` are all tables of each hot word
    before it. A pair seen once has one table, so only the other pairs are reseated."""

    def seat(here: pa.Table, now: pa.Table | None) -> pa.Table:
        before, number, klass = (_array(here, k, np.int16).astype(np.int64) for k in ("before", "hot", "class"))
        count, single = _counted(here, "count"), _counted(here, "single")
        owner, n = np.repeat(np.arange(len(before)), _counted(here, "dishes")), len(count)
        base = 10.0 ** log_class[before[owner], klass].astype(np.float64)
        base[_many_words(klass)] *= _array(here, "share", np.float32)
        tables = np.ones(n, np.int64) if now is None else _counted(now, "tables")
        sums_of = np.zeros(n, np.int64) if now is None else _counted(now, "sums")
        mine = np.bincount(owner, tables, len(before)).astype(np.int64)
        elsewhere = np.where(number >= 0, hot_tables[number] - mine, single)
        draw = np.random.default_rng([turn, here.column("part")[0].as_py()])
        few, many = np.flatnonzero(count <= FEW), np.flatnonzero(count > FEW)
        of_few, of_many = ((count[d], owner[d], base[d], discount, STRENGTH, draw) for d in (few, many))
        seating = None if now is None else Seating(np.repeat(np.arange(len(many)), tables[many]), _counted(now, "when"))
        for _ in range(WORD_SWEEPS):
            around = elsewhere + np.bincount(owner, tables, len(before)).astype(np.int64)
            tables[few] = reseat_few(tables[few], *of_few, around)
            around = (elsewhere + np.bincount(owner[few], tables[few], len(before)).astype(np.int64))[owner[many]]
            if seating is None:
                seating = extend(None, *of_many, elsewhere=around)
            seating = sweep(seating, *of_many, elsewhere=around)
            tables[many] = seating.tables(len(many))
        sums_of += tables * (turn >= BURN_IN)
        of_hot = np.zeros(len(hot_tables), np.int64)
        held = number >= 0
        of_hot[number[held]] = (np.bincount(owner, tables, len(before)).astype(np.int64) + single)[held]
        return _one_row(
            _STATE, {"tables": tables, "when": seating.when, "sums": sums_of, **_cells(before[owner], klass, tables)},
            part=here.column("part"), hot=pa.array([of_hot.tolist()], pa.list_(pa.int64())),
        )

    return seat if turn else lambda here: seat(here, None)


def _sum_arrays(rows: DataFrame, name: str, n: int) -> np.ndarray:
    """Sums over all rows of the places of an array of ``n`` numbers."""
    each = rows.select(F.posexplode(name)).groupBy("pos").agg(F.sum("col").alias("n")).toPandas()
    out = np.zeros(n, np.int64)
    out[each["pos"].to_numpy(np.int64)] = each["n"].to_numpy(np.int64)
    return out


def fit_words(training: DataFrame, counts: DataFrame, parts: int) -> tuple[Model, DataFrame, np.ndarray, int]:
    """Seatings of word and class restaurants in turn: the model, the sums of tables of each part's pairs seen more
    than once, those of each hot word with the numbers of pairs seen once and twice, and how many samples are summed.

    The class restaurants' customers are the tables of all word restaurants, instead of all tokens. To the driver
    come what ``fit`` brings there, and the tables of each hot word.
    """
    model = _vocabulary(counts)
    hot = np.sort(np.append(model.frequent, END_HASH))
    spark = training.sparkSession
    folder = new_folder(spark, "word-seating")
    restaurants = stage_and_free(
        training.select("text").mapInArrow(_count_word_pairs(hot, parts), _GATHERED)
        .groupBy("part").applyInArrow(_restaurants(model.frequent, model.rank, hot), _RESTAURANTS), folder, "restaurants",
    )
    facts = _sum_arrays(restaurants, "sums", len(hot) + 2)
    hot_tables, hot_sums, discount = facts[:-2], np.zeros(len(hot), np.int64), _discount(*facts[-2:])
    words = restaurants.select("part", "word").mapInArrow(_words_of_parts, "part int, word bigint").join(
        counts.select("word", "count"), "word").select("part", "word", "count").mapInArrow(_by_parts, "part int, word binary, count binary")
    here = stage_and_free(
        restaurants.select(*_names(_OPEN), "word").groupBy("part").cogroup(words.groupBy("part"))
        .applyInArrow(_with_shares(model), f"{_OPEN}, share binary"), folder, "dishes",
    ).groupBy("part")
    once = stage_and_free(restaurants.select(*_names(_CELLS)).mapInArrow(_sum_cells, _CLASS_PAIRS)
                          .groupBy("before", "class").agg(F.sum("count").alias("count")), folder, "class-pairs")

    def customers(tables: DataFrame) -> DataFrame:
        return once.unionByName(tables).groupBy("before", "class").agg(F.sum("count").alias("count"))

    least = restaurants.select("before", "class", "dishes", "dishes_large").mapInArrow(_sum_dishes, _CLASS_PAIRS)
    classes, state = _Classes(stage_and_free(customers(least), folder, "class-pairs"), folder), None
    for turn in range(ROUNDS):
        if state is not None:
            classes.recount(customers(state.select(*_names(_CELLS)).mapInArrow(_sum_cells, _CLASS_PAIRS)))
        seat = _seat_words(_log(classes.round(turn)), discount, turn, hot_tables)
        told = here.applyInArrow(seat, _STATE) if state is None else here.cogroup(state.groupBy("part")).applyInArrow(seat, _STATE)
        state = stage_and_free(told, folder, "tables")
        hot_tables = _sum_arrays(state, "hot", len(hot))
        hot_sums += hot_tables * (turn >= BURN_IN)
    tables = stage(state.select("part", *_names(_binary_columns("sums"))), "tables")
    drop_folder(spark, folder)
    return replace(model, log_class=_log(classes.total / classes.samples)), tables, np.append(hot_sums, facts[-2:]), classes.samples


def _chance(seen: np.ndarray, customers: np.ndarray, kinds: np.ndarray, base: np.ndarray, discount: float) -> np.ndarray:
    """P(word | previous word): ``seen`` is the pair's count (less the discounts of its tables above one), ``kinds`` the
    restaurant's tables, ``base`` the parent's chance."""
    return (np.maximum(seen - discount, 0.0) + (STRENGTH + discount * kinds) * base) / (STRENGTH + customers)


_SCORES = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _score(model: Model, hot: np.ndarray, hot_counts: np.ndarray, parts: int, samples: int = 0):
    def score(docs: pa.Table, sent: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({f.split()[0]: pa.array([], pa.float64() if "score" in f else pa.int64()) for f in _SCORES.split(", ")})
        p = _pairs(docs, hot, parts)
        facts = sent.filter(pc.is_null(sent.column("part"))).column("sums")[0].values.to_numpy()
        answers = sent.filter(pc.is_valid(sent.column("part"))).sort_by("part")
        seen, discount = _counted(answers, "totals"), _discount(*facts[-2:])
        owner = p.before[p.head]
        customers, kinds = np.zeros(len(p.distinct), np.int64), np.zeros(len(p.distinct), np.int64)
        customers[owner], kinds[owner] = _counted(answers, "counts"), _counted(answers, "kinds")
        # A hot word's pairs lie under several parts: its sums over all of them come with the facts.
        at = np.minimum(np.searchsorted(hot, p.distinct), len(hot) - 1)
        same = hot[at] == p.distinct
        customers[same], kinds[same] = hot_counts[at[same]], facts[at[same]]
        if samples:  # means of the tables
            kinds, seen = kinds / samples, seen - discount * (_counted(answers, "tables") / samples)
        # Once for each distinct word and pair, then read off by the tokens.
        klass = _classes(p.distinct, p.ending, model.frequent, model.rank)
        klass[p.distinct == END_HASH] = END
        base = np.log10((customers + 0.1) / (model.tokens + 0.1 * (model.distinct + 1)))
        inside = model.log_word(klass, customers)
        parent = 10.0 ** (model.log_class[klass[p.before], klass[p.follower]] + inside[p.follower])
        own = np.log10(_chance(seen, customers[p.before], kinds[p.before], parent, discount))
        starts = p.first[:-1]
        return pa.table({
            "doc_id": docs.column("doc_id"), "n_tokens": np.diff(p.first),
            "n_known": np.add.reduceat((customers > 0).astype(np.int64)[p.word], starts),
            "base_score": np.add.reduceat(base[p.word], starts), "score": np.add.reduceat(own[p.pair], starts),
        })

    return score


def score_texts(df: DataFrame, row_id: str = "doc_id", text: str = "text", folds: int = 10,
                chunk_bytes: int = CHUNK_BYTES, seated: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Learned from the rows that are not held out. Null and empty texts are one token, the end.
    Repeated rows count and score as often as they are there; a null id is allowed; an empty
    table gives no rows. Without training rows every word is unknown.

    ``seated``: the words' restaurants are seated by chains as those of the classes, whose customers are then
    their tables. Else a kind of follower has one table, and the classes learn from all tokens.
    """
    docs = df.select(F.col(row_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    training = docs.where(~held_out("doc_id", folds))
    counts = stage_and_free(word_counts(training), shared_folder(df.sparkSession), "word-counts")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    parts = max(1, -(-size // (2 * chunk_bytes)))
    spark = df.sparkSession
    if seated:
        model, tables, sums_of, samples = fit_words(training, counts, parts)
    else:
        model, samples = fit(training, counts), 0
    hot = np.sort(np.append(model.frequent, END_HASH))
    chunk: Column = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int")
    train = ~held_out("doc_id", folds)
    dealt = docs.select(chunk.alias("chunk"), train.alias("train"), "doc_id", "text").repartition("chunk")
    asked = dealt.groupBy("chunk").applyInArrow(_ask(hot, parts), _ASKED).groupBy("part")
    if seated:
        sent = asked.cogroup(tables.groupBy("part")).applyInArrow(_answer(hot, samples), f"{_SENT}, {_binary_columns('tables')}")
        facts = spark.createDataFrame([(sums_of.tolist(),)], "sums array<bigint>")
    else:
        sent = asked.applyInArrow(_answer(hot), _SENT)
        each = sent.where("chunk is null").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("n"))
        facts = each.agg(F.sort_array(F.collect_list(F.struct("pos", "n"))).alias("sums")).select(F.col("sums.n").alias("sums"))
    # One row a chunk, so that the texts are shuffled once: its sums are known before the second use.
    all_chunks = spark.range(chunks).select(F.col("id").cast("int").alias("chunk"))
    told = sent.where("chunk is not null").unionByName(all_chunks.join(F.broadcast(facts)), allowMissingColumns=True)
    own = spark.createDataFrame([(int(h),) for h in hot], "word bigint").join(counts, "word").toPandas()
    hot_counts = np.zeros(len(hot), np.int64)
    hot_counts[np.searchsorted(hot, own["word"].to_numpy(np.int64))] = own["count"].to_numpy(np.int64)
    score = _score(model, hot, hot_counts, parts, samples)
    scored = dealt.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(score, _SCORES)
    return scored.withColumn("held_out", held_out("doc_id", folds)).withColumn(
        "train_tokens", F.lit(model.tokens).cast("bigint")
    )
