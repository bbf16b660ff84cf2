"""Quality classifier: random-indexing word vectors, pooled per document, and a small network.

A token is a run of letters, of digits or of other signs; it is hashed into one of ``BUCKETS``,
with separate ranges for words, all-capital words, digits and signs. Every bucket has a sparse
random index vector, fixed by its number. Its context vector is the sum of the index vectors of
its neighbours over the whole corpus: each task adds up a table of fixed size, and Spark adds up
the tables. A document is the mean of its tokens' vectors, each with its range marked.

A two-layer network is fitted to a bounded sample of labelled rows (``max_labelled``, drawn by
the hash of the id). A tenth of the sample sets one temperature that calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from titleweave.llm.common import stage, unit
from titleweave.llm.wordhash import U, Run, powers, runs, scatter, sums, _BYTE

RANGES = (5120, 1024, 512, 1536)  # words, capital words, digits, signs
BUCKETS = sum(RANGES)
FIRST = np.cumsum((0, *RANGES[:-1]))
SIZE = 32
NONZERO = 4
WIDTH = SIZE + len(RANGES) + 2

_KIND = np.full(256, 3, np.int8)
for _c in range(256):
    if _c >= 128 or chr(_c).isalpha():
        _KIND[_c] = 0
    elif chr(_c).isdigit():
        _KIND[_c] = 2
_KIND[[9, 10, 11, 12, 13, 32]] = -1
_SMALL = np.array([97 <= c <= 122 for c in range(256)])
_CAPITAL = np.array([65 <= c <= 90 for c in range(256)])


def _index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the nonzero entries of every bucket's index vector."""
    draw = scatter(np.arange(BUCKETS * NONZERO, dtype=U) + U(77)).reshape(BUCKETS, NONZERO)
    return (draw % U(SIZE)).astype(np.int64), np.where(draw >> U(63), 1.0, -1.0)


def tokens(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every token of a run, and the first token of each document."""
    data = run.data
    if not len(data):
        return np.empty(0, np.int64), np.zeros(len(run) + 1, np.int64)
    kind = _KIND[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[run.bounds[:-1][run.bounds[:-1] < len(data)]] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(data))
    shown = kind[start] >= 0
    start, end = start[shown], end[shown]
    up, down = powers(0x9E3779B97F4A7C15, len(data) + 1)
    total = sums(_BYTE[data] * up[1:])
    hashes = scatter((total[end] - total[start]) * down[start])
    small, capital = sums(_SMALL[data], np.int64), sums(_CAPITAL[data], np.int64)
    which = kind[start].astype(np.int64)
    which[(which == 0) & (small[end] == small[start]) & (capital[end] > capital[start])] = 1
    bucket = FIRST[which] + (hashes % np.array(RANGES, U)[which]).astype(np.int64)
    return bucket, np.searchsorted(start, run.bounds)


def _count_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One table of context vectors for the whole partition."""
    places, signs = _index_vectors()
    table = np.zeros(BUCKETS * SIZE)
    for batch in batches:
        for run in runs(batch.column("text")):
            bucket, first = tokens(run)
            if len(bucket) < 2:
                continue
            near = np.ones(len(bucket) - 1, bool)
            near[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(bucket))] - 1] = False
            a, b = bucket[:-1][near], bucket[1:][near]
            for k in range(NONZERO):
                table += np.bincount(a * SIZE + places[b, k], signs[b, k], len(table))
                table += np.bincount(b * SIZE + places[a, k], signs[a, k], len(table))
    rows = table.reshape(BUCKETS, SIZE)
    used = np.flatnonzero(rows.any(axis=1))
    vectors = pa.FixedSizeListArray.from_arrays(pa.array(rows[used].reshape(-1)), SIZE).cast(pa.list_(pa.float64()))
    yield pa.RecordBatch.from_arrays([pa.array(used), vectors], ["bucket", "vector"])


def word_vectors(df: DataFrame, text: str = "text") -> np.ndarray:
    """BUCKETS x (SIZE + ranges): context vectors of unit length, and the range of each bucket."""
    counted = df.select(F.col(text).alias("text")).mapInArrow(_count_contexts, "bucket bigint, vector array<double>")
    summed = counted.groupBy("bucket").agg(*[F.sum(F.col("vector")[i]).alias(f"v{i}") for i in range(SIZE)])
    out = np.zeros((BUCKETS, SIZE + len(RANGES)), np.float32)
    found = summed.toPandas()
    rows = found.drop(columns="bucket").to_numpy(np.float64)
    length = np.sqrt((rows**2).sum(axis=1, keepdims=True))
    out[found["bucket"].to_numpy(), :SIZE] = rows / np.maximum(length, 1e-9)
    for n, (first, size) in enumerate(zip(FIRST, RANGES)):
        out[first : first + size, SIZE + n] = 1.0
    return out


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean token vector of every text, its log length and its share of distinct tokens; zeros if empty."""
    out = []
    for run in runs(column):
        bucket, first = tokens(run)
        n = np.diff(first)
        rows = np.zeros((len(run), WIDTH), np.float32)
        filled = np.flatnonzero(n)
        if len(filled):
            rows[filled, : vectors.shape[1]] = (
                np.add.reduceat(vectors[bucket], first[:-1][filled], axis=0) / n[filled, None]
            )
            owner = np.repeat(np.arange(len(run)), n)
            distinct = np.bincount(np.unique(owner * BUCKETS + bucket) // BUCKETS, minlength=len(run))
            rows[:, -2] = np.log1p(n)
            rows[:, -1] = distinct / np.maximum(n, 1)
        out.append(rows)
    return np.concatenate(out) if out else np.zeros((0, WIDTH), np.float32)


def document_vectors(df: DataFrame, vectors: np.ndarray, row_id: str = "doc_id", text: str = "text") -> DataFrame:
    @F.arrow_udf(ArrayType(FloatType()))
    def pool(texts: pa.Array) -> pa.Array:
        rows = pooled(texts, vectors)
        return pa.FixedSizeListArray.from_arrays(pa.array(rows.reshape(-1)), WIDTH).cast(pa.list_(pa.float32()))

    return df.select(F.col(row_id).alias("doc_id"), pool(F.col(text)).alias("vector"))


@dataclass
class Network:
    """Standardised input, one hidden layer, one probability."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, rows: np.ndarray) -> np.ndarray:
        hidden = np.tanh((rows - self.mean) / self.scale @ self.w1 + self.b1)
        return hidden @ self.w2 + self.b2

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows) / self.temperature, -30, 30)))


def fit(rows: np.ndarray, labels: np.ndarray, hidden: int = 32, epochs: int = 60, step: float = 0.01,
        decay: float = 1e-4, seed: int = 11) -> Network:
    """Adam on minibatches; every tenth row is kept for the temperature. No rows give a score of one half."""
    width = rows.shape[1]
    draw = np.random.default_rng(seed)
    net = Network(np.zeros(width), np.ones(width), draw.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden),
                  np.zeros(hidden), 0.0)
    if not len(rows):
        return net
    turn = np.arange(len(rows)) % 10 == 9
    x, y = rows[~turn].astype(np.float64), labels[~turn].astype(np.float64)
    net.mean, net.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    x = (x - net.mean) / net.scale
    values = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, n = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for epoch in range(epochs):
        order = draw.permutation(len(x))
        for at in range(0, len(x), 256):
            part = order[at : at + 256]
            h = np.tanh(x[part] @ values[0] + values[1])
            error = (1 / (1 + np.exp(-np.clip(h @ values[2] + values[3], -30, 30))) - y[part]) / len(part)
            back = error[:, None] * values[2] * (1 - h * h)
            slopes = [x[part].T @ back + decay * values[0], back.sum(axis=0), h.T @ error + decay * values[2],
                      np.array([error.sum()])]
            n += 1
            for v, g, m, s in zip(values, slopes, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= step * 0.5 ** (epoch / 20) * (m / (1 - 0.9**n)) / (np.sqrt(s / (1 - 0.999**n)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = values[0], values[1], values[2], float(values[3][0])
    if turn.any():
        z, held = net.logits(rows[turn]), labels[turn]
        grid = np.geomspace(0.25, 8, 41)
        loss = [np.logaddexp(0, np.where(held == 1, -z, z) / t).mean() for t in grid]
        net.temperature = float(grid[int(np.argmin(loss))])
    return net


def held_out(row_id, folds: int):
    """Whether the CRC-32 of the id as text is a multiple of ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(row_id).cast("string"), F.lit("")).cast("binary")) % folds == 0


def quality_scores(df: DataFrame, labels: DataFrame, row_id: str = "doc_id", text: str = "text",
                   label: str = "quality", folds: int = 5, max_labelled: int = 20_000) -> DataFrame:
    """doc_id, held_out, score (0 to 1) for every row.

    Labels are learned from rows that are not held out. Null and empty texts get the score of an
    empty document; repeated rows score alike; without labels every score is one half; an empty
    table gives no rows. Of several labels of one id the largest counts.
    """
    table = stage(document_vectors(df, word_vectors(df, text), row_id, text), "document-vectors")
    table = table.withColumn("held_out", held_out("doc_id", folds))
    marks = labels.where(F.col(label).isNotNull() & F.col(row_id).isNotNull()).groupBy(
        F.col(row_id).alias("doc_id")
    ).agg(F.max(label).alias("label"))
    share = max_labelled / max(marks.count(), 1)
    chance = unit(F.col("doc_id"), F.lit("quality"))
    known = table.where(~F.col("held_out")).join(marks.where(chance < share), "doc_id")
    drawn = known.select("doc_id", chance.alias("chance"), "label", "vector").toPandas().sort_values(["chance", "doc_id"])
    rows = np.stack(drawn["vector"].to_numpy()).astype(np.float64) if len(drawn) else np.zeros((0, WIDTH))
    net = fit(rows, drawn["label"].to_numpy(np.float64))

    @F.arrow_udf(DoubleType())
    def judge(column: pa.Array) -> pa.Array:
        return pa.array(net.score(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH).astype(np.float64)))

    return table.select("doc_id", "held_out", judge(F.col("vector")).alias("score"))
