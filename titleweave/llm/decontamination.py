"""Benchmark decontamination: BM25 over test items, block-max bounds, then overlap of the words.

The index holds the test items, cut into segments of at most ``SEGMENT`` words, with BM25 impacts
divided by the segment's own score: a passage that holds a whole segment scores 1. Every training
document is read as overlapping passages of which one covers any segment in full, and each
passage queries the index for all segments at or above ``THRESHOLD``:

* per block of eight segments, the sum of its distinct words' largest impacts in the block bounds
  its score with all of them; nearly all passages end here;
* only the segments of blocks that can reach the threshold are scored.

The bounds are true upper bounds, so nothing above the threshold is lost. A hit is verified on the
words around it: five-word shingles of the question, and words of the answer (an item's last line,
or last sentence if it has one line).

Document frequencies, the number of segments and their mean length are counted once over the whole
benchmark. Tasks then build the index in parts of about ``PART_WORDS`` words, by the hash of the item, into
a staged table; as all parts share the statistics, scores do not depend on the cut. An index within the
bound of a broadcast goes to every task, which holds all parts against a batch of documents in one pass.
A larger one meets the documents, in chunks of distinct texts, in a shuffle.
"""

from __future__ import annotations

import math
import pickle
import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from titleweave.llm.common import free_name, stage
from titleweave.llm.wordhash import PUNCTUATION, U, Run, runs
from titleweave.session import MAX_BROADCAST_BYTES

SEGMENT = 64
STRIDE = 32
PASSAGE = SEGMENT + STRIDE
BLOCK = 8
THRESHOLD = 0.6
# Passages of a batch at most, and bounds that are held at a time: passages times blocks of a part.
PASSAGES = 4096
BOUNDS = 4_000_000
SHINGLE = 5
LEAST_OVERLAP = 0.8
PART_WORDS = 200_000
# Text that meets one part of a large index in one task, about.
CHUNK_BYTES = 64 * 2**20
K1, B = 1.2, 0.75

HIT = StructType([
    StructField("item_id", LongType()), StructField("score", DoubleType()),
    StructField("question_overlap", DoubleType()), StructField("answer_overlap", DoubleType()),
])
HITS = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("score", pa.float64()), ("question_overlap", pa.float64()), ("answer_overlap", pa.float64()),
]))


def _token_hashes(texts: list[str]) -> list[np.ndarray]:
    out = []
    for run in runs(pc.utf8_lower(pa.array(texts, pa.large_string())), between=PUNCTUATION):
        out += np.split(run.hashes(), run.word_bounds[1:-1])
    return out


def _shingles(words: np.ndarray) -> set[bytes]:
    if not len(words):
        return set()
    width = min(SHINGLE, len(words))
    return {words[i : i + width].tobytes() for i in range(len(words) - width + 1)}


def _ranges(first: np.ndarray, sizes: np.ndarray, step: int = 1) -> np.ndarray:
    """first, first + step, ... for each start, ``sizes`` numbers each, end to end."""
    number = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(first, sizes) + number * step


def question_and_answer(text: str) -> tuple[str, str]:
    """The last line is the answer, or the last sentence of a single line; one sentence has none."""
    lines = [line for line in text.split("\n") if line.strip()]
    if len(lines) > 1:
        return "\n".join(lines[:-1]), lines[-1]
    parts = re.split(r"(?<=[.?!])\s+", text.strip())
    return (" ".join(parts[:-1]), parts[-1]) if len(parts) > 1 else (text, "")


@dataclass
class Item:
    item_id: int
    length: int
    question_hashes: np.ndarray
    answer: set

    @property
    def question_words(self) -> int:
        return min(SHINGLE, len(self.question_hashes))

    @cached_property
    def question(self) -> set:
        return _shingles(self.question_hashes)


class Index:
    """Impacts of one part of the benchmark, by term and by block of segments.

    ``terms`` and ``found_in`` are the words of the part and the number of segments of the whole
    benchmark with them; ``total`` and ``mean`` are the number of all segments and their mean length.
    """

    def __init__(self, rows: list[tuple[int, str]], terms: np.ndarray, found_in: np.ndarray, total: int, mean: float):
        pairs = [question_and_answer(text) for _, text in rows]
        whole = _token_hashes([text for _, text in rows])
        questions = _token_hashes([q for q, _ in pairs])
        answers = _token_hashes([a for _, a in pairs])
        self.items = [
            Item(i, len(w), q, set(a.tolist()))
            for (i, _), w, q, a in zip(rows, whole, questions, answers)
        ]
        segments = [(n, w[a : a + SEGMENT]) for n, w in enumerate(whole) for a in range(0, len(w), SEGMENT)]
        self.item_of = np.array([n for n, _ in segments], np.int64)
        order = np.argsort(terms)
        self.terms, found_in = terms[order], found_in[order]
        term, segment, count = [], [], []
        for n, (_, words) in enumerate(segments):
            t, c = np.unique(np.searchsorted(self.terms, words), return_counts=True)
            term.append(t)
            segment.append(np.full(len(t), n))
            count.append(c)
        term, segment, count = map(np.concatenate, (term, segment, count))
        lengths = np.bincount(segment, count)
        idf = np.log(1 + (total - found_in + 0.5) / (found_in + 0.5))
        norm = K1 * (1 - B + B * lengths / mean)
        impact = idf[term] * count * (K1 + 1) / (count + norm[segment])
        impact /= np.bincount(segment, impact)[segment]
        order = np.argsort(term, kind="stable")
        self.segment, self.impact = segment[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        self.blocks = -(-len(segments) // BLOCK)
        cell = term * self.blocks + segment // BLOCK
        self.cells, place = np.unique(cell, return_inverse=True)
        self.cell_most = np.zeros(len(self.cells))
        np.maximum.at(self.cell_most, place, impact)
        self.cell_first = np.searchsorted(self.cells, np.arange(len(self.terms) + 1) * self.blocks)
        # A sieve on 16 bits of the hash: most words of a document are in no test item.
        self.sieve = np.zeros(1 << 16, bool)
        self.sieve[(self.terms >> U(48)).astype(np.int64)] = True

    def packed(self) -> bytes:
        """Plain values only: code reaches the tasks by value, where classes have no common name."""
        items = [(x.item_id, x.length, x.question_hashes, x.answer) for x in self.items]
        return pickle.dumps({**self.__dict__, "items": items})

    @classmethod
    def unpacked(cls, data: bytes) -> Index:
        index = cls.__new__(cls)
        index.__dict__.update(pickle.loads(data))
        index.items = [Item(*x) for x in index.items]
        return index

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers of words, -1 for words outside the index."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.sieve[(hashes >> U(48)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, hashes[maybe]), len(self.terms) - 1)
        known = self.terms[at] == hashes[maybe]
        out[maybe[known]] = at[known]
        return out

    def _gather(self, first: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all lists of these terms, and how many each has."""
        sizes = first[terms + 1] - first[terms]
        return _ranges(first[terms], sizes), sizes

    def search(self, passage: np.ndarray, terms: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Passages given as (passage, distinct term) pairs: all hits as passage, segment, score."""
        cells, size = self._gather(self.cell_first, terms)
        at = np.repeat(passage, size) * self.blocks + self.cells[cells] % self.blocks
        open_ = np.bincount(at, self.cell_most[cells], n * self.blocks) >= THRESHOLD - 1e-9
        some = open_.reshape(n, -1).any(axis=1)[passage]
        passage, terms = passage[some], terms[some]
        postings, size = self._gather(self.first, terms)
        passage, segment = np.repeat(passage, size), self.segment[postings]
        wanted = open_[passage * self.blocks + segment // BLOCK]
        key = passage[wanted] * len(self.item_of) + segment[wanted]
        pairs, place = np.unique(key, return_inverse=True)
        score = np.bincount(place, self.impact[postings[wanted]], len(pairs))
        hit = score >= THRESHOLD - 1e-9
        return pairs[hit] // len(self.item_of), pairs[hit] % len(self.item_of), score[hit]

    def _verify(self, item: Item, words: np.ndarray) -> tuple[float, float]:
        width = item.question_words
        there = {words[i : i + width].tobytes() for i in range(len(words) - width + 1)}
        question = len(item.question & there) / max(len(item.question), 1)
        answer = len(item.answer & set(words.tolist())) / len(item.answer) if item.answer else 1.0
        return question, answer

    def hits(self, run: Run) -> list[dict[int, tuple[float, float, float]]]:
        """Per document of a run: item -> best score and overlaps, verified items only."""
        out: list[dict[int, tuple[float, float, float]]] = [{} for _ in range(len(run))]
        hashes = run.hashes()
        terms = self.lookup(hashes)
        known = np.flatnonzero(terms >= 0)
        term = terms[known]
        # Where a document's word was met before; a passage counts each word once.
        key = run.document_of_words()[known] * len(self.terms) + term
        order = np.argsort(key, kind="stable")
        again = key[order][1:] == key[order][:-1]
        before = np.full(len(known), -1)
        before[order[1:][again]] = known[order[:-1][again]]
        steps = np.maximum(-(-(np.diff(run.word_bounds) - PASSAGE) // STRIDE), 0) + 1
        document = np.repeat(np.arange(len(run)), steps)
        start = _ranges(run.word_bounds[:-1], steps, STRIDE)
        stop = np.minimum(start + PASSAGE, run.word_bounds[document + 1])
        first, last = np.searchsorted(known, start), np.searchsorted(known, stop)
        step = max(min(PASSAGES, BOUNDS // self.blocks), 1)
        for a in range(0, len(start), step):
            part = slice(a, a + step)
            size = last[part] - first[part]
            at = _ranges(first[part], size)
            passage = np.repeat(np.arange(len(size)), size)
            new = before[at] < start[part][passage]
            for n, segment, score in zip(*self.search(passage[new], term[at[new]], len(size))):
                d, item = int(document[a + n]), self.items[self.item_of[segment]]
                low = max(int(start[a + n]) - item.length, int(run.word_bounds[d]))
                high = min(int(stop[a + n]) + item.length, int(run.word_bounds[d + 1]))
                question, answer = self._verify(item, hashes[low:high])
                if question >= LEAST_OVERLAP and answer >= LEAST_OVERLAP:
                    found = (float(score), question, answer)
                    out[d][item.item_id] = max(found, out[d].get(item.item_id, found))
        return out


@F.arrow_udf(ArrayType(LongType()))
def _hashes(texts: pa.Array) -> pa.Array:
    found = _token_hashes(texts.fill_null("").to_pylist())
    return pa.array([h.view(np.int64) for h in found], pa.list_(pa.int64()))


def indexes(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", part_words: int = PART_WORDS) -> DataFrame:
    """part, index: the packed parts of the index as a staged table.

    Items without words or id are left out; repeats are folded. No rows for an empty benchmark.
    """
    items = stage(
        benchmark.where(F.col(item_id).isNotNull() & F.col(text).isNotNull())
        .select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t")).distinct()
        .withColumn("words", _hashes("t")).where(F.size("words") > 0),
        "test-items",
    )
    n_segments = F.ceil(F.size("words") / SEGMENT)
    words, total = items.agg(F.sum(F.size("words")), F.sum(n_segments)).first()
    mean, parts = (words / total, math.ceil(words / part_words)) if words else (0.0, 1)
    starts = F.sequence(F.lit(0), (n_segments - 1).cast("int"))
    segments = F.transform(starts, lambda k: F.array_distinct(F.slice("words", k * SEGMENT + 1, SEGMENT)))
    found_in = items.select(F.explode(F.flatten(segments)).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("found_in"))
    cut = items.withColumn("part", F.pmod(F.xxhash64("i", "t"), F.lit(parts)).cast("int"))
    own = cut.select(F.col("part").alias("home"), F.explode(F.array_distinct("words")).alias("term")).distinct()
    terms = own.join(found_in, "term").select("home", "term", "found_in")

    def build(rows: pd.DataFrame, terms: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["i", "t"])
        hashes = terms.term.to_numpy(np.int64).view(np.uint64)
        index = Index(list(zip(rows.i.tolist(), rows.t)), hashes, terms.found_in.to_numpy(), total, mean)
        return pd.DataFrame({"part": [int(rows.part.iloc[0])], "index": [index.packed()]})

    built = cut.select("part", "i", "t").groupBy("part").cogroup(terms.groupBy("home")).applyInPandas(build, "part int, index binary")
    return stage(built, "test-index")


def _find(texts: pa.Array, parts: list[Index]) -> pa.Array:
    """Test items in texts, by item. An item that several parts hold under other texts counts by its best."""
    rows: list[list[dict]] = []
    for run in runs(pc.utf8_lower(texts.cast(pa.large_string())), between=PUNCTUATION):
        found: list[dict] = [{} for _ in range(len(run))]
        for index in parts:
            for own, new in zip(found, index.hits(run)):
                for item, hit in new.items():
                    own[item] = max(hit, own.get(item, hit))
        rows += [
            [{"item_id": i, "score": s, "question_overlap": q, "answer_overlap": a} for i, (s, q, a) in sorted(own.items())]
            for own in found
        ]
    return pa.array(rows, HITS)


def _in_every_task(text: Column, sent: Broadcast) -> Column:
    loaded: list[Index] = []

    @F.arrow_udf(ArrayType(HIT))
    def find(texts: pa.Array) -> pa.Array:
        if not loaded:
            loaded.extend(Index.unpacked(part) for part in sent.value)
        return _find(texts, loaded)

    return find(text)


def _by_meeting(df: DataFrame, parts: DataFrame, out: str, text: str) -> DataFrame:
    """Chunks of distinct texts meet the parts one by one; rows get their text's hits back by its digest."""
    digest, chunk = (free_name(df, n) for n in ("text_digest", "text_chunk"))
    keyed = df.withColumn(digest, F.sha2(F.coalesce(F.col(text), F.lit("")), 256))
    numbers = [r[0] for r in parts.select("part").collect()]  # a few bytes for each part of the index
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = size // CHUNK_BYTES + 1
    texts = (
        keyed.select(F.col(digest).alias("digest"), F.col(text).alias("text")).dropna().dropDuplicates(["digest"])
        .withColumn("chunk", F.pmod(F.xxhash64("digest"), F.lit(chunks)))
        .withColumn("part", F.explode(F.lit(numbers)))
    )
    spread = parts.withColumnRenamed("part", "number").withColumn("place", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(chunks - 1).cast("bigint"))))

    def find(texts: pa.Table, part: pa.Table) -> pa.Table:
        indexes = [Index.unpacked(p) for p in part["index"].to_pylist()]
        hits = _find(texts["text"].combine_chunks(), indexes) if len(texts) and indexes else pa.array([[]] * len(texts), HITS)
        return pa.table({"digest": texts["digest"], "hits": hits})

    both = texts.groupBy("chunk", "part").cogroup(spread.groupBy("place", "number"))
    found = both.applyInArrow(find, StructType().add("digest", "string").add("hits", ArrayType(HIT))).where(F.size("hits") > 0)
    # The best hit of each item over all parts, as in one task that sees them all.
    best = (
        found.select("digest", F.explode("hits").alias("hit")).groupBy("digest", "hit.item_id")
        .agg(F.max(F.struct("hit.score", "hit.question_overlap", "hit.answer_overlap")).alias("best"))
        .groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("item_id", "best.*"))).alias("hits"))
    )
    joined = keyed.join(best.select(F.col("digest").alias(chunk), F.col("hits").alias(out)), F.col(digest) == F.col(chunk), "left")
    return joined.drop(digest, chunk).withColumn(out, F.coalesce(F.col(out), F.array().cast(ArrayType(HIT))))


def with_leaks(
    df: DataFrame, benchmark: DataFrame, out: str, text: str = "text", part_words: int = PART_WORDS,
    max_broadcast: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``df`` with ``out``: array<struct<item_id, score, question_overlap, answer_overlap>>, sorted by item.

    Both ways to bring texts and index together give the same rows; the size of the index decides.
    """
    parts = indexes(benchmark, part_words=part_words)
    size = parts.agg(F.sum(F.octet_length("index"))).first()[0] or 0
    if size > max_broadcast:
        return _by_meeting(df, parts, out, text)
    sent = df.sparkSession.sparkContext.broadcast([bytes(r["index"]) for r in parts.orderBy("part").collect()])
    return df.withColumn(out, _in_every_task(F.col(text), sent))


def find_leaks(df: DataFrame, benchmark: DataFrame, row_id: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """doc_id, item_id, score, question_overlap, answer_overlap: one row per document row and test item in it.

    Null and blank texts leak nothing; repeated rows give repeated hits; an empty benchmark or
    table gives no rows. ``options`` as of ``with_leaks``.
    """
    rows = df.select(F.col(row_id).alias("doc_id"), F.col(text).alias("text"))
    return with_leaks(rows, benchmark, "hits", **options).select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def drop_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text", **options: int) -> DataFrame:
    """The rows of ``df`` that hold no test item. Same columns. ``options`` as of ``with_leaks``."""
    found = free_name(df, "leaked_items")
    return with_leaks(df, benchmark, found, text, **options).where(F.size(found) == 0).select(*df.columns)
