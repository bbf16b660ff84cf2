"""Alignment of two tokenizers over a corpus, with corpus-wide counts of token pairs that end together.

A chunk of documents is encoded by both tokenizers. Byte offsets where tokens of both end cut the
tokens into groups, and the two tokens that end there are linked. What is counted is kept outside
memory, as compressed runs:

1. Each chunk radix-partitions its records (pair, document, number) by the B token into sorted
   zstd runs, pairs apart from documents, and writes them as rows of one staged table.
2. The pairs of up to ``FAN_IN`` runs of a radix are merged over a heap, round after round, until
   one run per radix holds every pair's count. Pairs lie in B-major order, so the highest count of
   a B token is known as soon as the merge leaves it.
3. The runs' documents then stream against their radix's counts and give each chunk the sums of
   its documents, which are added up by chunk.

A pair or a B token that a third of all documents hold is one entry per chunk in the merge, and
its documents stay spread over groups of chunks; only the counts of one radix, bounded by the two
vocabularies, must fit a task.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleweave.llm.common import stage

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_BYTES = 4 << 20
RADICES = 32
FAN_IN = 32
CHUNKS_PER_GROUP = 1024
BLOCK_PAIRS = 8192

# A pair is one number, the B token above the A token.
_A_BITS = 20
_DOC_BITS = 24

# Fixed values of byte-level BPE: how text is split before merging, and the bytes that stand for
# themselves in vocabulary entries; all others stand as the code points from 256 on, in order.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_symbols() -> dict[str, int]:
    """Byte of each symbol of byte-level vocabulary entries."""
    others = [b for b in range(256) if b not in _PRINTABLE]
    return {chr(b): b for b in _PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Byte-level BPE from a vocabulary file whose ids rise in the order of its merges."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, symbols = content["model"]["vocab"], byte_symbols()
        special = {t["content"] for t in content["added_tokens"]}
        ranks = {bytes(symbols[c] for c in piece): i for piece, i in vocabulary.items() if piece not in special}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in content["model"]["merges"])
        merged = [vocabulary["".join(pair)] for pair in pairs]
        if any(x >= y for x, y in zip(merged, merged[1:])):
            raise ValueError(f"{path}: ids do not follow the merges")
        self.encoding = tiktoken.Encoding("byte_level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        by_id = {i: raw for raw, i in ranks.items()}
        self.bytes_of = [by_id.get(i, b"") for i in range(max(by_id) + 1)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class Pieces:
    """Sentence pieces with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.bytes_of = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Pair:
    """Both tokenizers with their tables of byte lengths and of separated ids."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.sizes = [np.array([len(x) for x in t.bytes_of], np.int64) for t in (self.a, self.b)]
        n_a, n_b = (len(s) for s in self.sizes)
        if n_a >= 1 << _A_BITS or n_b >= 1 << (64 - _A_BITS - _DOC_BITS):
            raise ValueError("vocabulary too large")
        self.names = [f"{i}{x}" for i in range(n_a) for x in ",|"]
        self.names += [f"{i}{x}" for i in range(n_b) for x in (",", ";", "")]
        self.b_names = 2 * n_a


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Pair:
    """Loaded once per worker."""
    return Pair(a_path, b_path)


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


class Aligned:
    """Tokens, groups and links of a chunk's texts; texts that do not come back whole have no tokens."""

    def __init__(self, texts: list[str | None], pair: Pair):
        self.pair = pair
        full = [t for t in texts if t]
        at = np.flatnonzero([bool(t) for t in texts])
        encoded = [t.encode(full) for t in (pair.a, pair.b)]
        whole = self._come_back(full, encoded)
        if not all(whole):
            at = at[np.array(whole, bool)]
            encoded = [[ids for ids, ok in zip(side, whole) if ok] for side in encoded]
        (self.a, a_sizes), (self.b, b_sizes) = (_flat(side) for side in encoded)
        a_ends, b_ends = (np.cumsum(s[x]) for s, x in zip(pair.sizes, (self.a, self.b)))
        met = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 1, bool)
        met[a_ends] = True
        self.b_joint = met[b_ends]
        met[:] = False
        met[b_ends] = True
        self.a_joint = met[a_ends]
        self.n_a, self.n_b = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        self.n_a[at], self.n_b[at] = a_sizes, b_sizes
        self.a_bounds, self.b_bounds = (np.r_[0, np.cumsum(n)] for n in (self.n_a, self.n_b))
        groups = np.r_[0, np.cumsum(self.a_joint)]
        self.group_bounds = groups[self.a_bounds]
        self.n_groups = np.diff(self.group_bounds)

    def _come_back(self, texts: list[str], encoded: list) -> list[bool]:
        """Which texts the tokens of both sides spell byte for byte, after a space."""
        want = [b" " + t.encode() for t in texts]
        spelled = [
            [b"".join(map(t.bytes_of.__getitem__, ids)) for ids in side]
            for t, side in zip((self.pair.a, self.pair.b), encoded)
        ]
        return [w == x == y for w, x, y in zip(want, *spelled)]

    def groups(self) -> Iterator[str]:
        """Ids of each text's groups, as ``a1,a2|b1;a3|b2,b3``."""
        a_place = np.cumsum(self.a_joint) - self.a_joint
        b_place = np.cumsum(self.b_joint) - self.b_joint
        a_after, b_after = np.flatnonzero(self.a_joint) + 1, np.flatnonzero(self.b_joint) + 1
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        codes[np.arange(len(self.a)) + np.r_[0, b_after][a_place]] = 2 * self.a + self.a_joint
        kind = self.b_joint.astype(np.int64)
        kind[self.b_bounds[1:][self.n_b > 0] - 1] = 2
        if len(self.b):
            codes[np.arange(len(self.b)) + a_after[b_place]] = self.pair.b_names + 3 * self.b + kind
        bounds = (self.a_bounds + self.b_bounds).tolist()
        name = self.pair.names.__getitem__
        for first, last in zip(bounds, bounds[1:]):
            yield "".join(map(name, codes[first:last].tolist()))

    def records(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Linked pairs by document: pair, document's place and number, in pair-major order."""
        document = np.repeat(np.arange(len(self.n_groups)), self.n_groups)
        key = (self.b[self.b_joint] << _A_BITS | self.a[self.a_joint]) << _DOC_BITS | document
        key, n = np.unique(key, return_counts=True)
        return key >> _DOC_BITS, key & ((1 << _DOC_BITS) - 1), n


def _pack(*arrays: np.ndarray) -> bytes:
    """Whole numbers, each array in the narrowest width that holds it, compressed."""
    parts = []
    for x in arrays:
        x = x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))
        parts += [np.array([len(x), x.itemsize], np.int64).tobytes(), x.tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(raw: bytes) -> list[np.ndarray]:
    raw, at, arrays = zstandard.ZstdDecompressor().decompress(raw), 0, []
    while at < len(raw):
        n, width = np.frombuffer(raw, np.int64, 2, at).tolist()
        arrays.append(np.frombuffer(raw, f"u{width}", n, at + 16).astype(np.int64))
        at += 16 + n * width
    return arrays


def write_run(*columns: np.ndarray) -> bytes:
    """A run of pairs and their numbers, in compressed blocks that can be read one by one."""
    blocks = []
    for first in range(0, len(columns[0]), BLOCK_PAIRS):
        pairs, *others = (x[first : first + BLOCK_PAIRS] for x in columns)
        block = _pack(pairs[:1], np.diff(pairs), *others)
        blocks += [len(block).to_bytes(4, "little"), block]
    return b"".join(blocks)


def read_run(run: bytes) -> Iterator[list[np.ndarray]]:
    """The blocks of a run: pairs in order, then the other columns."""
    at = 0
    while at < len(run):
        size = int.from_bytes(run[at : at + 4], "little")
        first, steps, *others = _unpack(run[at + 4 : at + 4 + size])
        yield [np.cumsum(np.r_[first, steps]), *others]
        at += 4 + size


def merge_runs(runs: list[bytes]) -> Iterator[tuple[int, int]]:
    """All pairs of sorted runs in order, each once with its numbers added up."""

    def entries(run: bytes) -> Iterator[tuple[int, int]]:
        for pairs, n in read_run(run):
            yield from zip(pairs.tolist(), n.tolist())

    last, total = None, 0
    for pair, n in heapq.merge(*map(entries, runs)):
        if pair != last:
            if last is not None:
                yield last, total
            last, total = pair, 0
        total += n
    if last is not None:
        yield last, total


def _columns(entries: Iterator[tuple]) -> list[np.ndarray]:
    rows = np.fromiter(chain.from_iterable(entries), np.int64)
    return [rows[0::2], rows[1::2]]


def _merged(group: pa.Table) -> pa.Table:
    """One run from several."""
    run = write_run(*_columns(merge_runs(group.column("pairs").to_pylist())))
    return pa.table({"radix": group.column("radix")[:1].cast(pa.int32()), "pairs": pa.array([run], pa.binary())})


def _totalled(group: pa.Table) -> pa.Table:
    """The last merge: beside each count whether it is the highest of its B token."""
    pairs, n = _columns(merge_runs(group.column("pairs").to_pylist()))
    side = pairs >> _A_BITS
    first = np.flatnonzero(np.r_[True, side[1:] != side[:-1]]) if len(side) else np.empty(0, np.int64)
    highest = np.repeat(np.maximum.reduceat(n, first), np.diff(np.r_[first, len(n)])) if len(side) else n
    run = write_run(pairs, n, (n == highest).astype(np.int64))
    return pa.table({"radix": group.column("radix")[:1].cast(pa.int32()), "pairs": pa.array([run], pa.binary())})


def _whole(run: bytes) -> list[np.ndarray]:
    """All blocks of a run put together."""
    return [np.concatenate(columns) for columns in zip(*read_run(run))]


def _contributions(runs: pa.Table, totals: pa.Table) -> pa.Table:
    """What the pairs of one radix add to the sums of each chunk's documents."""
    out = {"chunk": [], "sums": []}
    if runs.num_rows:
        known, count, best = _whole(totals.column("pairs")[0].as_py())
        for chunk, pairs, docs in zip(*(runs.column(c) for c in ("chunk", "pairs", "docs"))):
            here = np.searchsorted(known, _whole(pairs.as_py())[0])
            size, document, n = _unpack(docs.as_py())
            here = np.repeat(here, size)
            sums = np.zeros((2, int(document.max()) + 1), np.int64)
            np.add.at(sums[0], document, n * best[here])
            np.add.at(sums[1], document, n * count[here])
            out["chunk"].append(chunk.as_py())
            out["sums"].append(_pack(*sums))
    return pa.table({"chunk": pa.array(out["chunk"], pa.int64()), "sums": pa.array(out["sums"], pa.binary())})


def _added(docs: pa.Table, contributions: pa.Table) -> pa.Table:
    """The documents of a chunk with the sums of all radices."""
    order = docs.column("place").to_numpy()
    sums = np.zeros((2, len(order)), np.int64)
    for packed in contributions.column("sums"):
        for total, part in zip(sums, _unpack(packed.as_py())):
            total[: len(part)] += part
    kept = docs.drop_columns(["chunk", "place"])
    return kept.append_column("n_best", pa.array(sums[0][order])).append_column("count_sum", pa.array(sums[1][order]))


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _encoder(a_path: str, b_path: str, radices: int, chunk_bytes: int, digest: bool):
    """Rows of documents (radix is null) and rows of runs, chunk after chunk."""

    def chunk_rows(part: pa.RecordBatch, number: int, schema: pa.Schema) -> pa.RecordBatch:
        found = Aligned(part.column(1).to_pylist(), tokenizers(a_path, b_path))
        groups = list(found.groups())
        if digest:
            groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
        n = part.num_rows
        docs = {
            "chunk": np.full(n, number), "place": np.arange(n, dtype=np.int32), "id": part.column(0), "groups": groups,
            "n_a": found.n_a, "n_b": found.n_b, "n_groups": found.n_groups, "n_links": found.n_groups,
        }
        pair, document, times = found.records()
        radix, runs = (pair >> _A_BITS) % radices, {"chunk": [], "radix": [], "pairs": [], "docs": []}
        for r in np.unique(radix).tolist():
            own = radix == r
            pairs, first, size = np.unique(pair[own], return_index=True, return_counts=True)
            runs["chunk"].append(number)
            runs["radix"].append(r)
            runs["pairs"].append(write_run(pairs, np.add.reduceat(times[own], first)))
            runs["docs"].append(_pack(size, document[own], times[own]))
        both = [
            pa.RecordBatch.from_arrays(
                [pa.array(rows[f.name], f.type) if f.name in rows else pa.nulls(len(rows["chunk"]), f.type) for f in schema],
                schema=schema,
            )
            for rows in (docs, runs)
        ]
        return pa.concat_batches(both)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            schema = pa.schema([
                ("chunk", pa.int64()), ("place", pa.int32()), ("id", batch.schema.field(0).type), ("groups", pa.string()),
                *[(c, pa.int64()) for c in _COUNTS], ("radix", pa.int32()), ("pairs", pa.binary()), ("docs", pa.binary()),
            ])
            sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)
            reached, first = np.cumsum(sizes), 0
            while first < batch.num_rows:
                before = reached[first - 1] if first else 0
                last = max(int(np.searchsorted(reached, before + chunk_bytes, "right")), first + 1)
                yield chunk_rows(batch.slice(first, last - first), number, schema)
                number += 1
                first = last

    return encode


def encoded(
    df: DataFrame, text: str = "text", row_id: str = "doc_id", *, folder: str = TOKENIZERS, a_file: str = A_FILE,
    b_file: str = B_FILE, radices: int = RADICES, chunk_bytes: int = CHUNK_BYTES, digest: bool = False,
) -> DataFrame:
    """The staged table of documents with their groups (``radix`` null) and of runs of pairs."""
    kind = df.select(F.col(row_id)).schema[0].dataType.simpleString()
    counts = ", ".join(f"{c} bigint" for c in _COUNTS)
    schema = f"chunk bigint, place int, id {kind}, groups string, {counts}, radix int, pairs binary, docs binary"
    encode = _encoder(f"{folder}/{a_file}", f"{folder}/{b_file}", radices, chunk_bytes, digest)
    return stage(df.select(F.col(row_id), F.col(text)).mapInArrow(encode, schema), "token-runs")


def pair_totals(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One run per radix: every pair with its corpus-wide count, and whether its B token has no higher one."""
    runs = rows.where("radix is not null").select("radix", "pairs", F.xxhash64("chunk").alias("draw"))
    left = rows.where("radix is not null").select("chunk").distinct().count()
    schema = "radix int, pairs binary"
    while left > fan_in:
        left = -(-left // fan_in)
        part = F.pmod("draw", F.lit(left)).alias("part")
        runs = runs.groupBy("radix", part).applyInArrow(_merged, schema)
        runs = stage(runs.withColumn("draw", F.xxhash64("pairs")), "merged-runs")
    return stage(runs.groupBy("radix").applyInArrow(_totalled, schema), "pair-totals")


def pair_counts(totals: DataFrame) -> DataFrame:
    """b, a, n and is_best of every linked pair of ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in chain.from_iterable(batch.column("pairs") for batch in batches):
            for pairs, n, best in read_run(run.as_py()):
                columns = [pairs >> _A_BITS, pairs & ((1 << _A_BITS) - 1), n, best.astype(bool)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["b", "a", "n", "is_best"])

    return totals.select("pairs").mapInArrow(rows, "b bigint, a bigint, n bigint, is_best boolean")


def align(
    df: DataFrame, text: str = "text", row_id: str = "doc_id", *, fan_in: int = FAN_IN,
    chunks_per_group: int = CHUNKS_PER_GROUP, **options,
) -> DataFrame:
    """Per row: its id, groups of ids, n_a, n_b, n_groups, n_links, n_best and count_sum.

    ``options`` go to ``encoded``; with ``digest`` groups are their SHA-256. n_best counts the links
    whose pair no other pair of the same B token exceeds; count_sum adds up the counts of the pairs.

    Null and empty texts, and texts that one of the tokenizers does not give back byte for byte,
    have no tokens: zeros and empty groups. Every row counts, repeated rows and ids (null ids too)
    included. Other columns are not returned. An empty table gives no rows. Tokenizer files must
    lie at the same path on every executor. Memory of a task follows a chunk, the longest text, or
    the pairs of one radix.
    """
    rows = encoded(df, text, row_id, **options)
    totals = pair_totals(rows, fan_in)
    runs = rows.where("radix is not null").select("radix", "chunk", "pairs", "docs")
    parts = max(1, -(-runs.select("chunk").distinct().count() // chunks_per_group))
    runs = runs.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(parts).cast("bigint")))
    copies = totals.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
    sums = runs.groupBy("radix", "part").cogroup(copies.groupBy("radix", "part")).applyInArrow(
        _contributions, "chunk bigint, sums binary"
    )
    docs = rows.where("radix is null").select("chunk", "place", F.col("id").alias(row_id), "groups", *_COUNTS)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema if f.name not in ("chunk", "place")}
    schema = ", ".join(f"`{n}` {k}" for n, k in kinds.items()) + ", n_best bigint, count_sum bigint"
    return docs.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInArrow(_added, schema)
