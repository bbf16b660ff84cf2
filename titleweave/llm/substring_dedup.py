"""Removal of long passages that an earlier document has, by difference-cover anchors.

A passage of ``WINDOW`` words that starts at word i of one document and at word j of another may
lie at any two offsets. The set ``COVER`` has, for every difference modulo ``PERIOD``, two members
with that difference; so some offset l below ``PERIOD`` makes both i + l and j + l cover positions.
Hashing ``ANCHOR`` words at cover positions only (a fifth of all) therefore gives both places a
common anchor inside the passage. Places whose anchor is met elsewhere are extended to the full
windows around it, and only those windows are compared, by 96-bit hashes of all their words.

Documents are dealt into chunks of a few megabytes. Each chunk sends an anchor or window once,
with its smallest document, however many of its documents repeat it; a passage in a third of all
documents is one row per chunk. The dealt texts are shuffled once and read by all three passes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titleweave.llm.wordhash import U, Run, runs

WINDOW = 50
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # a perfect difference set modulo 31
ANCHOR = WINDOW - PERIOD + 1
CHUNK_BYTES = 4 << 20
_LAST_ID = 2**63 - 1
_SECOND = 0xA0761D6478BD642F

_IN_COVER = np.zeros(PERIOD, bool)
_IN_COVER[list(COVER)] = True


def _ids(table: pa.Table, name: str = "doc_id") -> np.ndarray:
    return table.column(name).fill_null(_LAST_ID).to_numpy().astype(np.int64)


def _anchors(run: Run, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word positions of all anchors of a run, and their hashes."""
    at, anchor = run.windows(hashes, ANCHOR)
    place = at - run.word_bounds[run.document_of_words()[at]]
    chosen = _IN_COVER[place % PERIOD]
    return at[chosen], anchor[chosen]


def _least_by(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the smallest id of each, and whether it has another id too."""
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    if not len(first):
        return keys, ids, np.empty(0, bool)
    least = np.minimum.reduceat(ids, first)
    return keys[first], least, np.maximum.reduceat(ids, first) > least


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _find_anchors(docs: pa.Table) -> pa.Table:
    found = [np.empty(0, U)]
    for run in runs(docs.column("text")):
        found.append(np.unique(_anchors(run, run.hashes())[1]))
    anchors = np.unique(np.concatenate(found))
    chunk = np.full(len(anchors), docs.column("chunk")[0].as_py(), np.int32)
    return pa.table({"chunk": chunk, "anchor": anchors.view(np.int64)})


def _find_windows(docs: pa.Table, met: pa.Table) -> pa.Table:
    """Windows around anchors that other chunks, or other documents of this chunk, have too."""
    schema = {"chunk": np.int32, "low": np.int64, "high": np.int32, "first": np.int64}
    if not docs.num_rows:
        return pa.table({n: np.empty(0, t) for n, t in schema.items()})
    ids, work = _ids(docs), []
    for run in runs(docs.column("text")):
        hashes = run.hashes()
        at, anchor = _anchors(run, hashes)
        work.append((run, hashes, at, anchor, ids[run.first + run.document_of_words()[at]]))
    keys, _, several = _least_by(np.concatenate([w[3] for w in work]), np.concatenate([w[4] for w in work]))
    elsewhere = np.sort(met.column("anchor").to_numpy().astype(np.int64).view(U))
    known = np.union1d(keys[several], elsewhere)
    low, high, owner = [], [], []
    for run, hashes, at, anchor, _ in work:
        near = at[_among(anchor, known)]
        reach = np.zeros(len(hashes) + 2, np.int32)
        np.add.at(reach, np.maximum(near - PERIOD + 1, 0), 1)
        np.add.at(reach, near + 1, -1)
        wanted = np.cumsum(reach)[: len(hashes)] > 0
        start, first_hash = run.windows(hashes, WINDOW)
        _, second_hash = run.windows(hashes, WINDOW, _SECOND)
        chosen = wanted[start]
        low.append(first_hash[chosen])
        high.append(second_hash[chosen] >> U(33))
        owner.append(ids[run.first + run.document_of_words()[start[chosen]]])
    low, high, owner = np.concatenate(low), np.concatenate(high), np.concatenate(owner)
    order = np.lexsort((owner, high, low))
    low, high, owner = low[order], high[order], owner[order]
    new = np.ones(len(low), bool)
    new[1:] = (low[1:] != low[:-1]) | (high[1:] != high[:-1])
    return pa.table({
        "chunk": np.full(int(new.sum()), docs.column("chunk")[0].as_py(), np.int32),
        "low": low[new].view(np.int64), "high": high[new].astype(np.int32), "first": owner[new],
    })


_RESULT = (
    "doc_id bigint, n_words bigint, n_removed bigint, "
    "removed array<struct<first:bigint,last:bigint>>, kept_text string"
)
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _cut(docs: pa.Table, earlier: pa.Table) -> pa.Table:
    """Remove words of windows that a smaller document has, in this chunk or (``earlier``) in another."""
    ids, raw_ids = _ids(docs), docs.column("doc_id")
    work, out = [], {"n_words": [], "n_removed": [], "removed": [], "kept_text": []}
    for run in runs(docs.column("text")):
        hashes = run.hashes()
        start, low = run.windows(hashes, WINDOW)
        _, high = run.windows(hashes, WINDOW, _SECOND)
        work.append((run, len(hashes), start, low, high >> U(33), ids[run.first + run.document_of_words()[start]]))
    join = [np.concatenate([w[k] for w in work]) if work else np.empty(0, U) for k in (3, 4, 5)]
    # Within the chunk: windows that occur twice, keyed by both hashes.
    order = np.sort(join[0])
    twice = np.unique(order[1:][order[1:] == order[:-1]])
    here = np.flatnonzero(_among(join[0], twice))
    far_low = earlier.column("low").to_numpy().astype(np.int64).view(U)
    far_high = earlier.column("high").to_numpy().astype(np.int64).view(U)
    far_id = earlier.column("first").to_numpy().astype(np.int64)
    there = np.flatnonzero(_among(join[0], np.unique(far_low)))
    some = np.union1d(here, there)
    low = np.concatenate([join[0][some], far_low])
    high = np.concatenate([join[1][some], far_high])
    owner = np.concatenate([join[2][some].astype(np.int64), far_id])
    order = np.lexsort((owner, high, low))
    new = np.ones(len(order), bool)
    new[1:] = (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    least = owner[order][new]
    gone = np.zeros(len(join[0]), bool)
    gone[some] = least[group[: len(some)]] < owner[: len(some)]
    passed = 0
    for run, n, start, _, _, _ in work:
        hit = start[gone[passed : passed + len(start)]]
        passed += len(start)
        change = np.zeros(n + WINDOW + 1, np.int32)
        change[hit] += 1
        np.add.at(change, hit + WINDOW, -1)
        removed = np.cumsum(change)[:n] > 0
        counts = run.per_document_words(removed)
        text, bounds = run.data.tobytes(), run.bounds
        for d in range(len(run)):
            a, b = run.word_bounds[d], run.word_bounds[d + 1]
            parts = text[bounds[d] : bounds[d + 1]].split()
            spans = []
            if counts[d]:
                own = removed[a:b]
                parts = [parts[i] for i in np.flatnonzero(~own).tolist()]
                edges = np.flatnonzero(np.diff(np.r_[False, own, False].astype(np.int8)))
                spans = [{"first": int(x), "last": int(y) - 1} for x, y in zip(edges[::2], edges[1::2])]
            out["n_words"].append(int(b - a))
            out["n_removed"].append(int(counts[d]))
            out["removed"].append(spans)
            out["kept_text"].append(b" ".join(parts).decode())
    return pa.table({
        "doc_id": raw_ids,
        "n_words": pa.array(out["n_words"], pa.int64()),
        "n_removed": pa.array(out["n_removed"], pa.int64()),
        "removed": pa.array(out["removed"], _SPANS),
        "kept_text": pa.array(out["kept_text"], pa.string()),
    })


def remove_repeats(df: DataFrame, row_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, removed word spans, and the kept words joined by a space.

    A word goes if a window of 50 words over it also starts in a row with a smaller id; windows
    are judged on the input. Rows with equal ids never remove from one another; a null id counts
    as larger than any other. Null and blank texts have no words. An empty table gives no rows.
    Memory of a task follows the chunk, or the longest document.
    """
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes))
    # A document's chunk depends on its id and text: copies of one text spread over all chunks.
    chunk = F.pmod(F.xxhash64(F.col(row_id), F.col(text)), F.lit(chunks)).cast("int")
    dealt = df.select(
        chunk.alias("chunk"), F.col(row_id).cast("bigint").alias("doc_id"), F.col(text).alias("text")
    ).repartition("chunk")
    grouped = dealt.groupBy("chunk")
    anchors = grouped.applyInArrow(_find_anchors, "chunk int, anchor bigint")
    shared = F.count("*").over(Window.partitionBy("anchor"))
    met = anchors.withColumn("n", shared).where("n > 1").select("chunk", "anchor")
    windows = grouped.cogroup(met.groupBy("chunk")).applyInArrow(
        _find_windows, "chunk int, low bigint, high int, first bigint"
    )
    least = F.min("first").over(Window.partitionBy("low", "high"))
    earlier = windows.withColumn("least", least).where("least < first").select(
        "chunk", "low", "high", F.col("least").alias("first")
    )
    return grouped.cogroup(earlier.groupBy("chunk")).applyInArrow(_cut, _RESULT)
