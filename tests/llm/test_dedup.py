"""Substring and near-duplicate removal against brute force."""

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from llm_rows import SCHEMA, SMALL, documents, empty, odd, odd_rows, prose, words_of  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st

from titleweave.llm import components, queries, simhash, substring_dedup

LAST = 2**63 - 1


def cut(rows):
    """(id, n_words, n_removed, digest) of each row, window by window."""
    first, found = {}, []
    for row_id, text in rows:
        w = words_of(text)
        own = LAST if row_id is None else row_id
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            first[key] = min(own, first.get(key, own))
    for row_id, text in rows:
        w = words_of(text)
        own = LAST if row_id is None else row_id
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < own:
                gone[i : i + 50] = [True] * 50
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        found.append((row_id, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found, key=repr)


def removed(df, **options):
    rows = substring_dedup.remove_repeats(df, **options).collect()
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in rows), key=repr
    )


def test_cover_has_every_difference():
    assert {(a - b) % substring_dedup.PERIOD for a in substring_dedup.COVER for b in substring_dedup.COVER} == set(
        range(substring_dedup.PERIOD)
    )


def test_registered_substring_dedup(spark, documents):
    got = sorted(map(tuple, queries.op3_substring_dedup(spark, SMALL).collect()), key=repr)
    assert got == cut([(r.doc_id, r.text) for r in documents.collect()])


def test_passages_at_all_offsets(spark):
    passage = prose(99, 55)
    rows = [(i, f"{prose(i, 31 * 3 + i)} {passage} {prose(500 + i, 7 + i)}") for i in range(40)]
    rows += [(100 + i, " ".join(passage.split()[i : i + 49 + i])) for i in range(4)]
    rows += [(200, f"{passage} {passage}"), (201, prose(7, 10) + " " + " ".join(passage.split()[:49]))]
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], SCHEMA)
    for size in (1 << 11, 1 << 22):
        assert removed(df, chunk_bytes=size) == cut(rows)


def test_substring_dedup_of_odd_rows(odd, empty):
    want = cut([r[:2] for r in odd_rows()])
    assert removed(odd) == want and removed(odd, chunk_bytes=200_000) == want
    assert removed(empty) == []


def test_removed_spans_fit_the_kept_text(spark):
    passage = prose(1, 60)
    df = spark.createDataFrame([(1, passage, "", "", 1), (2, f"a b {passage} c", "", "", 1)], SCHEMA)
    row = substring_dedup.remove_repeats(df).where("doc_id = 2").first()
    assert [tuple(s) for s in row.removed] == [(2, 61)] and row.kept_text == "a b c"


def fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = words_of(lowered)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components_of(rows):
    return len({root for *_, root in _near(rows)})


def near(rows):
    """(id, fingerprint, component) by comparing all pairs."""
    return sorted(((i, p, c) for i, p, c, _ in _near(rows)), key=repr)


def _near(rows):
    prints = [fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for n, (i, _) in enumerate(rows):
        least[find(n)] = min(least.get(find(n), LAST), LAST if i is None else i)
    found = [(i, p, least[find(n)], find(n)) for n, ((i, _), p) in enumerate(zip(rows, prints))]
    return [(i, f"{p:016x}", None if m == LAST else m, root) for i, p, m, root in found]


def test_registered_near_dedup(spark, documents):
    got = sorted(map(tuple, queries.op6_simhash_near_dedup(spark, SMALL).collect()), key=repr)
    assert got == near([(r.doc_id, r.text) for r in documents.collect()])


def test_four_positions_hold_a_triple():
    triples = [set(t) for t in simhash.position_triples()]
    assert len(triples) == 20
    assert all(any(t <= set(four) for t in triples) for four in combinations(range(8), 4))


def groups(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=6), st.lists(st.tuples(st.integers(0, 5), st.sets(st.integers(0, 63), max_size=5)), max_size=40))
def test_spanning_links_keep_components(seeds, changes):
    prints = {s for s in seeds} | {seeds[n % len(seeds)] ^ sum(1 << b for b in bits) for n, bits in changes}
    u, v = simhash.spanning_links(np.array(sorted(prints), np.uint64))
    pairs = [(a, b) for a, b in combinations(sorted(prints), 2) if (a ^ b).bit_count() <= 4]
    assert groups(zip(u.tolist(), v.tolist()), prints) == groups(pairs, prints)
    assert len(u) < len(prints)


def test_dense_group_in_several_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    draw = np.random.default_rng(3)
    prints = {0x0123456789ABCDEF ^ int(sum(1 << int(b) for b in draw.choice(64, draw.integers(0, 5), False))) for _ in range(300)}
    prints |= {int(x) for x in draw.integers(0, 2**63, 300)}
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp bigint")).collect()
    unsign = lambda x: x % (1 << 64)
    pairs = [(a, b) for a, b in combinations(sorted(prints), 2) if (a ^ b).bit_count() <= 4]
    assert groups([(unsign(r.u), unsign(r.v)) for r in found], prints) == groups(pairs, prints)


def test_near_dedup_of_odd_rows(odd, empty):
    want = near([r[:2] for r in odd_rows()])
    got = [(r.doc_id, f"{r.fp % (1 << 64):016x}", r.component_id) for r in simhash.near_groups(odd).collect()]
    assert sorted(got, key=repr) == want
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns and kept.count() == components_of([r[:2] for r in odd_rows()])
    assert simhash.near_groups(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_components_of_a_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(1, 40)]
    hub = [(100, 200 + i) for i in range(50)] + [(200, 200), (None, 5), (201, 100)]
    found = dict(map(tuple, components.components(spark.createDataFrame(path + hub, "u bigint, v bigint")).collect()))
    assert all(found[i] == 1 for i in range(1, 41)) and all(found[200 + i] == 100 for i in range(50))
    assert components.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_fingerprints_of_edge_texts():
    texts = [None, "", " ", "A", "a b c", "a b c d", "a B c d e", "É x y z", prose(1, 700)]
    assert simhash.fingerprint_texts(pa.array(texts)).tolist() == [fingerprint(t) for t in texts]
