"""Shards and mixes by their laws: sizes, counts and totals."""

import zlib
from collections import Counter, defaultdict

from llm_rows import SCHEMA, SMALL, documents, empty, odd, prose, words_of  # noqa: F401

from pyspark.sql import functions as F

from titleweave.llm import mixing, queries, sharding


def by_shard(rows):
    found = defaultdict(list)
    for r in rows:
        found[r["shard"]].append(r)
    return found


def check_slots(rows):
    for own in by_shard(rows).values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))


def test_registered_shards(spark, documents):
    rows = [r.asDict() for r in queries.op2_sharding(spark, SMALL).collect()]
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    check_slots(rows)
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 16
    totals = [sum(r["size"] for r in own) for own in by_shard(rows).values()]
    mean, largest = sum(r["size"] for r in rows) / 16, max(r["size"] for r in rows)
    assert max(totals) <= mean + largest and min(totals) >= mean - largest


def test_hot_text_is_spread_and_others_stay_together(spark):
    rows = [(i, "the same text for all of these", "en", "a", 1) for i in range(2000)]
    rows += [(10_000 + i, prose(i % 1000, 30), "en", "a", 1) for i in range(2000)]
    found = sharding.shard_by_bytes(spark.createDataFrame(rows, SCHEMA), shards=8).collect()
    check_slots(found)
    totals = [sum(r.size for r in own) for own in by_shard(found).values()]
    assert len(totals) == 8 and max(totals) <= 1.06 * sum(totals) / 8
    homes = defaultdict(set)
    for r in found:
        homes[r.text].add(r.shard)
    hot = homes.pop("the same text for all of these")
    assert len(hot) > 1 and all(len(h) == 1 for h in homes.values())


def test_large_texts_do_not_part_the_copies_of_small_ones(spark):
    rows = [(i, prose(i % 1000, 30), "en", "a", 1) for i in range(3000)]
    rows += [(5000 + i, prose(2000 + i, 20_000), "en", "a", 1) for i in range(12)]
    found = sharding.shard_by_bytes(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == len(rows)
    check_slots(found)
    homes, totals = defaultdict(set), Counter()
    for r in found:
        homes[r.text].add(r.shard)
        totals[r.shard] += r.size
    assert all(len(h) == 1 for h in homes.values())
    mean = sum(totals.values()) / 16
    largest = max(r.size for r in found)
    assert all(abs(t - mean) <= 0.05 * mean for t in totals.values()) or largest > mean


def test_shards_of_odd_rows(odd, empty):
    found = sharding.shard_by_bytes(odd, shards=4).collect()
    assert len(found) == odd.count()
    check_slots(found)
    assert sharding.shard_by_bytes(empty).count() == 0
    assert set(sharding.shard_by_bytes(odd).columns) == set(odd.columns)


def test_shards_again_are_equal(documents):
    first, second = (sharding.shard_by_bytes(d).select("doc_id", "shard", "slot").collect()
                     for d in (documents, documents.repartition(5)))
    assert sorted(first) == sorted(second)


def water_fill(sizes, weights=(5, 2, 1), share=1.5):
    """Targets by repeated dealing of the excess."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[n % 3] for n, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def check_mix(rows):
    sizes, taken, largest, target = Counter(), Counter(), Counter(), {}
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
        target[r.source] = r.target
    want = water_fill(sizes)
    for s in sizes:
        assert abs(want[s] - target[s]) < 1e-6 * max(1, want[s])
        assert abs(taken[s] - target[s]) <= largest[s]


def test_registered_mix(spark, documents):
    rows = queries.op7_mixing(spark, SMALL).collect()
    sizes = {r.doc_id: len(words_of(r.text)) for r in documents.collect()}
    assert {r.doc_id: r["size"] for r in rows} == sizes and len(rows) == len(sizes)
    check_mix(rows)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, queries.op7_mixing(spark, SMALL).collect()))


def test_mix_of_many_levels(spark):
    rows = [(i, prose(i, 1 + i % 23), "en", "hot" if i % 3 else f"s{i % 11}", 1) for i in range(3000)]
    check_mix(mixing.taken_per_row(mixing.mix_counts(spark.createDataFrame(rows, SCHEMA))).collect())


def test_mix_of_odd_rows(odd, empty):
    found = mixing.taken_per_row(mixing.mix_counts(odd)).collect()
    assert len(found) == odd.count()
    check_mix(found)
    assert mixing.mix_counts(empty).count() == 0 and mixing.mix(empty).count() == 0
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns
    copies = mixing.mix_counts(odd).agg(F.sum("copies")).first()[0]
    assert mixed.count() == copies
