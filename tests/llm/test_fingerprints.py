"""Fingerprints, sketches and peeling against sets."""

import hashlib
import random
import re

from llm_rows import SCHEMA, SMALL, documents, empty, odd, prose  # noqa: F401

from pyspark.sql import functions as F

from titleweave.llm import fingerprints, queries

KEYS = "k bigint, a array<bigint>, b array<bigint>"


def digests(text):
    pieces = (p.strip(" \t\n\x0b\x0c\r") for p in re.findall(r"[^\n]{120}[^\n.!?]{0,120}[.!?]*|[^\n]+", text or ""))
    return {int(hashlib.md5(p.encode()).hexdigest()[:15], 16) for p in pieces if p}


def cells(keys, width=4):
    out = []
    for table in range(3):
        for place in range(width):
            own = [k for k in keys if (k >> 20 * table) % width == place]
            both = 0
            for k in own:
                both ^= k
            out.append((len(own), both))
    return out


def stored(text):
    shown = ",".join(f"{n:x}:{d:x}" for n, d in cells(digests(text)))
    return f"{hashlib.md5((text or '').encode()).hexdigest()[:16]}-{shown}"


def share(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def following(rows):
    """Each row's next one by descending id; null ids are the smallest."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    return list(zip(order, order[1:] + order[:1]))


def test_registered_query(spark, documents):
    got = {r.doc_id: r for r in queries.op12_fingerprints(spark, SMALL).collect()}
    rows = [(r.doc_id, r.text or "") for r in documents.collect()]
    assert set(got) == {i for i, _ in rows}
    for (i, text), (_, other) in following(rows):
        cut = len(text) // 2
        edited = text[: len(text) - cut] + other[:cut]
        r = got[i]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == stored(text) and r.edited_fingerprint == stored(edited)
        assert abs(r.near_edited - share(digests(text), digests(edited))) < 1e-12
        assert abs(r.near_next - share(digests(text), digests(other))) < 1e-12


def sets(seed, sizes):
    draw = random.Random(seed)
    new = lambda n: {draw.getrandbits(60) for _ in range(n)}
    for k, (both, left, right) in enumerate(sizes):
        shared = new(both)
        yield k, sorted(shared | new(left)), sorted(shared | new(right))


def solved(df):
    sketches = fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b"))
    found = df.withColumn("found", fingerprints.difference(F.col("a"), F.col("b"), *sketches))
    return found.withColumn("near", fingerprints.likeness(F.col("a"), F.col("b"), F.col("found"))).collect()


def check(rows):
    for r in rows:
        a, b = set(r.a), set(r.b)
        assert sorted(r.found.left) == sorted(a - b) and sorted(r.found.right) == sorted(b - a)
        assert abs(r.near - share(a, b)) < 1e-12


def test_differences_of_all_sizes(spark):
    sizes = [(0, 0, 0), (0, 1, 0), (0, 0, 1), (9, 0, 0), (500, 1, 1), (500, 3, 0), (0, 40, 2), (20, 60, 60), (3000, 700, 900)]
    sizes += [(n % 7, n % 5, n % 11) for n in range(300)]
    check(solved(spark.createDataFrame(list(sets(4, sizes)), KEYS)))


def test_stored_sketch_stalls_and_larger_ones_do_not(spark):
    """Two digests in the same three cells cannot be told apart; the larger sketches place them by another hash."""
    a, b = 5, 5 + (1 << 12) + (1 << 32) + (1 << 52)
    assert cells({a}) != cells({b}) and [n for n, _ in cells({a})] == [n for n, _ in cells({b})]
    df = spark.createDataFrame([(1, [a, b], []), (2, [a], [b]), (3, [a, b], [a])], KEYS)
    alone = fingerprints.subtract(fingerprints.sketch(F.col("a")), fingerprints.sketch(F.col("b")))
    peeled = {r.k: r.p for r in df.select("k", fingerprints.peel(alone, F.lit(12)).alias("p")).collect()}
    assert peeled[1] is None and peeled[2] is None and peeled[3].left == [b]
    check(solved(df))


def test_last_resort_is_exact(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "WIDTHS", (1,))
    check(solved(spark.createDataFrame(list(sets(6, [(5, 9, 9), (0, 30, 1), (40, 0, 25)])), KEYS)))


def test_sketches_hold_what_sets_hold(spark):
    rows = list(sets(9, [(0, n, 0) for n in (0, 1, 4, 200)]))
    for r in spark.createDataFrame(rows, KEYS).withColumn("s", fingerprints.sketch(F.col("a"))).collect():
        assert [(c.n, c.digest) for c in r.s] == cells(set(r.a))


def test_next_rows_over_many_slices(spark):
    draw = random.Random(12)
    rows = [(i, prose(i, draw.randint(0, 30))) for i in draw.sample(range(100_000), 700)] + [(None, "nobody"), (200_000, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for size in (300, 1 << 30):
        got = {r.doc_id: (r.text, r.next_text) for r in fingerprints.with_next(df, slice_bytes=size).collect()}
        assert got == {i: (t or "", o or "") for (i, t), (_, o) in following(rows)}
    one = spark.createDataFrame(rows[:1], "doc_id bigint, text string")
    assert [(r.text, r.next_text) for r in fingerprints.with_next(one).collect()] == [(rows[0][1], rows[0][1])]


def test_one_id_of_many_rows(spark):
    rows = [(7, f"text {i % 3}") for i in range(60)] + [(i, "x") for i in range(5)]
    found = fingerprints.with_next(spark.createDataFrame(rows, "doc_id bigint, text string"), slice_bytes=100).collect()
    assert len(found) == 65 and sorted(r.text for r in found) == sorted(r.next_text for r in found)


def test_odd_rows(odd, empty):
    found = fingerprints.with_fingerprint(odd).collect()
    assert len(found) == odd.count()
    for r in found:
        assert r.fingerprint == stored(r.text) and set(r.digests) == digests(r.text)
    linked = fingerprints.with_next(odd)
    assert linked.count() == odd.count()
    assert sorted(r.text for r in linked.collect()) == sorted(r.next_text for r in linked.collect())
    assert fingerprints.with_fingerprint(empty).count() == fingerprints.with_next(empty).count() == 0


def test_clashing_names_are_replaced(spark):
    df = spark.createDataFrame([(1, "a", 2, 3)], "doc_id bigint, text string, Digests int, other int")
    found = fingerprints.with_fingerprint(df)
    assert found.columns == ["doc_id", "text", "other", "digests", "sketch", "fingerprint"]
    prefixed = fingerprints.with_fingerprint(df, prefix="old_")
    assert prefixed.columns[:4] == df.columns and prefixed.first().old_fingerprint == stored("a")


def test_no_python_in_the_plan(spark):
    plan = queries.op12_fingerprints(spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
