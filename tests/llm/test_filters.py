"""License scan, decontamination, quality rules and the quality classifier."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from llm_rows import SCHEMA, SMALL, documents, empty, odd, odd_rows, prose, words_of  # noqa: F401

from titleweave.llm import decontamination, license_scan, queries, quality_net, quality_rules


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def licenses(rows, templates=license_scan.TEMPLATES):
    """{(id, license): containment} by sliding windows over every text."""
    cut = [(n, tokens(t)) for n, t in templates]
    own = [(n, {tuple(w[i : i + 5]) for i in range(len(w) - 4)}) for n, w in cut]
    family = license_scan.families(templates)
    found = {}
    for row_id, text in rows:
        w = tokens(text)
        at = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        for k, (name, mine) in enumerate(own):
            size = 1
            while size < len(mine):
                size *= 2
            for start in range(0, len(at), size):
                share = len(mine & set(at[start : start + 2 * size])) / len(mine)
                if share >= 0.8:
                    key = (row_id, family[k], name)
                    found[key] = max(share, found.get(key, 0))
    best = {}
    for (row_id, fam, _), share in found.items():
        best[row_id, fam] = max(share, best.get((row_id, fam), 0))
    return {(i, n): s for (i, fam, n), s in found.items() if s == best[i, fam]}


def scanned(df, **options):
    return {(r.doc_id, r.license): r.containment for r in license_scan.scan_licenses(df, **options).collect()}


def test_registered_license_scan(spark, documents):
    got = {(r.doc_id, r.license): r.containment for r in queries.op1_license_scan(spark, SMALL).collect()}
    want = licenses([(r.doc_id, r.text) for r in documents.collect()])
    assert got == want and len(want) > 0


def test_licenses_in_odd_places(spark, odd, empty):
    grant = license_scan.TEMPLATES[4][1]
    rows = [(1, prose(1, 37) + " RELEASED under\nthe 'MIT' License. " + prose(2, 20)), (2, prose(3, 200) + grant.replace("Software", "software")),
            (3, grant.replace("person", "somebody")), (4, " ".join(grant.split()[:12])), (5, "Licensed under CC BY-NC 4.0."),
            (6, "licensed under the GNU General Public License, version 2. licensed under the GNU General Public License, version 3.")]
    df = spark.createDataFrame([(i, t, "", "", 1) for i, t in rows], SCHEMA)
    got = scanned(df)
    assert got == licenses(rows)
    assert {(1, "MIT"), (2, "MIT"), (3, "MIT"), (5, "CC-BY-NC-4.0"), (6, "GPL-2.0"), (6, "GPL-3.0")} == set(got)
    assert scanned(odd) == {} and scanned(empty) == {} and scanned(df, templates=()) == {}


def test_sibling_licenses_in_places_of_their_own(spark):
    exact, near = "licensed under the GNU General Public License, version {}", "distributed under the GNU General Public License, version {}"
    rows = [(1, f"{exact.format(3)} {prose(1, 90)} {near.format(2)}"), (2, f"{near.format(3)} {prose(2, 40)} {exact.format(2)} {prose(3, 9)}"),
            (3, exact.format(3)), (4, f"{exact.format(3)} {prose(4, 50)} {exact.format(3)}"), (None, f"{exact.format(3)} {prose(5, 70)} {near.format(2)}")]
    rows += [(100 + n, f"{prose(6, n)} {exact.format(3)} {prose(7, n)} {near.format(2)}") for n in range(1, 25)]
    df = spark.createDataFrame([(i, t, "", "", 1) for i, t in rows], SCHEMA)
    got = scanned(df)
    both = [i for i, _ in rows if i not in (3, 4)]
    assert set(got) == {(i, n) for i in both for n in ("GPL-2.0", "GPL-3.0")} | {(3, "GPL-3.0"), (4, "GPL-3.0")}
    assert got[1, "GPL-2.0"] == 0.8 and got[1, "GPL-3.0"] == 1.0 and got[2, "GPL-3.0"] == 0.8


def test_telling_words_hit_every_shingle():
    telling = set(license_scan.telling_words(license_scan.TEMPLATES))
    for _, text in license_scan.TEMPLATES:
        w = tokens(text)
        assert all(telling & set(w[i : i + 5]) for i in range(len(w) - 4))


def leaked(rows, items):
    """(doc, item) with both overlaps at 0.8 or more, over the whole text."""
    found = set()
    for row_id, text in rows:
        w = tokens(text)
        for item_id, item in items:
            q, a = map(tokens, decontamination.question_and_answer(item or ""))
            if not q and not a:
                continue
            width = min(5, len(q))
            own = {tuple(q[i : i + width]) for i in range(len(q) - width + 1)} if q else set()
            there = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}
            if len(own & there) >= 0.8 * max(len(own), 1) and (not a or len(set(a) & set(w)) >= 0.8 * len(set(a))):
                found.add((row_id, item_id))
    return found


def test_registered_decontamination(spark, documents):
    got = [(r.doc_id, r.item_id) for r in queries.op4_decontamination(spark, SMALL).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert set(got) == leaked(rows, items) and len(got) == len(set(got)) > 0


def test_leaks_at_every_offset_and_in_parts(spark):
    items = [(i, prose(i, 20 + 9 * i)) for i in range(30)]
    rows = [(n * 100 + i, f"{prose(900 + n, 13 * n)} {t.upper()}! {prose(1800 + i, 60)}") for n in range(4) for i, t in items]
    rows += [(9000 + i, " ".join(w for k, w in enumerate(t.split()) if k != 7)) for i, t in items]
    df = spark.createDataFrame([(i, t, "", "", 1) for i, t in rows], SCHEMA)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(df, bench).collect()}
    planted = {(i, i % 100) for i, _ in rows if i < 9000}
    assert planted <= found and found == leaked(rows, items)
    assert decontamination.indexes(bench, part_words=500).count() > 3
    clean = decontamination.drop_leaks(df, bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in rows} - {i for i, _ in found}


def test_scores_do_not_depend_on_parts_or_the_way_they_travel(spark):
    """Items of a shared vocabulary, documents that hold four words in five of them or less."""
    rng = random.Random(3)
    words = [f"w{int(rng.paretovariate(0.7)) % 300}" for _ in range(4000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(8, 120)))) for i in range(200)]
    rows = []
    for i, t in items:
        for share in (1.0, 0.97, 0.9):
            kept = [w if rng.random() < share else rng.choice(words) for w in t.split()]
            rows.append((len(rows), " ".join([*rng.choices(words, k=30), *kept, *rng.choices(words, k=40)]), "", "", 1))
    df, bench = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id bigint, text string")

    def found(**options):
        return {tuple(round(x, 9) for x in r) for r in decontamination.find_leaks(df, bench, **options).collect()}

    one = found()
    assert {(r[0], r[0] // 3) for r in rows if r[0] % 3 == 0} <= {(d, i) for d, i, *_ in one}
    assert found(part_words=1500) == one == found(part_words=250)
    assert found(part_words=1500, max_broadcast=0) == one
    clean = decontamination.drop_leaks(df, bench, part_words=1500, max_broadcast=0)
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {r[0] for r in one}


def test_meeting_of_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(4, "two words"), (5, "none of these")], "item_id bigint, text string")
    kept = decontamination.drop_leaks(odd, bench, max_broadcast=0)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert decontamination.drop_leaks(empty, bench, max_broadcast=0).count() == 0


def test_decontamination_of_odd_rows(spark, odd, empty):
    bench = spark.createDataFrame([(1, None), (None, "a b"), (2, ""), (3, "?!"), (4, "two words"), (4, "two words")], "item_id bigint, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.find_leaks(odd, bench).collect()} == {(11, 4)}
    none = bench.where("false")
    assert decontamination.find_leaks(odd, none).count() == 0
    kept = decontamination.drop_leaks(odd, bench)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert decontamination.drop_leaks(odd, none).count() == odd.count()
    assert decontamination.find_leaks(empty, bench).count() == 0


def measures(text):
    w = words_of(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_registered_quality_rules(spark, documents):
    rows = {r.doc_id: r for r in queries.op5_quality_rules(spark, SMALL).collect()}
    for d in documents.collect():
        want, got = measures(d.text), rows[d.doc_id]
        assert tuple(got[1:6]) == want
        assert got.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (got.base_failed and got.kept)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    judged = [(labels[i], r.kept) for i, r in rows.items() if i in labels and not r.base_failed]
    assert sum(k for q, k in judged if q) >= 0.9 * sum(1 for q, _ in judged if q)


def test_measures_of_odd_rows(odd, empty):
    got = {(r.doc_id, r.text): tuple(r.m[:5]) for r in odd.withColumn("m", quality_rules.text_measures("text")).collect()}
    assert got == {(r[0], r[1]): measures(r[1]) for r in odd_rows()}
    kept = quality_rules.keep_good(odd, [])
    assert kept.columns == odd.columns
    want = [r for r in odd_rows() if (m := measures(r[1]))[0] >= 20 and 100 * m[4] <= 30 * m[0]]
    assert kept.count() == len(want)
    assert quality_rules.keep_good(empty, []).count() == 0


def test_rules_are_learned_pruned_and_emitted(spark):
    draw = np.random.default_rng(5)
    rows = pd.DataFrame({n: draw.random(3000) for n in quality_rules.features()})
    bad = (rows["symbol_share"] > 0.7) | (rows["upper_share"] > 0.8) & (rows["words"] < 0.5)
    rows["quality"] = (~bad).astype(int)
    rules = quality_rules.learn_rules(rows)
    said = np.zeros(len(rows), bool)
    for rule in rules:
        said |= quality_rules._covers(rule, rows)
    assert (said == bad).mean() > 0.97 and all(1 <= len(r) <= 3 for r in rules)
    assert quality_rules.learn_rules(rows.assign(quality=1)) == [] and quality_rules.learn_rules(rows[:0]) == []
    df = spark.createDataFrame([(prose(1, 60) + " ***" * 90, "a"), (prose(2, 60), "b")], "text string, name string")
    rule = (quality_rules.Test("symbol_share", True, 0.2),)
    assert [r.name for r in quality_rules.keep_good(df, [rule]).collect()] == ["b"]


def test_registered_quality_classifier(spark, documents):
    rows = queries.op9_quality_classifier(spark, SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents.collect())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.8 * len(held)


def test_classifier_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (5, 0), (None, 1), (8, None)], "doc_id bigint, quality int")
    rows = quality_net.quality_scores(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    again = quality_net.quality_scores(odd, labels.where("false")).collect()
    assert {r.score for r in again} == {0.5}
    assert quality_net.quality_scores(empty, labels).count() == 0


def test_token_ranges():
    run = next(quality_net.runs(pa.array(["the NASA 42 ***é"])))
    bucket, first = quality_net.tokens(run)
    ranges = np.searchsorted(quality_net.FIRST, bucket, "right") - 1
    assert ranges.tolist() == [0, 1, 2, 3, 0] and first.tolist() == [0, 5]


def test_network_learns_and_calibrates():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(3000, 6))
    y = ((x[:, 0] * x[:, 1] + 0.3 * draw.normal(size=3000)) > 0).astype(float)
    net = quality_net.fit(x[:2400], y[:2400])
    score = net.score(x[2400:])
    best = ((x[2400:, 0] * x[2400:, 1] > 0) == (y[2400:] == 1)).mean()  # no rule can do better
    assert ((score > 0.5) == (y[2400:] == 1)).mean() > 0.93 * best
    near = np.abs(score - 0.75) < 0.15
    assert abs(y[2400:][near].mean() - score[near].mean()) < 0.2
