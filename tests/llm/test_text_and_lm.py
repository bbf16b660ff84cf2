"""Page text, language-model scores, the pipeline and the entry guard."""

import html
import math
import re
import time
import subprocess
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from llm_rows import SMALL, documents, empty, odd, odd_rows  # noqa: F401

import corpus_pipeline
from titleweave.llm import decontamination, html_text, mixing, pitman_yor, queries, quality_rules, seating, sharding, simhash
from titleweave.llm.common import stage

ROOT = Path(__file__).resolve().parents[2]


def test_registered_html_extraction(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op8_html_extraction(spark, SMALL).collect()}
    assert len(got) == len(pages)
    for p in pages:
        article = p.html.split("<article>")[1].split("</article>")[0]
        parts = re.split(r"</?(?:p|h1)>", article)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", re.sub("<br>", " ", x))).split()) for x in parts]
        want = "\n".join(b for b in blocks if b)
        assert got[p.page_id].text == want and got[p.page_id].n_chars == len(want) and got[p.page_id].url == p.url


LONG = "A long sentence of the article that has many words and no links at all, so it is dense."


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("  ", ""), ("plain", "plain"), ("<p>a", "a"), ("a &lt;b&gt; &amp;amp; c", "a <b> &amp; c"),
    ("<script>x='</p>'</script><p>one<br>two <b>th</b>ree</p>", "one two three"),
    (f"<body><div class='menu'><a href=a>A</a></div><div id=c><p>{LONG}</p><p>{LONG} two</p></div>"
     f"<div class='comments'><p>{LONG} said a reader</p></div></body>", f"{LONG}\n{LONG} two"),
    (f"<main><h1>T</h1><p>{LONG}<p>x</main><aside>{LONG}</aside><footer>{LONG}</footer>", f"T\n{LONG}\nx"),
    (f"<article><p>{LONG}</p><form>name <input></form><div class='ad-slot'>Buy</div><ul><li>i<li>ii</ul></article>",
     f"{LONG}\ni\nii"),
    (f"<div class='page has sidebar'><main class='overflow hidden'><p>{LONG}</main></div><div class='sidebar'>{LONG} no</div>", LONG),
    (f"<form id=aspnet><article><p>{LONG}</article><div class=notice>{LONG} no</div></form>", LONG),
    (f"<div class='wrap with-sidebar'><p>{LONG}</p></div><nav>{LONG} no</nav>", LONG),
    (f"<article><p>{LONG}</article><section id=talk><article class=comment><p>{LONG} no</article></section>", LONG),
    (f"<div id=text><p>{LONG}<p>{LONG}</div><div id=readerComments><p>{LONG} no</div>", f"{LONG}\n{LONG}"),
    (f"<article><p>{LONG}<div hidden>no</div></article>", LONG),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<!-- <p>no</p> --><p>yes</p>", "yes"),
    ("<p>1 < 2 and <3</p>", "1 < 2 and <3"), ("<div>" * 3000 + "deep", "deep"),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(("page", "text"), [
    (f"<body><main><h1>Title</h1><p>lead</p><article><p>{LONG}</p><p>{LONG} two</p><p>{LONG} three</p></article></main>",
     f"Title\nlead\n{LONG}\n{LONG} two\n{LONG} three"),
    (f"<body><article><p>{LONG}</p><p>{LONG} two</p><p>{LONG} three</p></article>"
     f"<article><p>{LONG} four</p><p>{LONG} five</p></article><nav><a href=a>A</a></nav>",
     f"{LONG}\n{LONG} two\n{LONG} three\n{LONG} four\n{LONG} five"),
    (f"<body><div><article><p>{LONG}</p><p>{LONG} two</p></article></div><div><article><p>{LONG} three</p></article></div>",
     f"{LONG}\n{LONG} two\n{LONG} three"),
    (f"<body><h1>{LONG} {LONG}</h1><article><p>{LONG} one</p><p>{LONG} two</p></article>", f"{LONG} {LONG}\n{LONG} one\n{LONG} two"),
    (f"<body><article><p>{LONG}</p><p>{LONG} two</p></article><article><a href=a>More</a></article>", f"{LONG}\n{LONG} two"),
])
def test_articles_in_parts_and_around(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize(("page", "text"), [
    (f"<body><h1>Head</h1><div><p>{LONG}</p><p>{LONG} two</p></div></body>", f"Head\n{LONG}\n{LONG} two"),
    (f"<body><h1>Head</h1><h2>Sub</h2><div><div><p>{LONG}</p><p>{LONG} two</p></div></div>", f"Head\nSub\n{LONG}\n{LONG} two"),
    (f"<body><h1>Head</h1><p>By A</p><article><p>{LONG}</p><p>{LONG} two</p></article>", f"Head\n{LONG}\n{LONG} two"),
    (f"<body><h1>Site</h1><p>motto</p><article><h1>Head</h1><p>{LONG}</p><p>{LONG} two</p></article>", f"Head\n{LONG}\n{LONG} two"),
    (f"<body><h1><a href=a>Site</a></h1><div><p>{LONG}</p><p>{LONG} two</p></div><h2>More</h2>", f"{LONG}\n{LONG} two"),
    (f"<article><p>{LONG}</p><div class='social-history'><p>{LONG} b</p></div><div class='related-posts'>no</div>"
     f"<section id=related-work>{LONG} c</section><div class='share-buttons top'>no</div></article>", f"{LONG}\n{LONG} b\n{LONG} c"),
])
def test_headings_beside_the_text_and_names_inside_it(page, text):
    assert html_text.main_text(page) == text


@pytest.mark.parametrize("page", [
    "<div>" * 100_000 + "deep", "<b>" * 50_000 + "<p>deep" * 50_000, "<article>" * 50_000 + "deep", "<ul><li>" * 50_000 + "deep",
    "<table><tr><td>" * 30_000 + "deep", "<div>" * 50_000 + "</b>" * 50_000 + "deep",
])
def test_deeply_nested_pages_take_linear_time(page):
    start = time.process_time()
    assert "deep" in html_text.main_text(page)
    assert time.process_time() - start < 4  # a second or so; minutes if every tag searched the stack


def test_pages_keep_rows_and_columns(spark):
    df = spark.createDataFrame([(1, "<p>a</p>", "old"), (1, "<p>a</p>", "old"), (None, None, None)], "page_id int, html string, text string")
    found = html_text.extract_text(df)
    assert found.columns == df.columns and sorted(r.text for r in found.collect()) == ["", "a", "a"]
    assert html_text.extract_text(df.where("false")).count() == 0


def base(rows):
    """Everything but the model's score, counted plainly."""
    cut = [(i, (t or "").encode().lower().split() + [None], zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0) for i, t in rows]
    counts = Counter(w for _, ws, held in cut if not held for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    return [
        (i, held, len(ws), sum(counts[w] > 0 for w in ws), total,
         sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws))
        for i, ws, held in cut
    ]


def agree(got, rows):
    key = lambda r: (repr(r[0]), r[2], round(r[5], 4))
    got, want = sorted(map(tuple, got), key=key), sorted(base(rows), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(math.isclose(g[5], w[5], rel_tol=1e-9) for g, w in zip(got, want))
    assert all(g[6] < 0 and math.isfinite(g[6]) for g in got)


def test_registered_lm_scoring(spark, documents):
    rows = queries.op10_lm_scoring(spark, SMALL).collect()
    agree(rows, [(r.doc_id, r.text) for r in documents.collect()])
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.95 * sum(r.base_score for r in held)


def test_lm_scoring_of_odd_rows(odd, empty):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    for size in (1 << 24, 100_000):
        agree(pitman_yor.score_texts(odd, chunk_bytes=size).select(names).collect(), [r[:2] for r in odd_rows()])
    assert pitman_yor.score_texts(empty).count() == 0


def test_model_is_a_distribution(documents):
    training = documents.select("text")
    counts = stage(pitman_yor.word_counts(training), "words")
    model = pitman_yor.fit(training, counts)
    assert np.allclose((10.0 ** model.log_class.astype(float)).sum(axis=1), 1, atol=1e-4)
    for klass in (pitman_yor.FREQUENT, pitman_yor.FREQUENT + 9, pitman_yor.END - 1):
        top = set(model.frequent.tolist())
        own = [r["count"] for r in counts.where(f"ending = {klass}").collect() if r.word not in top]
        each = model.log_word(np.full(len(own) + 1, klass), np.array([*own, 0]))
        # one unit of strength and each word's discount make up the unseen words
        assert math.isclose((10.0**each).sum(), 1, rel_tol=1e-6)


def word_hash(word):
    run = next(pitman_yor.runs(pitman_yor.pa.array([word])))
    hashes, ending = pitman_yor._words(run)
    return int(hashes[0]), int(ending[0])


def test_rare_words_know_each_other(spark):
    """Every pair of words counts, beyond the words that are classes: held against plain counts."""
    draw = np.random.default_rng(5)
    common = [f"c{i}" for i in range(pitman_yor.FREQUENT)]
    rare = [(f"a{i}xy", f"b{i}zy") for i in range(40)]
    rows = []
    for i in range(400):
        # The rare words end alike: by classes alone, any first word goes with any second word.
        middle = [w for k in draw.permutation(40)[:2] for w in rare[k]]
        rows.append((i, " ".join([*draw.choice(common, 60), *middle, *draw.choice(common, 40)])))
    together, apart = [k for k in range(10_000, 11_000) if zlib.crc32(str(k).encode()) % 10 == 0][:2]
    rows += [(together, "a1xy b1zy a2xy b2zy"), (apart, "a1xy b2zy a2xy b1zy"), (20_000, "new a1xy other"), (20_001, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    training = df.where(~pitman_yor.held_out("doc_id", 10))
    model = pitman_yor.fit(training, stage(pitman_yor.word_counts(training), "words"))

    texts = {i: ["", *(t or "").split(), ""] for i, t in rows}
    learnt = [texts[i] for i, _ in rows if zlib.crc32(str(i).encode()) % 10]
    words = Counter(w for t in learnt for w in t[1:])
    pairs = Counter(p for t in learnt for p in zip(t, t[1:]))
    kinds = Counter(u for u, _ in pairs)
    once, twice = (sum(n == k for n in pairs.values()) for k in (1, 2))
    rank = dict(zip(model.frequent.tolist(), model.rank.tolist()))

    def klass(word):
        return pitman_yor.END if word == "" else rank.get(word_hash(word)[0], word_hash(word)[1])

    def chance(u, w):
        k = klass(w)
        base = 10.0 ** (float(model.log_class[klass(u), k]) + float(model.log_word(np.array([k]), np.array([words[w]]))[0]))
        d = pitman_yor._discount(once, twice)
        new = (pitman_yor.STRENGTH + d * kinds[u]) * base
        return (max(pairs[u, w] - d, 0) + new) / (pitman_yor.STRENGTH + words[u])

    want = {i: sum(math.log10(chance(u, w)) for u, w in zip(t, t[1:])) for i, t in texts.items()}
    for size in (1 << 24, 3_000):  # one chunk and part, and many
        got = {r.doc_id: r.score for r in pitman_yor.score_texts(df, chunk_bytes=size).collect()}
        assert got.keys() == want.keys()
        assert all(math.isclose(got[i], want[i], rel_tol=1e-5) for i in want)
        assert got[together] > got[apart] + 2
    # What follows a rare word sums to one, the unseen words of each class counted as one.
    assert not set(rank) & {word_hash(w)[0] for w in ("a1xy", "b1zy")}
    unseen = {c: 10.0 ** float(model.log_word(np.array([c]), np.array([0]))[0]) for c in range(pitman_yor.FREQUENT, pitman_yor.END)}
    d = pitman_yor._discount(once, twice)
    left = (pitman_yor.STRENGTH + d * kinds["a1xy"]) / (pitman_yor.STRENGTH + words["a1xy"])
    rest = left * sum(10.0 ** float(model.log_class[klass("a1xy"), c]) * p for c, p in unseen.items())
    empty_classes = left * sum(10.0 ** float(model.log_class[klass("a1xy"), c]) for c in range(len(model.frequent), pitman_yor.FREQUENT))
    assert math.isclose(sum(chance("a1xy", w) for w in words) + rest + empty_classes, 1, rel_tol=1e-4)


def test_words_are_seated_and_classes_seat_their_tables(spark, monkeypatch):
    """The registered query's model: scores by the tables of every pair, held against plain counts."""
    draw = np.random.default_rng(8)
    words = [f"w{i}{e}" for i in range(900) for e in ("xy", "zy")]
    chances = 1 / np.arange(1, len(words) + 1) ** 0.9
    rows = [(i, " ".join(draw.choice(words, 80, p=chances / chances.sum()))) for i in range(300)]
    rows += [(1000 + i, "w899xy w899zy " * 6) for i in range(20)] + [(2000, "new w899xy other"), (2001, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    training = df.where(~pitman_yor.held_out("doc_id", 10))
    learnt = [["", *(t or "").split(), ""] for i, t in rows if zlib.crc32(str(i).encode()) % 10]
    seen, pairs = Counter(w for t in learnt for w in t[1:]), Counter(p for t in learnt for p in zip(t, t[1:]))
    once, twice = (sum(n == k for n in pairs.values()) for k in (1, 2))
    customers, recount = [], pitman_yor._Classes.recount
    monkeypatch.setattr(pitman_yor._Classes, "recount", lambda self, counts: (
        customers.append(counts.agg({"count": "sum"}).first()[0]), recount(self, counts)))
    size = sum(len(t or "") for _, t in rows)
    for chunk_bytes in (1 << 24, 20_000):  # one part, and four that share the pairs of frequent words
        customers.clear()
        parts = -(-size // (2 * chunk_bytes))
        model, tables, sums_of, samples = pitman_yor.fit_words(training, stage(pitman_yor.word_counts(training), "words"), parts)
        assert len(customers) == pitman_yor.ROUNDS - 1 and all(len(pairs) < n < sum(pairs.values()) for n in customers)
        hot = np.sort(np.append(model.frequent, pitman_yor.END_HASH))
        whole = pitman_yor.pa.table({"text": [t for i, t in rows if zlib.crc32(str(i).encode()) % 10]})
        p, name = pitman_yor._pairs(whole, hot, parts), {word_hash(w)[0]: w for w in seen if w} | {int(pitman_yor.END_HASH): ""}
        sent = pitman_yor._pair_keys(p.distinct[p.before], p.key & np.uint64((1 << 48) - 1))
        many = sorted((int(p.part[n]), p.before[n], sent[n], name[int(p.distinct[p.before[n]])], name[int(p.distinct[p.follower[n]])])
                      for n in range(len(p.key)) if np.bincount(p.pair)[n] > 1)
        found = {r.part: pitman_yor._counted(pitman_yor.pa.table({k: [r[k]] for k in ("sums", "sums_large")}), "sums") for r in tables.collect()}
        sums = dict(zip([m[3:] for m in many], np.concatenate([found[k] for k in sorted(found)]).tolist(), strict=True))
        assert sums.keys() == {k for k, n in pairs.items() if n > 1} and all(samples <= sums[k] <= samples * pairs[k] for k in sums)
        assert sum(sums.values()) > samples * len(sums)  # not the least seating
        mean = {k: sums.get(k, samples) / samples for k in pairs}
        rank, every = dict(zip(model.frequent.tolist(), model.rank.tolist())), Counter()
        for (u, _), t in mean.items():
            every[u] += t
        assert np.allclose([every[name[int(h)]] * samples for h in hot], sums_of[:-2]) and sums_of[-2:].tolist() == [once, twice]

        def klass(word):
            return pitman_yor.END if word == "" else rank.get(word_hash(word)[0], word_hash(word)[1])

        def chance(u, w):
            k, d = klass(w), pitman_yor._discount(once, twice)
            base = 10.0 ** (float(model.log_class[klass(u), k]) + float(model.log_word(np.array([k]), np.array([seen[w]]))[0]))
            return (pairs[u, w] - d * mean.get((u, w), 0) + (pitman_yor.STRENGTH + d * every[u]) * base) / (pitman_yor.STRENGTH + seen[u])

        want = {i: sum(math.log10(chance(u, w)) for u, w in zip(["", *(t or "").split()], [*(t or "").split(), ""])) for i, t in rows}
        got = {r.doc_id: r.score for r in pitman_yor.score_texts(df, chunk_bytes=chunk_bytes, seated=True).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[i], want[i], rel_tol=1e-5) for i in want)


def test_seated_words_of_odd_rows(spark, odd, empty):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    for size in (1 << 24, 100_000):
        agree(pitman_yor.score_texts(odd, chunk_bytes=size, seated=True).select(names).collect(), [r[:2] for r in odd_rows()])
    assert pitman_yor.score_texts(empty, seated=True).count() == 0
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 10 == 0)
    unknown = pitman_yor.score_texts(spark.createDataFrame([(held, "a b")], "doc_id bigint, text string"), seated=True).collect()
    assert unknown[0].n_known == unknown[0].train_tokens == 0 and unknown[0].n_tokens == 3


def test_few_customers_follow_the_law_of_seatings():
    for counts, parent, discount, strength in (((30, 12), (0.05, 0.3), 0.5, 5.0), ((2, 2), (0.1, 0.2), 0.8, 5.0), ((32, 6), (0.3, 0.2), 0.7, 1.0)):
        n, draw, total = 2000, np.random.default_rng(6), 0
        home = (np.tile(counts, n), np.repeat(np.arange(n), 2), np.tile(parent, n), discount, strength, draw)
        tables = np.ones(2 * n, np.int64)
        for turn in range(25):
            around = np.bincount(home[1], tables).astype(np.int64)
            tables = seating.reseat_few(tables, *home, around)
            assert (around == np.bincount(home[1], tables)).all()
            total = total + tables.reshape(-1, 2).mean(axis=0) * (turn >= 5)
        assert np.allclose(total / 20, tables_by_enumeration(counts, parent, discount, strength), rtol=0.02)


def test_pairs_of_a_chunk_are_numbered_by_words(monkeypatch):
    """Pairs are told apart by their words, not by a hash, and scored once each, whatever the order of the rows."""
    texts = [(i, " ".join(f"w{k}" for k in np.random.default_rng(i).integers(0, 30, 200))) for i in range(20)]
    plain = {p for _, t in texts for p in zip(["", *t.split()], [*t.split(), ""])}
    hot = np.array([pitman_yor.END_HASH])

    def chunk(rows):
        ids, own = zip(*rows)
        return pitman_yor.pa.table({"doc_id": ids, "text": own, "train": [True] * len(ids), "chunk": np.zeros(len(ids), np.int32)})

    asked = pitman_yor._ask(hot, 3)(chunk(texts))
    assert asked.equals(pitman_yor._ask(hot, 3)(chunk(texts[::-1])))
    answers = [pitman_yor._answer(hot)(asked.filter(pitman_yor.pc.equal(asked.column("part"), n))) for n in range(3)]
    sent = pitman_yor.pa.concat_tables(answers)
    rows, facts = (sent.filter(f(sent.column("chunk"))) for f in (pitman_yor.pc.is_valid, pitman_yor.pc.is_null))
    whole = np.sum(facts.column("sums").to_pylist(), axis=0)
    last = {f.name: pitman_yor.pa.nulls(1, f.type) for f in sent.schema} | {"sums": pitman_yor.pa.array([whole.tolist()])}
    told = pitman_yor.pa.concat_tables([rows, pitman_yor.pa.table(last)])
    n = pitman_yor.CLASSES
    model = pitman_yor.Model(np.empty(0, np.int64), np.empty(0, np.int64), np.full((n, n), -3.0, np.float32),
                             np.full(n, 0.5), np.full(n, 900.0), np.full(n, 30.0), 4020, 31)
    scored, chance = [], pitman_yor._chance
    monkeypatch.setattr(pitman_yor, "_chance", lambda seen, *rest: scored.append(len(seen)) or chance(seen, *rest))
    score = pitman_yor._score(model, hot, np.array([20]), 3)
    found = [score(chunk(r), told).sort_by("doc_id") for r in (texts, texts[::-1])]
    assert found[0].equals(found[1]) and scored == [len(plain)] * 2
    monkeypatch.setattr(pitman_yor, "_pair_keys", lambda before, word: np.zeros(len(word), np.uint64))
    assert len(pitman_yor._pairs(chunk(texts), hot, 3).key) == len(plain)


def test_pairs_are_numbered_alike_at_any_width():
    draw = np.random.default_rng(9)
    for most in (1, 2, 700, 2**31):  # with the place in one number, and without
        for size in (0, 1, 5000):
            first, second = draw.integers(0, most, size), draw.integers(0, most, size)
            before, after, pair = pitman_yor._numbered_pairs(first, second, most)
            assert list(zip(before, after)) == sorted(set(zip(first, second)))
            assert (before[pair] == first).all() and (after[pair] == second).all()


def test_openings_are_sorted_once_a_block(monkeypatch):
    """A block is drawn and sorted, then the seating: nothing is sorted to weigh either."""
    draw, calls, plain = np.random.default_rng(4), [], seating._sorted
    counts, group, parent = np.array([900, 40, 7]), np.zeros(3, np.int64), np.array([0.2, 0.3, 0.1])
    now = seating.extend(None, counts, group, parent, 0.5, 5.0, draw)
    monkeypatch.setattr(seating, "_sorted", lambda *columns: calls.append(1) or plain(*columns))
    seating.sweep(now, counts, group, parent, 0.5, 5.0, draw)
    assert len(calls) == 2 * 9  # blocks of a row of 900: halves down to its second customer
    for most in (1000, 2**62):  # as one number, and as two columns
        dish, when = draw.integers(0, 50, 300), draw.integers(1, most, 300)
        found, order = plain(dish, when), np.lexsort((when, dish))
        assert (found.dish == dish[order]).all() and (found.when == when[order]).all()
    x = np.array([1e-9, 1e-3, 0.5, 3.0, 70.0, 1e6, 1e12])
    assert np.allclose(seating.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-9)


def test_seating_follows_the_restaurant():
    """Mean tables of one dish alone: the expectation of a Pitman-Yor restaurant."""
    n, discount, strength = 200, 0.5, 5.0
    t = 1.0
    for k in range(1, n):
        t += (strength + discount * t) / (strength + k)
    for sweeps in (0, 8):
        found = np.mean([pitman_yor.seat(np.array([n]), np.array([1.0]), discount, strength, s, sweeps)[0][0] for s in range(200)])
        assert abs(found - t) < 0.05 * t
    tables, total = pitman_yor.seat(np.array([1, 7, 500_000]), np.array([0.1, 0.2, 0.7]), 0.5, 5.0, 1)
    assert (tables >= 1).all() and (tables <= [1, 7, 500_000]).all() and total.tolist() == [1, 7, 500_000]


def tables_by_enumeration(counts, parent, discount, strength):
    """Mean tables of two dishes, summed over all seatings by generalised Stirling numbers."""
    kinds = []
    for c in counts:
        row = np.full(c + 1, -np.inf)
        row[1] = 0
        for k in range(1, c):
            t = np.arange(c + 1)
            joins = row + np.log(np.maximum(k - discount * t, 1e-300))
            row = np.logaddexp(np.append(-np.inf, row[:-1]), joins)
        kinds.append(row)
    a, b = np.arange(counts[0] + 1)[:, None], np.arange(counts[1] + 1)[None]
    rise = np.append(0, np.cumsum(np.log(strength + discount * np.arange(sum(counts)))))
    law = kinds[0][:, None] + kinds[1][None] + a * math.log(parent[0]) + b * math.log(parent[1]) + rise[a + b]
    law = np.exp(law - law.max())
    return (law * a).sum() / law.sum(), (law * b).sum() / law.sum()


def test_sweeps_reach_the_law_of_seatings():
    for counts, parent, discount, strength in (((300, 40), (0.05, 0.3), 0.5, 5.0), ((6, 5), (0.3, 0.2), 0.7, 1.0)):
        found = [pitman_yor.seat(np.array(counts), np.array(parent), discount, strength, s, 16)[0] for s in range(400)]
        want = tables_by_enumeration(counts, parent, discount, strength)
        assert np.allclose(np.mean(found, axis=0), want, rtol=0.08)


def test_chains_go_on_when_customers_come_and_go():
    draw, group, parent = np.random.default_rng(3), np.zeros(3, np.int64), np.array([0.2, 0.3, 0.1])
    old_counts, counts = np.array([900, 40, 7]), np.array([500, 90, 7])
    old = seating.extend(None, old_counts, group, parent, 0.5, 5.0, draw)
    now = seating.extend(old, counts, group, parent, 0.5, 5.0, draw, old_counts)
    for d in range(3):
        before, after = old.when[old.dish == d], now.when[now.dish == d]
        shared = min(old_counts[d], counts[d])
        assert after[after <= shared].tolist() == before[before <= shared].tolist() and after.max() <= counts[d]


def test_pipeline_takes_effect_stage_by_stage(spark, documents):
    docs, sizes = documents, {}
    for name, build in corpus_pipeline.STAGES:
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}"
        build(spark, docs, SMALL).write.mode("overwrite").parquet(path)
        before, docs = docs, spark.read.parquet(path)
        sizes[name] = docs
        if name != "sharding":
            assert docs.columns == documents.columns
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "quality_rules":
            labels = spark.read.parquet(f"{SMALL}/labels.parquet")
            good = {r.doc_id for r in labels.where("quality = 1").collect()}
            table = stage(quality_rules.measured(before).select("doc_id", "measures"), "m")
            rules = quality_rules.learn_rules(quality_rules.labelled_rows(table, labels))
            assert ids == {r.doc_id for r in table.where(quality_rules.kept(rules)).collect()}
            base_failed = {r.doc_id for r in table.where(quality_rules.base_failed()).collect()}
            assert len(good - ids - base_failed) <= 0.05 * len(good)
        elif name == "simhash_near_dedup":
            assert ids == {r.component_id for r in simhash.near_groups(before).collect()}
        elif name == "decontamination":
            bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
            leaks = {r.doc_id for r in decontamination.find_leaks(before, bench).collect()}
            assert ids == {r.doc_id for r in before.collect()} - leaks
        elif name == "mixing":
            want = {r.id: r.copies for r in mixing.mix_counts(before).collect() if r.copies}
            assert Counter(r.doc_id for r in docs.collect()) == want
        else:
            assert docs.count() == before.count()
            again = sharding.shard_by_bytes(before).select("doc_id", "shard", "slot").collect()
            assert sorted(again) == sorted(docs.select("doc_id", "shard", "slot").collect())
    assert corpus_pipeline.run(spark, SMALL).count() == docs.count()


def test_entry_without_the_subpackage(tmp_path):
    for name in ("titleweave", "checks", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(ROOT / name)
    (tmp_path / "titleweave").unlink()
    (tmp_path / "titleweave").mkdir()
    for part in (ROOT / "titleweave").iterdir():
        if part.name != "llm":
            (tmp_path / "titleweave" / part.name).symlink_to(part)
    (tmp_path / "entry.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import entry; q = entry.queries(); assert q and not any(n.startswith('op') and '_' in n and n[2].isdigit() for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
