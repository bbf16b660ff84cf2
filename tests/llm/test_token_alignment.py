"""Alignment of two tokenizers against the tokenizer libraries and plain loops."""

import hashlib
import heapq
import json
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from llm_rows import SCHEMA, SMALL, documents, empty, odd, prose  # noqa: F401

from titleweave.llm import queries, token_alignment

FOLDER = Path(token_alignment.TOKENIZERS)
A_PATH, B_PATH = FOLDER / token_alignment.A_FILE, FOLDER / token_alignment.B_FILE
pytestmark = pytest.mark.skipif(not A_PATH.exists(), reason="tokenizer files not present")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    byte_level = Tokenizer.from_file(str(A_PATH))
    byte_level.encode_special_tokens = True
    return byte_level, sentencepiece.SentencePieceProcessor(model_file=str(B_PATH))


def tokens(libraries, text):
    """Both sides' (id, bytes), or nothing where either does not spell the text."""
    byte_level, pieces = libraries
    if not text:
        return [], []
    a = byte_level.encode(" " + text, add_special_tokens=False)
    symbols = token_alignment.byte_symbols()
    a = [(i, bytes(symbols[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
    names = [(i, pieces.id_to_piece(i)) for i in pieces.encode(text)]
    is_byte = lambda n: len(n) == 6 and n.startswith("<0x") and n.endswith(">")
    b = [(i, bytes.fromhex(n[3:5]) if is_byte(n) else n.replace("▁", " ").encode()) for i, n in names]
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == b"".join(x for _, x in b) == want else ([], [])


def by_hand(libraries, texts):
    """Result columns of every text."""
    found, corpus = [], Counter()
    for text in texts:
        a, b = tokens(libraries, text)
        ends = []
        for side in (a, b):
            at, own = 0, {}
            for i, raw in side:
                at += len(raw)
                own[at] = i
            ends.append(own)
        joint = sorted(set(ends[0]) & set(ends[1]))
        groups, left = [], [list(own.items()) for own in ends]
        for side in left:
            side.reverse()
        for end in joint:
            parts = []
            for side in left:
                own = []
                while side and side[-1][0] <= end:
                    own.append(str(side.pop()[1]))
                parts.append(",".join(own))
            groups.append("|".join(parts))
        links = [(ends[1][e], ends[0][e]) for e in joint]
        corpus.update(links)
        found.append((len(a), len(b), ";".join(groups), links))
    highest = Counter()
    for (b, _), n in corpus.items():
        highest[b] = max(highest[b], n)
    return [
        (n_a, n_b, len(links), len(links), sum(corpus[x] == highest[x[0]] for x in links), sum(corpus[x] for x in links), groups)
        for n_a, n_b, groups, links in found
    ], corpus, highest


COLUMNS = "n_a n_b n_groups n_links n_best count_sum groups".split()


def test_registered_query(spark, documents, libraries):
    texts = {r.doc_id: r.text for r in documents.collect()}
    want, _, _ = by_hand(libraries, texts.values())
    sha = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    expected = {i: (*row[:-1], sha(row[-1])) for i, row in zip(texts, want)}
    rows = queries.op13_token_alignment(spark, SMALL).collect()
    got = {r.doc_id: tuple(r[c] for c in (*COLUMNS[:-1], "groups_sha256")) for r in rows}
    assert got == expected and len(rows) == len(texts)


def odd_texts():
    draw = random.Random(8)
    signs = "ab \n\tABé中\U0001F600▁<>|/s0xé\x00\x85　ﬁ½"
    texts = ["".join(draw.choice(signs) for _ in range(draw.randint(0, 60))) for _ in range(150)]
    texts += ["<s> </s> <unk> <|endoftext|>", "<0x41>", "a▁b", " ", "   ", "\n\n", "x" * 3000, prose(9, 5000), None, ""]
    return texts


def test_merging_in_rounds_and_groups_of_chunks(spark, libraries):
    """Small chunks, radices and fan-in, so that every round and group is met; also the pair table."""
    texts = odd_texts() + ["the hot text of many rows"] * 200
    want, corpus, highest = by_hand(libraries, texts)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    options = {"radices": 3, "chunk_bytes": 500}
    rows = token_alignment.align(df, fan_in=2, chunks_per_group=3, **options).collect()
    assert {r.doc_id: tuple(r[c] for c in COLUMNS) for r in rows} == dict(enumerate(want))
    table = token_alignment.pair_counts(token_alignment.pair_totals(token_alignment.encoded(df, **options), 2)).collect()
    assert {(r.b, r.a): (r.n, r.is_best) for r in table} == {x: (n, n == highest[x[0]]) for x, n in corpus.items()}
    assert len(table) == len(corpus)


def test_odd_rows(odd, empty, libraries):
    rows = token_alignment.align(odd).collect()
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    want, _, _ = by_hand(libraries, [t for _, t in texts])
    key = lambda r: (r[0] is not None, r)
    got = sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in rows), key=key)
    assert got == sorted(((i, *row) for (i, _), row in zip(texts, want)), key=key)
    assert token_alignment.align(empty).collect() == []


def test_both_byte_level_encoders_agree(libraries):
    pair = token_alignment.tokenizers(str(A_PATH), str(B_PATH))
    texts = [t for t in odd_texts() if t]
    assert pair.a.encode(texts) == [libraries[0].encode(" " + t, add_special_tokens=False).ids for t in texts]


def test_vocabulary_out_of_merge_order_is_refused(tmp_path):
    content = json.loads(A_PATH.read_text())
    first, second = content["model"]["merges"][:2]
    content["model"]["merges"][:2] = [second, first]
    path = tmp_path / "vocabulary.json"
    path.write_text(json.dumps(content))
    with pytest.raises(ValueError):
        token_alignment.ByteLevel(str(path))


def test_runs_come_back_and_merge():
    draw = np.random.default_rng(3)
    runs = []
    for size in (0, 1, 5, token_alignment.BLOCK_PAIRS, 2 * token_alignment.BLOCK_PAIRS + 7):
        pairs = np.unique(draw.integers(0, 2**40, size))
        runs.append((pairs, draw.integers(1, 2**33, len(pairs))))
    written = [token_alignment.write_run(*r) for r in runs]
    for run, raw in zip(runs, written):
        back = list(token_alignment.read_run(raw))
        for k, column in enumerate(run):
            assert np.concatenate([b[k] for b in back] or [np.empty(0)]).tolist() == column.tolist()
    both = Counter()
    for pairs, n in runs + runs[:4]:
        both.update(dict(zip(pairs.tolist(), n.tolist())))
    assert list(token_alignment.merge_runs(written + written[:4])) == sorted(both.items())
    assert list(heapq.merge(*[token_alignment.merge_runs([w]) for w in written[:2]])) == list(token_alignment.merge_runs(written[:2]))
