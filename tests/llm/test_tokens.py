import base64
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

tiktoken = pytest.importorskip("tiktoken")

from tallyweave.llm import bpe_trie, mixture, tokens  # noqa: E402


@pytest.fixture(scope="module")
def reference():
    with open(bpe_trie.vocabulary_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=bpe_trie.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(data: bytes) -> list[int]:
    import numpy as np

    return np.frombuffer(data, np.int32).tolist()


TEXTS = ["", None, "   ", "a", "<|endoftext|>", "it's 'S don'T", "\x1c\x85 x", "日本語" * 40, "́" * 30, "é﻿", " " * 700, "a" * 900, "x\r\n\r\n  y\t", "🙂🙃" * 9]


def test_exact(reference):
    trie = bpe_trie.TrieEncoder()
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("abcdefghijklmnopqrst '\n 0123ÄßあЖ_-=") for _ in range(rng.randrange(60))) for _ in range(1500)]
    assert [ids(x) for x in trie.encode_batch(texts)] == [reference.encode_ordinary(t or "") for t in texts]
    assert [ids(trie.encode(t)) for t in TEXTS] == [reference.encode_ordinary(t or "") for t in TEXTS]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", max_codepoint=0x4FF), max_size=40))
def test_any_text(text):
    trie = bpe_trie.encoder()
    assert reference_ids(text) == ids(trie.encode(text))


def reference_ids(text, cache=[]):  # noqa: B006
    if not cache:
        with open(bpe_trie.vocabulary_path(), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        cache.append(tiktoken.Encoding("own", pat_str=bpe_trie.PATTERN, mergeable_ranks=ranks, special_tokens={}))
    return cache[0].encode_ordinary(text)


def test_long_texts_and_full_store(reference, monkeypatch):
    monkeypatch.setattr(bpe_trie, "LONG_TEXT", 50)
    monkeypatch.setattr(bpe_trie, "WORDS_KEPT", 5)
    trie = bpe_trie.TrieEncoder()
    text = "some words, and 12 more words; " * 40
    assert ids(trie.encode_batch([text, "short one"])[0]) == reference.encode_ordinary(text)


def test_table(spark, reference):
    rows = [(k, t, "clash") for k, t in enumerate(TEXTS)] + [(0, "", "clash"), (None, "a b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = tokens.token_ids(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.ids == reference.encode_ordinary(TEXTS[r.doc_id] or "")
    assert tokens.token_ids(df.limit(0)).count() == 0


def documents(spark, n=400):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice("red green blue one two three".split()) + str(rng.randrange(999)) for _ in range(rng.randrange(1, 60))), rng.choice(["a", "a", "a", "b", "c"])) for k in range(n)]
    rows += [(n, None, "a"), (n + 1, "", "b"), (n + 2, "unlisted text", "z"), (n + 3, "no source", None), (n + 4, rows[0][1], rows[0][2])]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixture(spark):
    docs = documents(spark)
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.4, 4), ("c", 0.25, 3), ("none", 0.05, 2)], "source string, target_share double, max_repeats int")
    rows = mixture.mixture(docs, targets).collect()
    assert len({(r.slot, r.source, r.doc_id, r.repeat) for r in rows}) == len(rows)
    uses = {}
    for r in rows:
        uses[r.doc_id] = uses.get(r.doc_id, 0) + 1
    caps = {"a": 1, "b": 4, "c": 3}
    assert all(uses[r.doc_id] <= caps[r.source] for r in rows)
    assert 404 not in uses or 0 not in uses
    again = mixture.mixture(docs.repartition(3), targets).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))
    report = {r.source: r for r in mixture.shares(docs, targets).collect()}
    for s in "abc":
        assert report[s].share_of_total == pytest.approx(report[s].target_share, abs=0.02) or report[s].times_used == caps[s]
    assert report["none"].tokens == 0 and report["none"].actual_share == 0
    assert mixture.mixture(docs.limit(0), targets).count() == 0
    assert mixture.mixture(docs, targets.limit(0)).count() == 0
