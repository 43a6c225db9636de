"""The trie against a plain dictionary model, and its sequences against sorted arrays."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tarnworks.llm import ngram_trie
from tarnworks.llm.elias_fano import Sequence, encode


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300), st.integers(5001, 1 << 60))
def test_sequence_against_array(values, universe):
    values = np.array(sorted(values), dtype=np.uint64)
    coded = Sequence(encode(values, universe))
    assert (coded.get(np.arange(len(values))) == values).all()
    asked = np.arange(0, 5003, 7, dtype=np.uint64)
    place, equal = coded.successor(asked)
    assert (equal == np.isin(asked, values)).all()
    assert (place[equal] == np.searchsorted(values, asked[equal])).all()


def brute(rows, order):
    docs = {i: ngram_trie.words_of(t) + [b""] for i, t in enumerate(t for _, t in rows)}
    held = [k is not None and zlib.crc32(str(k).encode()) % 5 == 1 for k, _ in rows]
    uni, grams = Counter(), [defaultdict(Counter) for _ in range(order + 1)]
    for i, tokens in docs.items():
        if held[i]:
            continue
        uni.update(tokens)
        padded = [b""] + tokens
        for k in range(2, order + 1):
            for j in range(len(padded) - k + 1):
                grams[k][tuple(padded[j : j + k - 1])][padded[j + k - 1]] += 1
    total, vocabulary = sum(uni.values()), len(uni)
    for i, tokens in docs.items():
        padded, base, score = [b""] + tokens, 0.0, 0.0
        for j in range(1, len(padded)):
            p = (uni[padded[j]] + 0.5) / (total + 0.5 * (vocabulary + 1))
            base += math.log10(p)
            for k in range(2, order + 1):
                if j - k + 1 < 0:
                    break
                seen = grams[k].get(tuple(padded[j - k + 1 : j]))
                if not seen:
                    break
                context = padded[j - k + 1 : j]
                n = uni[context[0]] if k == 2 else grams[k - 1][tuple(context[:-1])][context[-1]]
                p = max(seen[padded[j]] - 0.75, 0) / n + 0.75 * len(seen) / n * p
            score += math.log10(p)
        yield held[i], len(tokens), sum(uni[t] > 0 for t in tokens), total, base, score


@pytest.mark.parametrize("order,tokens", [(2, 1 << 21), (2, 40), (3, 60)])
def test_against_dictionaries(spark, monkeypatch, order, tokens):
    monkeypatch.setattr(ngram_trie, "TOKENS_PER_SHARD", tokens)
    monkeypatch.setattr(ngram_trie, "WORDS_PER_SHARD", 1 << 18 if tokens > 1000 else 4)
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["The", "the", "a", "Cat", "sat", "mat", "ran", "é", "x\x1fy"], size=n, p=[.3, .2, .1, .1, .1, .05, .05, .05, .05])) for n in rng.integers(0, 40, size=40)]
    rows = list(enumerate(texts)) + [(None, None), (None, "the the"), (41, ""), (7, texts[7]), (42, "the " * 500), (43, "unheard of\twords")]
    df = spark.createDataFrame([(k, t, 1, "z") for k, t in rows], "doc_id long, text string, n_tokens int, score string").repartition(3)
    got = sorted(ngram_trie.held_out_scores(df, order=order).collect(), key=lambda r: (str(r[0]), r[2], r[6]))
    want = sorted(((k, *b) for (k, _), b in zip(rows, brute(rows, order))), key=lambda r: (str(r[0]), r[2], r[6]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g)[:5] == tuple(w)[:5]
        assert g["base_score"] == pytest.approx(w[5], abs=1e-9)
        assert g["score"] == pytest.approx(w[6], abs=2e-3 * w[2])


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_trie.held_out_scores(df).collect() == []


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5 == 1)
    row = ngram_trie.held_out_scores(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row["n_known"], row["train_tokens"], row["n_tokens"]) == (0, 0, 3)
