"""The registered query scores with contexts of two words at least."""

import pytest
from test_ngram_trie import brute

from tarnworks.llm import ngram_trie
from tarnworks.llm.queries import LLM_QUERIES


def test_registered_order(spark, folder):
    rows = [(i, " ".join(f"w{(i * j + j // 3) % 7}" for j in range(30))) for i in range(40)]
    place = folder("order")
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{place}/documents.parquet")
    got = {r["doc_id"]: r["score"] for r in LLM_QUERIES["op10_ngram_trie"](spark, place).collect()}
    assert ngram_trie.ORDER >= 3
    for (key, _), b in zip(rows, brute(rows, ngram_trie.ORDER)):
        assert got[key] == pytest.approx(b[-1], rel=1e-3)
    bigrams = brute(rows, 2)
    assert sum(abs(got[k] - b[-1]) > 0.1 for (k, _), b in zip(rows, bigrams)) > 20
