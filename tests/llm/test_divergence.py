"""The divergence audit against SQL and against brute force, with the awkward rows."""

import random
import re
from collections import Counter

import compare
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarnworks.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, kept long, value string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, s, -7, "x", 3, "y") for i, (t, la, s) in enumerate(rows)], SCHEMA).repartition(3)


def brute(rows, least, top):
    docs = [(la or "", s or "", [w.translate({c: c + 32 for c in range(65, 91)}) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")])
            for t, la, s in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        used = Counter(w for d in own for w in set(d[2]))
        kept = [w for w, n in used.items() if n >= least]
        counts = {s: Counter() for s in {d[1] for d in own}}
        for _, s, words in own:
            counts[s].update(w for w in words if w in kept)
        counts[None] = sum(counts.values(), Counter())

        def shares(s):
            size = sum(counts[s].values()) + 5 * len(kept)
            return {w: 1 + 10**9 * (counts[s][w] + 5) // size for w in kept}

        p = {s: shares(s) for s in counts}
        for s in counts.keys() - {None}:
            pairs = [(-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode(), o) for o in counts.keys() - {None, s}]
            terms = [(p[None][w] - p[s][w], w.encode(), w) for w in kept if counts[s][w] and p[s][w] > p[None][w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -v, r) for r, (v, _, item) in enumerate(found, 1)}
    return out


def made(seed, n=240):
    rng = random.Random(seed)
    words = ["a", "B", "b", "ä", "Ä", "日本", "c1d", "x" * 50, *(chr(97 + i // 26) + chr(97 + i % 26) for i in range(60))]
    rows = []
    for _ in range(n):
        s = rng.choice(["hot"] * 6 + [f"s{i}" for i in range(8)] + [None, "", "Ω"])
        text = "".join(rng.choice(words[: 5 + 10 * (len(str(s)) % 5 + 1)]) + rng.choice(" \n-_0`{") for _ in range(rng.randrange(0, 25)))
        rows.append((rng.choice([text, text, text, None, "", "12 34"]), rng.choice(["en", "en", "en", "de", None, "zz"]) , s))
    return rows


@pytest.mark.parametrize("seed, least, top, part, sources, terms, merged", [(1, 3, 4, 4, 2, 3, 8), (2, 2, 50, 1024, 256, 4096, 8192), (3, 5, 1, 1, 3, 1, 2)])
def test_matches_brute_force(spark, seed, least, top, part, sources, terms, merged):
    rows = made(seed)
    got = divergence.audit(frame(spark, rows), least, top, part, sources, terms, merged).collect()
    assert len(got) == len({(r.lang, r.source, r.part, r.item) for r in got})
    assert {tuple(r) for r in got} == brute(rows, least, top)


def test_matches_sql(spark, sf_dir):
    df = divergence.query(spark, sf_dir)
    assert compare.differences(df, compare.connect(sf_dir), divergence.ORACLE) == []


def test_empty_table_and_language_without_kept_terms(spark):
    assert divergence.audit(frame(spark, [])).collect() == []
    got = divergence.audit(frame(spark, [("one", "en", "b"), ("two", "en", "a"), (None, None, None)])).collect()
    assert {tuple(r) for r in got} == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}


def test_long_texts_are_counted_whole():
    piece, joint = "wörd ", "y" * (divergence._BYTES_AT_ONCE + 10)
    text = (piece * (3 * divergence._BYTES_AT_ONCE // 5) + joint + " end").encode()
    counts = Counter(w for part in divergence._pieces(text) for w in divergence._TERM.findall(part))
    assert counts == Counter(divergence._TERM.findall(text))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=60), st.integers(1, 4), st.integers(1, 7))
def test_band_holds_whatever_fewer_than_k_others_dominate(points, k, step):
    """Batches don't matter, nothing outside the band has fewer than k dominators, and none inside has k."""
    n, lang_n = (np.array([p[i] for p in points], dtype=np.int64) for i in (0, 1))
    band = divergence._Band(k)
    got = np.concatenate([np.zeros(0, dtype=bool), *(band.add(n[i : i + step], lang_n[i : i + step]) for i in range(0, len(points), step))])
    want = [sum(n[j] >= n[i] and lang_n[j] <= lang_n[i] for j in range(i)) < k for i in range(len(points))]
    assert got.tolist() == want


def test_shares_are_exact_for_large_counts(spark):
    values = [(0, 5), (10**12 + 7, 3 * 10**12 + 11), (10**15, 10**15 + 5), (123_456_789_012_345, 8_999_999_999_999_999)]
    rows = spark.createDataFrame(values, "n long, size long").select("n", "size", divergence.share(F.col("n"), F.col("size")).alias("p"))
    for r in rows.collect():
        assert r.p == 1 + 10**9 * (r.n + 5) // r["size"]
        assert divergence._share(np.array([r.n]), np.array([r["size"]]))[0] == r.p



def test_terms_of_a_long_text_count_as_one_document():
    text = ("wörd WÖRD x " * (divergence._BYTES_AT_ONCE // 8)).encode()
    batch = pa.RecordBatch.from_pydict({"lang": ["a"] * 3, "source": ["s", "s", "t"], "text": [text, b"x", b"12"]})
    rows = [r for out in divergence._count_terms(iter([batch])) for r in out.to_pylist()]
    times = divergence._BYTES_AT_ONCE // 8
    assert sorted((r["source"], r["term"] or b"", r["n"], r["docs"]) for r in rows) == sorted([
        ("s", b"", 0, 0), ("t", b"", 0, 0), ("s", "wörd".encode(), times, 1), ("s", "wÖrd".encode(), times, 1), ("s", b"x", times + 1, 2)])
