"""SimHash and embedding links against all pairs, in small tables of awkward rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarnworks.llm import balltree, flat_graph, simhash
from tarnworks.llm.components import components
from tarnworks.llm.scratch import Scratch


def groups(n, pairs):
    label = list(range(n))
    for a, b in pairs:
        old, new = max(label[a], label[b]), min(label[a], label[b])
        label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = np.random.default_rng(2)
    pairs = {"chain": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 60)], "none": [],
             "random": [tuple(p) for p in rng.integers(0, 80, (50, 2)).tolist()]}[shape]
    edges = spark.createDataFrame([(int(a), int(b)) for a, b in pairs], "u long, v long")
    got = {r["node"]: r["root"] for r in components(edges, Scratch(spark, "t")).collect()}
    label = groups(81, pairs)
    assert got == {i: label[i] for p in pairs for i in p if p[0] != p[1]}


def plain_fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("bucket", [256, 2])
def test_simhash(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket)
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(400)]
    base = [list(rng.choice(words, size=n)) for n in (60, 80, 120, 400)]
    texts = [None, "", "  \n", "one", "one two", "A b C", "a B c", "x " * 5000]
    for b in base:
        texts.append(" ".join(b))
        for _ in range(14):
            changed = list(b)
            for at in rng.integers(0, len(b), rng.integers(1, 3)):
                changed[at] = str(rng.choice(words))
            texts.append(" ".join(changed))
    rows = [(i * 3 % 101, t) for i, t in enumerate(texts)]
    rows += rows[:4]
    df = spark.createDataFrame([(k, t, "f", 1) for k, t in rows], "doc_id long, text string, fp string, id int").repartition(3)
    prints = [plain_fingerprint(t) for _, t in rows]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    label = groups(len(rows), pairs)
    least = {}
    for (k, _), root in zip(rows, label):
        least[root] = min(least.get(root, k), k)
    want = sorted((k, f"{p:016x}", least[root]) for (k, _), p, root in zip(rows, prints, label))
    assert sorted(map(tuple, simhash.near_duplicates(df).collect())) == want
    assert len(pairs) > 60
    kept = simhash.keep(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))


def test_simhash_null_keys_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "p q r s"), (5, "p q r s")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in simhash.keep(df).collect()) == [(None, "a b c d"), (None, "p q r s")]
    assert simhash.near_duplicates(df.limit(0)).collect() == []
    assert simhash.keep(df.limit(0)).collect() == []


def vectors():
    rng = np.random.default_rng(6)
    rows = []
    for i in range(300):
        rows.append((i, rng.normal(size=8).tolist()))
    for i in range(300, 420):
        rows.append((i, (np.array(rows[i % 12][1]) + rng.normal(size=8) * 0.12).tolist()))
    rows += [(500 + i, [1.0] + [0.0] * 7) for i in range(40)]
    rows += [(600, None), (601, [0.0] * 8), (602, [float("nan")] * 8), (603, [None] * 8), (604, [float("inf")] + [0.0] * 7), (605, [])]
    return rows


@pytest.mark.parametrize("shard", [2048, 40])
def test_embedding_links(spark, monkeypatch, shard):
    monkeypatch.setattr(flat_graph, "SHARD_ROWS", shard)
    monkeypatch.setattr(flat_graph, "ROWS_PER_CENTRE", 150)
    rows = vectors()
    df = spark.createDataFrame([(k, v, 0, 1.0) for k, v in rows], "vec_id long, embedding array<float>, links int, root double").repartition(3)
    result, recall = flat_graph.link_vectors(df)
    got = {r["vec_id"]: r for r in result.collect()}
    fit = [(k, np.array(v, dtype=np.float32).astype(float)) for k, v in rows if v and None not in v and np.isfinite(v).all() and any(v)]
    x = np.stack([v / np.linalg.norm(v) for _, v in fit])
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    label = groups(len(fit), [(a, b) for a, b in zip(*np.nonzero(close)) if a > b])
    assert recall >= 0.95 and len(got) == len(rows)
    for (k, _), n, root in zip(fit, close.sum(axis=1), label):
        assert (got[k]["n_links"], got[k]["component_id"]) == (n, fit[root][0])
        assert got[k]["kept"] == (k == fit[root][0])
    for k in (600, 601, 602, 603, 604, 605):
        assert tuple(got[k])[1:] == (0, k, True)


@pytest.mark.parametrize("shard", [256, 90])
def test_links_are_mutual_in_crowded_shards(spark, monkeypatch, shard):
    """One dense group that holds a third of all nodes, and pairs near the threshold: every count agrees with brute force."""
    monkeypatch.setattr(flat_graph, "SHARD_ROWS", shard)
    rng = np.random.default_rng(9)
    heart = rng.normal(size=16)
    x = [rng.normal(size=16) for _ in range(500)] + [heart + rng.normal(size=16) * 0.33 for _ in range(400)]
    x += [x[i] + rng.normal(size=16) * 0.4 for i in range(300)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    result, recall = flat_graph.link_vectors(df)
    got = sorted(result.collect(), key=lambda r: r["vec_id"])
    unit = np.stack([v / np.linalg.norm(v) for v in x])
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    found = np.array([r["n_links"] for r in got])
    assert found.sum() % 2 == 0 and recall >= 0.95
    assert (found <= close.sum(axis=1)).all() and found.sum() >= 0.99 * close.sum()
    label = groups(len(x), [(a, b) for a, b in zip(*np.nonzero(close)) if a > b])
    assert sum(r["component_id"] != root for r, root in zip(got, label)) <= 3


def test_audit_weighs_nodes_and_not_links():
    truth = pd.DataFrame({"cid": [1, 2, 3, 4, 5], "true": [1000, 1000, 1, 1, 0]})
    assert flat_graph.audited(truth, pd.DataFrame({"cid": [1, 2, 3, 4], "links": [1000, 1000, 1, 1]})) == 1.0
    assert flat_graph.audited(truth, pd.DataFrame({"cid": [1, 2], "links": [1000, 1000]})) == 0.0  # nothing found for the lonely ones
    assert flat_graph.audited(truth.assign(true=0), pd.DataFrame({"cid": [], "links": []})) == 1.0


def test_embeddings_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert flat_graph.link_vectors(df)[0].collect() == []
    only_null = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in flat_graph.link_vectors(only_null)[0].collect()] == [(1, 0, 1, True)]


@pytest.mark.parametrize("shard,block", [(4096, 4096), (64, 7)])
def test_top_k(spark, monkeypatch, shard, block):
    monkeypatch.setattr(balltree, "SHARD_ROWS", shard)
    monkeypatch.setattr(balltree, "BLOCK_QUERIES", block)
    monkeypatch.setattr(balltree, "LEAF_ROWS", 8)
    rows = [*vectors(), (7, vectors()[3][1]), (None, [1.0] * 8)]
    df = spark.createDataFrame([(k, v, 1) for k, v in rows], "vec_id long, embedding array<float>, v int").repartition(3)
    scaled = balltree.scaled(df, "vec_id", "embedding")
    got = sorted(tuple(r) for r in balltree.top_k(scaled.where("id % 20 = 0"), scaled).collect())
    fit = [(k, np.pad(np.floor(64 * np.array(v, dtype=np.float32).astype(float)), (0, 8 - len(v)))) for k, v in rows
           if k is not None and v is not None and None not in v and np.isfinite(v).all()]
    want = []
    for k, q in fit:
        if k % 20 == 0:
            scores = sorted((-int(q @ v), c) for c, v in fit if c != k)[:20]
            want += [(k, r, c, -s) for r, (s, c) in enumerate(scores, start=1)]
    assert got == sorted(want)


def test_top_k_small_and_empty(spark):
    df = spark.createDataFrame([(20, [1.0]), (21, [0.5, 2.0]), (22, None)], "vec_id long, embedding array<double>")
    scaled = balltree.scaled(df, "vec_id", "embedding")
    assert [tuple(r) for r in balltree.top_k(scaled.where("id % 20 = 0"), scaled).collect()] == [(20, 1, 21, 64 * 32)]
    assert balltree.top_k(scaled.limit(0), scaled.limit(0)).collect() == []


def test_cluster_sample_is_that_of_the_whole_ranking(spark):
    nodes = spark.range(4000).select(F.xxhash64("id", F.lit("n")).alias("cid"), F.array(F.col("id").cast("double")).alias("v"))
    ranked = nodes.orderBy(F.xxhash64("cid"), "cid").select("cid")
    for most in (300, 1999, 2000, 5000):
        got = [r[0] for r in flat_graph._sample(nodes, 4000, most).select("cid").collect()]
        assert got == [r[0] for r in ranked.limit(most).collect()]
