"""The whole pipeline, followed stage by stage: what a model decides is taken from it, the rest is done again plainly."""

import hashlib
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tarnworks.llm import language, mixing, quality
from tarnworks.llm.scratch import Scratch, read_table

CLASHES = ["__row", "_row_", "__tokens", "__topic", "__m0", "__score", "_score_", "__drawn"]


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode()
    for gap in b"\t\n\x0b\x0c\r":
        words = words.replace(bytes([gap]), b" ")
    words = [w for w in words.split(b" ") if w]
    pieces = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in pieces]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_distinct(rows):
    """Smallest id of each component of fingerprints at most three bits apart."""
    prints = [(r["doc_id"], plain_fingerprint(r["text"])) for r in rows]
    label = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if label[a] != label[b] and (prints[a][1] ^ prints[b][1]).bit_count() <= 3:
                old, new = label[a], label[b]
                label = [new if x == old else x for x in label]
    least = defaultdict(list)
    for (key, _), root in zip(prints, label):
        least[root].append(key)
    return sorted(min(keys) for keys in least.values())


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    extra = docs.where("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 100_000)  # copies
    awkward = spark.createDataFrame([(200_001, None, "en", "src1", 0), (200_002, "", None, None, None)], docs.schema)
    return docs.unionByName(extra).unionByName(awkward).withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in CLASHES})


def test_stages_follow_each_other(spark, sf_dir, documents):
    def rows(df):
        return sorted(df.collect(), key=lambda r: r["doc_id"])

    scratch = Scratch(spark, "t")
    docs, at = documents, [sorted(documents.columns)]
    expected = {
        "language identification": lambda d: sorted(
            r["doc_id"] for r in language.identify(d, Scratch(spark, "l"), [F.col("doc_id")], declared="lang", host="source").where("kept").collect()),
        "quality classifier": lambda d: sorted(
            r["doc_id"] for r in d.select("doc_id", quality.scorer(*quality.fit(d, read_table(spark, sf_dir, "labels"), key="doc_id", text="text"))("text").alias("s"))
            .where(F.col("s") >= quality.THRESHOLD).collect()),
        "near-duplicate removal": lambda d: plain_distinct(d.collect()),
        "mixing to target weights": lambda d: sorted(
            r["doc_id"] for r in mixing.with_probability(d.select("doc_id", "text", "lang", "source"), ["source", "lang", "topic"]).collect()
            if int(hashlib.md5(str(r["doc_id"]).encode()).hexdigest()[:8], 16) / 2**32 < r["__probability"]),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        want = expected[name](docs)
        after = scratch.stage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        assert sorted(after.columns) == at[0]
        got = rows(after)
        assert [r["doc_id"] for r in got] == want
        assert all(r[c] == f"{c}{r['doc_id']}" for r in got for c in CLASHES)
        assert 0 < len(got) < docs.count()
        docs = after
    packed = corpus_pipeline.packed(spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in docs.collect()}
    room = defaultdict(list)
    for r in packed:
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in room.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:i]) for i in range(len(pieces))] and sum(n for _, n in pieces) <= 2048


def test_run_is_the_stages_in_order(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = Scratch(spark, "t").stage(stage(spark, docs, sf_dir), "s")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]  # places of equal lengths may be dealt either way
    key = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    whole = corpus_pipeline.run(spark, sf_dir)
    assert key(whole) == key(docs) and whole.select("sequence_id").distinct().count() == docs.select("sequence_id").distinct().count()


def test_no_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = Scratch(spark, "t").stage(stage(spark, docs, sf_dir), "s")
        assert docs.count() == 0
