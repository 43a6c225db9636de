"""Language identification, quality and mixing: results on held-out rows, brute-force raking, awkward rows."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnworks.llm import language, mixing, quality
from tarnworks.llm.scratch import Scratch, read_table

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return read_table(spark, SMALL, "documents")


def test_language_of_documents(spark, documents):
    got = language.identify(documents, Scratch(spark, "t"), [F.col("doc_id"), F.col("lang")], declared="lang", host="source").toPandas()
    assert len(got) == documents.count()
    assert (got["language"] == got["lang"]).mean() > 0.99
    assert got["kept"].mean() > 0.99


def test_text_alone_is_enough(spark, documents):
    languages, logs = language.fit(documents.where("doc_id % 3 <> 0").select(F.col("lang").alias("language"), F.col("text").alias("body"), F.xxhash64("doc_id").alias("order")))
    rest = documents.where("doc_id % 3 = 0").select("lang", language.log_likelihoods(logs)(F.col("text")).alias("l")).collect()
    assert np.mean([languages[int(np.argmax(r["l"]))] == r["lang"] for r in rest if r["l"]]) > 0.98


def test_pages_use_markup_address_and_host(spark):
    pages = read_table(spark, SMALL, "pages").withColumns({
        "text": F.regexp_replace("html", r"<[^>]*>", " "), "declared": F.regexp_extract("html", r'<html lang="(\w+)"', 1),
    })
    got = language.identify(pages, Scratch(spark, "t"), [F.col("page_id"), F.col("declared")], declared="declared", address="url").toPandas()
    named = got[got["declared"] != ""]
    assert (named["language"] == named["declared"]).mean() > 0.9


def test_evidence_decides_short_texts(spark):
    rows = [(i, "the house of the king and the cat", "en", "http://a.example.uk/x") for i in range(30)]
    rows += [(100 + i, "das haus des herrn und die katze", "de", "http://b.example.de/x") for i in range(30)]
    rows += [(200, "zz", "de", "http://b.example.de/y"), (201, "zz", None, "http://b.example.de/y"), (202, "", "de", None),
             (203, None, "de", None), (204, "123 !!", "en", None), (200, "zz", "de", "http://b.example.de/y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, url string").repartition(3)
    got = {r["doc_id"]: r for r in language.identify(df, Scratch(spark, "t"), [F.col("doc_id")], declared="lang", address="url").collect()}
    assert got[0]["language"] == "en" and got[100]["language"] == "de" and got[200]["language"] == "de" and got[201]["language"] == "de"
    assert all(got[i]["language"] == "und" and not got[i]["kept"] for i in (202, 203, 204))
    kept = language.keep(df, declared="lang", address="url", host=None)
    assert kept.columns == df.columns and kept.count() == 63


def test_language_without_declarations_or_rows(spark):
    df = spark.createDataFrame([(1, "abc", None, None)], "doc_id long, text string, lang string, source string")
    assert language.keep(df).count() == 0
    assert language.keep(df.limit(0)).count() == 0


def test_quality_on_held_out_rows(spark, documents):
    labels = read_table(spark, SMALL, "labels")
    got = quality.held_out_scores(documents, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert ((got["score"] >= 0.3) == (got["quality"] == 1)).mean() > 0.93
    assert (got["predicted"] == (got["score"] >= 0.3)).all()


def test_quality_of_awkward_rows(spark):
    docs = [(i, "good words here in a row" if i % 2 else "BAD!! BAD!! BAD!!", 0.5) for i in range(200)]
    docs += [(900, None, 0.1), (901, "", 0.1), (902, " \n", 0.1), (None, "good words", 0.1), (1, "good words here in a row", 0.5), (903, "word " * 20000, 0.2)]
    df = spark.createDataFrame(docs, "doc_id long, text string, score double").repartition(3)
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(200)] + [(900, None, 1), (None, 1, 1)], "doc_id long, quality int, text string")
    got = quality.held_out_scores(df, labels).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["score"] > 0.6 > by[2]["score"] and by[900]["score"] == by[901]["score"] == by[902]["score"]
    kept = quality.keep(df, labels)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} >= {i for i in range(200) if i % 2}
    nothing = quality.held_out_scores(df, labels.limit(0)).select("predicted").distinct().collect()
    assert [r[0] for r in nothing] == [1]
    assert quality.held_out_scores(df.limit(0), labels).collect() == []


def brute_rake(mass, targets, rounds=400):
    weights = {c: m / sum(mass.values()) for c, m in mass.items()}
    for _ in range(rounds):
        for i, target in enumerate(targets):
            now = defaultdict(float)
            for c, w in weights.items():
                now[c[i]] += w
            weights = {c: w * target[c[i]] / now[c[i]] if now[c[i]] else 0.0 for c, w in weights.items()}
    factors = {c: weights[c] / m if m else 0.0 for c, m in mass.items()}
    top = max(factors.values())
    return {c: f / top for c, f in factors.items()}


def test_mixing_against_brute_force(spark, documents):
    got = mixing.query(spark, SMALL).toPandas()
    texts = dict(documents.select("doc_id", "text").collect())
    assert (got["tokens"] == [len(re.findall(r"[^\x20\x09-\x0D]+", texts[k])) for k in got["doc_id"]]).all()
    names = ["source", "lang", "topic"]
    mass = got.groupby(names)["tokens"].sum().to_dict()
    targets = []
    for i, name in enumerate(names):
        own = got.groupby(name)["tokens"].sum() ** mixing.POWERS[name]
        targets.append((own / own.sum()).to_dict())
    want = brute_rake(mass, targets)
    for r in got.itertuples():
        p = want[r.source, r.lang, r.topic]
        assert r.probability == pytest.approx(p, abs=2e-6)
        u = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:8], 16) / 2**32
        assert r.sampled == (u < p) or abs(u - p) < 1e-6
    expected = (got["tokens"] * got["probability"]).groupby(got["source"]).sum()
    assert np.allclose(expected / expected.sum(), [targets[0][s] for s in expected.index], atol=1e-4)


def test_mixing_of_awkward_rows(spark):
    rows = [(1, "a b", None, "en", 5), (1, "a b", None, "en", 5), (2, None, "s", "en", 5), (3, "", "s", None, 5), (None, "c d e", "s", "fr", 5), (4, "w " * 9000, "s", "en", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, probability int").repartition(2)
    kept = mixing.keep(df)
    assert kept.columns == df.columns and kept.count() <= len(rows)
    assert mixing.keep(df.limit(0)).count() == 0
    assert mixing.keep(df.where("doc_id = 3")).count() == 0
    given = mixing.with_probability(df, ["source"], targets={"source": {"s": 1.0, "absent": 3.0}})
    assert {r["__probability"] for r in given.where("source = 's' and doc_id = 4").collect()} == {1.0}
    assert {r["__probability"] for r in given.where("source is null").collect()} == {0.0}
