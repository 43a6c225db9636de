"""Fused evidence against a plain version, and the languages that are learnt."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnworks.llm import language
from tarnworks.llm.scratch import Scratch, read_table


def softmax(logs):
    raised = np.exp(logs - logs.max())
    return raised / raised.sum()


def smoothed(counts, parent):
    return (counts + language.HOST_WEIGHT * parent) / (counts.sum() + language.HOST_WEIGHT)


def plain(rows, languages, logs):
    """Posterior of each (text, claim, host), every level of evidence done again; None without letters."""
    k, own = len(languages), []

    def claimed(claim, trust):
        if claim not in languages:
            return np.zeros(k)
        return np.array([np.log(trust) if x == claim else np.log((1 - trust) / (k - 1)) for x in languages])

    def levels(host):
        dotted = host is not None and "." in host
        return (".".join(host.split(".")[-2:]), host.split(".")[-1]) if dotted else (None, None)

    for text, claim, host in rows:
        words = language.spoken(text)
        if not words:
            own.append(None)
            continue
        _, bucket = language.trigrams(words)
        suffix = levels(host)[1]
        own.append(logs[:, bucket].sum(axis=1) / len(bucket) * min(len(bucket), language.TEXT_WEIGHT)
                   + claimed(claim, language.DECLARED_TRUST) + claimed(language.SUFFIX_LANGUAGES.get(suffix, suffix), language.SUFFIX_TRUST))
    sums = [defaultdict(lambda: np.zeros(k)) for _ in range(4)]
    for (_, _, host), logs_of in zip(rows, own):
        if logs_of is not None:
            for level, name in zip(sums, (None, levels(host)[1], levels(host)[0], host)):
                level[name] += softmax(logs_of)
    prior = (sums[0][None] + 1) / (sums[0][None] + 1).sum()
    out = []
    for (_, _, host), logs_of in zip(rows, own):
        domain, suffix = levels(host)
        above = smoothed(sums[2][domain], smoothed(sums[1][suffix], prior)) if domain else prior
        share = smoothed(sums[3][host], above) if host is not None else prior
        out.append(None if logs_of is None else softmax(logs_of + np.log(np.maximum(share, 1e-9))))
    return out


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    both = language.documents_and_pages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "pages"))
    short = [("documents", 10_000 + i, None, t, d, h) for i, (t, d, h) in enumerate([
        ("zz", "de", "b.example.de"), ("zz", None, "b.example.de"), ("zz", "xx", "c.example.mx"), ("zz", "fr", "example.fr"), ("zz", None, None),
        ("", "de", "b.example.de"), (None, "de", "b.example.de"), ("123 !!", "en", None), ("zz", "EN-gb", "lone"), ("zz", "not a tag", "src1"),
    ])]
    return both.unionByName(spark.createDataFrame(short, both.schema))


def test_posteriors_equal_a_plain_version(spark, rows):
    digest = language.row_digest(rows)
    tagged = rows.withColumn("claim", language.tag_of(F.col("declared")))
    languages, logs = language.fit(tagged.select(F.col("claim").alias("language"), F.col("text").alias("body"), digest.alias("order")))
    keys = [F.col(c) for c in ("table_name", "doc_id", "page_id")]
    got = {tuple(r)[:3]: r for r in language.identify(rows, Scratch(spark, "t"), keys, declared="declared", host="host").collect()}
    told = tagged.select("table_name", "doc_id", "page_id", "text", "claim", F.lower("host").alias("host")).collect()
    want = plain([tuple(r)[3:] for r in told], languages, logs)
    assert len(got) == len(told)
    assert {r["host"].split(".")[-1] for r in told if r["host"] and "." in r["host"]} >= {"com", "net", "org", "de"}
    for r, posterior in zip(told, want):
        row = got[tuple(r)[:3]]
        if posterior is None:
            assert (row["language"], row["confidence"], row["kept"]) == ("und", 0.0, False)
            continue
        assert row["confidence"] == pytest.approx(posterior.max(), abs=1e-4)
        if abs(posterior.max() - language.CONFIDENCE) > 1e-3:
            assert row["language"] == (languages[int(posterior.argmax())] if posterior.max() >= language.CONFIDENCE else "und")


def test_query_judges_every_document_and_page(spark, sf_dir):
    got = language.query(spark, sf_dir)
    assert got.where("table_name = 'documents'").select("doc_id").distinct().count() == read_table(spark, sf_dir, "documents").count()
    assert got.where("table_name = 'pages'").select("page_id").distinct().count() == read_table(spark, sf_dir, "pages").count()
    assert got.where("(doc_id is null) = (page_id is null)").count() == 0
    assert got.where("table_name = 'pages' and not kept").count() == 0


def test_markup(spark):
    html = [
        '<!DOCTYPE html><HTML class="a" LANG=en-GB><style>p{}</style><script>var t="</p>";</script><p>one&amp;two<!-- <b>no</b> --></p>',
        "<html><body lang='de'>kein", "plain text", "", None,
    ]
    df = spark.createDataFrame([(h,) for h in html], "html string")
    got = df.select(language.markup_language(F.col("html")).alias("l"), language.tag_of(language.markup_language(F.col("html"))).alias("t"),
                    F.trim(F.regexp_replace(language.visible(F.col("html")), r"\s+", " ")).alias("v")).collect()
    assert [tuple(r) for r in got] == [("en-GB", "en", "one two"), (None, None, "kein"), (None, None, "plain text"), (None, None, ""), (None, None, None)]


def test_many_declared_languages_stay_bounded(spark):
    rows = [(i, "the house of the king", "en") for i in range(1500)] + [(2000 + i, "das haus des herrn", f"x{chr(97 + i // 26)}{chr(97 + i % 26)}") for i in range(600)]
    rows += [(4000 + i, "das haus", f"dirty value {i}") for i in range(50)] + [(5000 + i, "das haus des herrn", "de") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    claim = language.tag_of(F.col("lang"))
    languages, logs = language.fit(df.select(claim.alias("language"), F.col("text").alias("body"), F.xxhash64("doc_id").alias("order")))
    assert languages == ["de", "en"] and logs.shape[0] == 2
    assert language.identify(df, Scratch(spark, "t"), [F.col("doc_id")], declared="lang").count() == len(rows)
