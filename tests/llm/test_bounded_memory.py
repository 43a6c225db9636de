"""What a scoring task holds at once, and that bounds change no score."""

import numpy as np
import pandas as pd

import corpus_pipeline
from tarnworks.llm import language, packing, quality, simhash

WORDS = [f"w{i}é" for i in range(25_000)]
TEXTS = pd.Series([" ".join(WORDS), " ".join(WORDS[:3] * 2), "", None, " ".join(WORDS[::-1])])


def watch(monkeypatch, module):
    sizes, real = [], module.hashed_ngrams

    def watched(words, *args, **kwargs):
        sizes.append(len(words))
        return real(words, *args, **kwargs)

    monkeypatch.setattr(module, "hashed_ngrams", watched)
    return sizes


def test_quality_hashes_few_words_at_once(spark, monkeypatch):
    weights = np.random.default_rng(1).normal(size=quality.BUCKETS).astype(np.float32)
    want = []
    for text in TEXTS:
        buckets, counts = quality.features(text)
        logit = 0.5 + (counts @ weights[buckets].astype(np.float64) / counts.sum() if len(counts) else 0.0)
        want.append(1 / (1 + np.exp(-logit)))
    sizes = watch(monkeypatch, quality)
    got = np.concatenate(list(quality.scorer(weights, 0.5).func(iter([TEXTS]))))
    assert max(sizes) <= 10_000
    np.testing.assert_allclose(got, want, rtol=1e-9)


def test_language_hashes_few_words_at_once(spark, monkeypatch):
    logs = np.log(np.random.default_rng(1).dirichlet(np.ones(language.BUCKETS), 3)).astype(np.float32)
    want = []
    for text in TEXTS:
        words = language.spoken(text)
        _, bucket = language.trigrams(words)
        want.append(logs[:, bucket].astype(np.float64).sum(axis=1) / len(bucket) * min(len(bucket), language.TEXT_WEIGHT) if words else None)
    sizes = watch(monkeypatch, language)
    got = list(language.log_likelihoods(logs).func(iter([TEXTS])))[0]
    assert max(sizes) <= 10_000
    for a, b in zip(got, want):
        assert (a is None and b is None) or np.allclose(a, b, rtol=1e-9)


def test_pipeline_stages_pass_few_texts_at_once(spark, monkeypatch, sf_dir):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)

    def seen(docs, *args):
        return int(docs.conf.get(setting))

    for module, name in ((language, "keep"), (quality, "keep"), (simhash, "keep"), (packing, "pack")):
        monkeypatch.setattr(module, name, seen)
    try:
        for stage in (corpus_pipeline.identified, corpus_pipeline.good, corpus_pipeline.distinct, corpus_pipeline.packed):
            spark.conf.set(setting, "10000")
            assert stage(spark, spark, sf_dir) <= 1000
    finally:
        spark.conf.set(setting, before)
