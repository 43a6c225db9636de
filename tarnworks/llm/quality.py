"""Quality classifier with supervised subword embeddings.

A text's features are its words, their character n-grams, and a mark for each word that repeats the one before
it (all word pairs of that kind share a bucket of its own), hashed into buckets. Each bucket has a learnt
vector; the vectors of all features are averaged into the document's, and a softmax over it gives the classes.
Both are trained together by stochastic gradient descent in numpy.

Labels come from a bounded sample of the labelled rows outside the held-out fold: the ``SAMPLE_ROWS`` rows whose
keys have the smallest hashes. Only the sample is bounded; every whole text is scored. Because
the average is linear, a trained model folds into one number a bucket, and a word met before costs a look-up.

Defined cases: NULL, empty and blank texts have no features and score the bias alone; repeated rows score
alike; labels that are NULL teach nothing; without labels of both classes every score is the share of label 1
(1.0 without any); an empty table gives an empty result; only key and text are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.llm.columns import free_name
from tarnworks.llm.scratch import read_table
from tarnworks.llm.subwords import hashed_ngrams

BUCKETS = 1 << 17
DIMENSIONS = 16
GRAMS = (2, 3, 4)
SAMPLE_ROWS = 6000
EPOCHS = 8
LEARNING_RATE = 0.5
FOLD, FOLDS = 0, 5
THRESHOLD = 0.3
KNOWN_WORDS = 600_000
TEXTS_AT_ONCE = 500
WORDS_AT_ONCE = 10_000  # whose n-grams are held at once, some 600 bytes a word
REPEAT_BUCKET = 0  # words hash to the others
REPEAT_WEIGHT = 16


def buckets_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of the words and their character n-grams."""
    owner, bucket = hashed_ngrams(words, GRAMS, BUCKETS - 1, whole=True)
    return owner, bucket + 1


def repeats(words: list[str]) -> int:
    """Weight of the repetition mark: a repeated word counts as much as a usual word's n-grams do."""
    return REPEAT_WEIGHT * sum(map(str.__eq__, words, words[1:]))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text with their counts."""
    words = (text or "").split()
    times = Counter(words)
    owner, bucket = buckets_of(list(times))
    weights = np.bincount(bucket, weights=np.fromiter(times.values(), np.int64, len(times))[owner], minlength=BUCKETS)
    weights[REPEAT_BUCKET] = repeats(words)
    used = np.flatnonzero(weights)
    return used.astype(np.int32), weights[used].astype(np.int32)


def shares_of(counts: np.ndarray) -> np.ndarray:
    return (counts / counts.sum()).astype(np.float32) if len(counts) else np.zeros(0, np.float32)


def train(documents: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 1) -> tuple[np.ndarray, float]:
    """Gradient descent over (buckets, their shares, label); returns each bucket's share of the logit, and the bias."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS, 2), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    steps, done = EPOCHS * len(documents), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(documents)):
            buckets, share, label = documents[i]
            rate = np.float32(LEARNING_RATE * (1 - done / steps))
            done += 1
            hidden = share @ vectors[buckets]
            logits = hidden @ output + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[label] -= 1
            back = output @ error
            output -= rate * np.outer(hidden, error)
            bias -= np.float32(0.1) * rate * error
            # rescaled by the feature count, as each feature is met that often in a text
            vectors[buckets] -= (rate * np.float32(len(buckets)) ** np.float32(0.5)) * np.outer(share, back)
    return (vectors @ (output[:, 1] - output[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def sampled_labels(documents: DataFrame, labels: DataFrame, label: str, key: str, text: str) -> DataFrame:
    """(label, body) of the sample; labels of the held-out fold are never looked at."""
    learnable = labels.where(
        F.col(label).isNotNull() & (F.pmod(F.crc32(F.col(key).cast("string")), F.lit(FOLDS)) != FOLD)
    ).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).distinct()
    chosen = learnable.orderBy(F.xxhash64("_key"), "_key", "_label").limit(SAMPLE_ROWS)
    bodies = documents.select(F.col(key).alias("_key"), F.col(text).alias("body"))
    return bodies.join(F.broadcast(chosen), "_key")  # SAMPLE_ROWS rows at most


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text") -> tuple[np.ndarray, float]:
    """The folded model, trained in one task over the bounded sample's features."""

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), TEXTS_AT_ONCE):
                part = batch.iloc[start : start + TEXTS_AT_ONCE]
                made = [features(t) for t in part["body"]]
                yield pd.DataFrame({
                    "_key": part["_key"].astype(str).tolist(), "_label": part["_label"].tolist(),
                    "buckets": [m[0] for m in made], "counts": [m[1] for m in made],
                })

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_key", "_label"])
        classes = set(rows["_label"])
        if not {0, 1} <= classes:
            share = float((rows["_label"] == 1).mean()) if len(rows) else 1.0
            weights, bias = np.zeros(BUCKETS, np.float32), float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
        else:
            rows = rows[rows["_label"].isin((0, 1))]
            weights, bias = train([
                (np.asarray(b, dtype=np.int32), shares_of(np.asarray(c)), int(y))
                for b, c, y in zip(rows["buckets"], rows["counts"], rows["_label"])
            ])
        return pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias]})

    sample = sampled_labels(documents, labels, label, key, text)
    made = sample.mapInPandas(featurise, "_key string, _label int, buckets array<int>, counts array<int>")
    row = made.groupBy().applyInPandas(learn, "weights binary, bias double").first()
    if row is None:
        return np.zeros(BUCKETS, np.float32), 14.0
    return np.frombuffer(row["weights"], dtype=np.float32), row["bias"]


def scorer(weights: np.ndarray, bias: float):
    """A column function: text to the probability of label 1."""
    sent = weights.tobytes()

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = np.frombuffer(sent, dtype=np.float32).astype(np.float64)
        known: dict[str, tuple[float, int]] = {}
        for texts in batches:
            out = np.empty(len(texts))
            for start in range(0, len(texts), TEXTS_AT_ONCE):  # words of so many texts are held at once
                group = [(text or "").split() for text in texts.iloc[start : start + TEXTS_AT_ONCE]]
                if len(known) > KNOWN_WORDS:
                    known.clear()
                new = list(set().union(*group).difference(known))
                for begin in range(0, len(new), WORDS_AT_ONCE):
                    part = new[begin : begin + WORDS_AT_ONCE]
                    owner, bucket = buckets_of(part)
                    values = np.bincount(owner, weights=table[bucket], minlength=len(part))
                    known.update(zip(part, zip(values.tolist(), np.bincount(owner, minlength=len(part)).tolist())))
                for i, words in enumerate(group, start=start):
                    n = repeats(words)
                    total = n * float(table[REPEAT_BUCKET])
                    for value, count in map(known.__getitem__, words):
                        total += value
                        n += count
                    out[i] = bias + (total / n if n else 0.0)
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -500, 500))))

    return score


def held_out_scores(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) for every row."""
    score = scorer(*fit(documents, labels, key=key, text=text))
    held = F.coalesce(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(FOLDS)) == FOLD, F.lit(False))
    return documents.select(F.col(key), held.alias("held_out"), score(F.col(text)).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def keep(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose score reaches the threshold, columns unchanged."""
    score = scorer(*fit(documents, labels, key=key, text=text))
    own = free_name("score", documents.columns)
    return documents.withColumn(own, score(F.col(text))).where(F.col(own) >= THRESHOLD).select(*documents.columns)


def query(spark, sf_dir: str) -> DataFrame:
    return held_out_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
