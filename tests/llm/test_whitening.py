"""Whitening against plain numpy over all rows, with the awkward rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnworks.llm import whitening
from tarnworks.llm.columns import free_name
from tarnworks.llm.spread_join import spread_join

SCHEMA = "vec_id long, embedding array<double>, x string, members int, salt long, z string"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, "x", 9, 4, "z") for k, v in rows], SCHEMA).repartition(5)


def numbers(rows):
    good = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [k for k, _ in good], np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in good])


def check(rows, got, components, free=0):
    keys, x = numbers(rows)
    n, s = len(x), x.sum(axis=0)
    c = x - s / n
    covariance = c.T @ c / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert len(got) == n * components and sorted(r.vec_id for r in got) == sorted(np.repeat(keys, components).tolist())
    deviation = dict(zip(keys, ((n * x - s) ** 2).sum(axis=1).tolist()))
    assert all(r.n == n and r.deviation == deviation[r.vec_id] for r in got)
    for k in range(components - free):
        own = {r.vec_id: r.whitened for r in got if r.component == k + 1}
        want = c @ vectors[:, k] / np.sqrt(values[k])
        mine = np.array([own[key] for key in keys])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8
        shares = {r.explained for r in got if r.component == k + 1}
        assert len(shares) == 1 and abs(shares.pop() - values[k] / np.trace(covariance)) < 1e-12
    assert all(r.whitened is None for r in got if r.component > components - free)
    (error,) = {r.identity_error for r in got}
    assert error < 1e-9


def test_matches_numpy_with_copies_and_unusable_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=12).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(150)] + [(1, rows[1][1]), (1, rows[2][1])]
    rows += [(-5, None), (-6, [math.nan] + [0.0] * 11), (-7, [math.inf] * 12), (-8, [None] + [1.0] * 11)]
    distinct = [(i, v) for i, (_, v) in enumerate(rows)]  # ids of their own, so that rows can be told apart
    check(distinct, whitening.whiten(frame(spark, distinct)).collect(), 8)


def test_repeated_ids_and_null_ids_keep_their_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(None if i % 10 == 0 else i % 7, rng.normal(size=3).tolist()) for i in range(60)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert len(got) == 180 and sum(r.vec_id is None for r in got) == 18
    assert {r.component for r in got} == {1, 2, 3}


def test_component_without_variance_is_null(spark):
    rng = np.random.default_rng(7)
    rows = [(i, [*rng.normal(size=2).tolist(), 0.25]) for i in range(40)]
    check(rows, whitening.whiten(frame(spark, rows)).collect(), 3, free=1)


def test_one_vector_only(spark):
    got = whitening.whiten(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect()
    assert [(r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(0, None, None, None)] * 4


def test_no_rows(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    empty = whitening.whiten(frame(spark, [(1, None), (2, [])]))
    assert empty.collect() == [] and empty.columns[0] == "vec_id"


def test_unequal_lengths_and_huge_entries_raise(spark):
    with pytest.raises(ValueError, match="1 to 2 entries"):
        whitening.whiten(frame(spark, [(1, [0.5]), (2, [0.5, 1.0])]))
    with pytest.raises(ValueError, match="too large"):
        whitening.whiten(frame(spark, [(1, [1e300]), (2, [0.5])]))


def test_deviations_beyond_64_bits():
    x = np.array([[2**40, 0], [0, 2**40]])
    wide = whitening._deviations(x, 2**25, [2**64, 2**64])
    assert wide.dtype == object and wide[0, 0] == 2**65 - 2**64
    assert whitening._squares(wide) == [None, None]
    assert whitening._squares(np.array([[3_037_000_499, 0], [3_037_000_499, 3_037_000_499]])) == [3_037_000_499**2, None]


def test_heavy_classes_are_dealt_over_parts(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") < 2000, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    classes = rows.groupBy("k").agg(F.count("*").alias("members")).withColumn("salt", F.lit("mine"))
    got = spread_join(rows, classes, "k", "members", "id")
    assert got.count() == 3000 and got.columns == ["k", "id", "members", "salt"]
    assert got.where("k = 'hot'").agg(F.min("members"), F.count_distinct("id")).first()[:] == (2000, 2000)
    outer = spread_join(rows, classes.where("k = 'hot'"), "k", "members", "id", "left")
    assert outer.count() == 3000 and outer.where("members is null").count() == 1000


def test_free_names():
    assert free_name("salt", ["a"], ["_SALT_", "__salt__"]) == "___salt___"
