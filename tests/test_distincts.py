"""Distinct counts that add up, and the quality profile that rests on them."""

import random
from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from tarnworks.operators import distincts, quality
from tarnworks.plans import batch_queries
from tarnworks.session import pin_session

SHAPE = "_source string, month date, id bigint, region string, amount double"


def landing(spark, seed=3, n=4000):
    rng = random.Random(seed)
    edges = [0, -1, 1, 32_767, 32_768, 32_769, -32_768, -32_769, 2**31, 2**62, -(2**62), None]
    rows = [
        (rng.choice(["a", "b", None]), date(2024, rng.choice([1, 2, 3, 4, 12]), 1), rng.choice([rng.randrange(-500, 90_000), rng.choice(edges)]),
         rng.choice(["r", None]), rng.choice([5.0, None, -1.0, 2000.0, float("nan")]))
        for _ in range(n)
    ]
    return rows, spark.createDataFrame(rows, SHAPE).repartition(5)


def test_bitmaps_answer_coarser_groups_exactly(spark):
    rows, df = landing(spark)
    bitmaps = distincts.id_bitmaps(df, ["_source", "month"], "id")
    for groups, key in (
        (["_source", "month"], lambda r: (r[0], r[1])), (["_source"], lambda r: (r[0],)), ([], lambda r: ()),
        ([F.trunc("month", "quarter").alias("q")], lambda r: (date(2024, (r[1].month - 1) // 3 * 3 + 1, 1),)),
    ):
        want = defaultdict(set)
        for r in rows:
            want[key(r)] |= {r[2]} - {None}
        got = {tuple(r)[:-1]: r["ids_cnt"] for r in distincts.distinct_ids(bitmaps, groups).collect()}
        assert got == {k: len(v) for k, v in want.items()}


def test_bitmaps_of_months_can_be_kept_and_united_with_later_ones(spark):
    _, first = landing(spark, 4, 500)
    _, second = landing(spark, 5, 500)
    apart = distincts.id_bitmaps(first, ["_source"], "id").unionByName(distincts.id_bitmaps(second, ["_source"], "id"))
    whole = distincts.id_bitmaps(first.unionByName(second), ["_source"], "id")
    assert sorted(distincts.distinct_ids(apart, ["_source"]).collect(), key=str) == sorted(distincts.distinct_ids(whole, ["_source"]).collect(), key=str)


def test_rows_meet_by_bucket(spark):
    rows = spark.range(0, 200_000, 1, 4).withColumn("g", F.lit(1))
    assert distincts.id_bitmaps(rows, ["g"], "id").count() == 8  # a row for each 32,768 ids


def test_estimates_are_near(spark):
    rows = spark.range(60_000).selectExpr("id % 3 AS g", "id % 7 AS m", "xxhash64(id % 40000) AS id")
    exact = {r["g"]: r["n"] for r in rows.groupBy("g").agg(F.count_distinct("id").alias("n")).collect()}
    sketches = distincts.id_sketches(rows, ["g", "m"], "id")
    for r in distincts.estimated_ids(sketches, ["g"]).collect():
        assert abs(r["ids_cnt"] - exact[r["g"]]) <= 0.02 * exact[r["g"]]
    assert sketches.count() == 21


@pytest.mark.parametrize("sequence", [True, False])
def test_profile_counts(spark, sequence):
    rows, df = landing(spark)
    want = {}
    for key in {r[:2] for r in rows}:
        own = [r for r in rows if r[:2] == key]
        want[key] = (
            len(own), sum(r[2] is None for r in own), sum(r[3] is None for r in own), sum(r[4] is None for r in own),
            len(own) - len({r[2] for r in own} - {None}),
            sum(r[4] is not None and (r[4] != r[4] or r[4] <= 0 or r[4] > 1000) for r in own),  # NaN is above all numbers
        )
    got = quality.profile(df, F.lit("2025-01-01").cast("timestamp"), ids_are_sequence=sequence).drop("checked_at").collect()
    assert {tuple(r)[:2]: tuple(r)[2:] for r in got} == want


def test_nothing_to_count(spark):
    empty = landing(spark, 1, 1)[1].limit(0)
    assert quality.profile(empty).collect() == []
    assert distincts.distinct_ids(distincts.id_bitmaps(empty, ["_source"], "id"), ["_source"]).collect() == []
    nulls = spark.createDataFrame([("a", None), ("a", None)], "g string, id bigint")
    assert distincts.distinct_ids(distincts.id_bitmaps(nulls, ["g"], "id"), ["g"]).first()["ids_cnt"] == 0


def test_the_exact_number_of_a_year_needs_no_bitmaps_of_months(spark, sf_dir, monkeypatch):
    seen, id_bitmaps = [], distincts.id_bitmaps
    monkeypatch.setattr(distincts, "id_bitmaps", lambda rows, groups, *more: seen.append(groups) or id_bitmaps(rows, groups, *more))
    got = batch_queries.approx_distinct_ids(pin_session(spark), sf_dir).collect()
    assert seen == [["_source", "year"]] and got and all(row["within_2_percent"] for row in got)


def test_tasks_read_little_enough_to_hold_their_rows(spark):
    conf = pin_session(spark)._jsparkSession.sessionState().conf()
    assert conf.filesMaxPartitionBytes() <= 32 << 20
    assert int(conf.getConfString("spark.sql.adaptive.advisoryPartitionSizeInBytes")[:-1]) <= 16
