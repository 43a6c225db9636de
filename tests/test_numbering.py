import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tarnworks.operators.numbering import number_within, rank_rows


def sample(n, seed, hot_share=0.4):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        key = None if rng.random() < hot_share else rng.randrange(20)
        rows.append((key, rng.choice([None, *range(6)]), rng.choice("ab")))
    return rows


def expected(rows, descending):
    """Brute force: ranks per key; copies of a row may swap, so compare as multisets."""
    groups = defaultdict(list)
    for key, a, b in rows:
        groups[key].append((a, b))
    result = []
    for key, items in groups.items():
        def place(item):
            a, b = item
            return ((a is None, -(a or 0)) if descending else (a is not None, a or 0), b)

        for rank, (a, b) in enumerate(sorted(items, key=place), 1):
            result.append((key, a, b, rank))
    return sorted(map(repr, result))


@pytest.mark.parametrize("parts", [1, 5, 300])
def test_rank_rows_splits_large_groups_exactly(spark, parts):
    rows = sample(600, 7)
    df = spark.createDataFrame(rows, "k int, a int, b string").repartition(parts)
    ranked = rank_rows(df, ["k"], [F.col("a").desc_nulls_last(), F.col("b").asc()])
    assert sorted(repr(tuple(r)) for r in ranked.select("k", "a", "b", "rn").collect()) == expected(rows, True)


def test_number_within_spreads_copies(spark):
    """One key of identical rows: numbers stay dense although no order separates the rows."""
    df = spark.range(500).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    numbered = number_within(df, ["k"], [F.col("v").asc()], "n", chunks=4)
    assert sorted(r["n"] for r in numbered.collect()) == list(range(1, 501))


def test_number_within_follows_a_unique_order(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id").repartition(7)
    numbered = number_within(df, ["k"], [F.col("id").asc()], "n", chunks=5, order_is_unique=True)
    assert all(r["n"] == r["id"] // 3 + 1 for r in numbered.collect())
