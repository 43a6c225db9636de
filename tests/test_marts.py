from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tarnworks.operators import distribution, marts, reconcile

CORE = "sale_month date, _source string, region string, product string, amount decimal(12,2), is_valid boolean"
M = date(2024, 1, 1)


def core(spark, rows):
    return spark.createDataFrame([(M, s, r, p, Decimal(a), v) for s, r, p, a, v in rows], CORE)


def test_only_true_flags_count(spark):
    df = core(spark, [("a", "r", "p", "1.00", True), ("a", "r", "p", "2.00", False), ("a", "r", "p", "4.00", None)])
    row = marts.by_region_product_monthly(df).first()
    assert (row["orders_cnt"], row["total_amount"], row["avg_amount"]) == (1, Decimal("1.00"), Decimal("1.00"))


def test_average_rounds_half_up(spark):
    df = core(spark, [("a", "r", "p", "0.01", True), ("a", "r", "p", "0.02", True)])
    assert marts.by_region_product_monthly(df).first()["avg_amount"] == Decimal("0.02")


def test_monthly_distinct_counts_skip_null(spark):
    df = core(spark, [("a", "r1", "p1", "1.00", True), ("a", None, "p1", "2.00", True), ("a", "r1", "p2", "3.00", True)])
    row = marts.monthly(df).first()
    assert (row["orders_cnt"], row["total_amount"]) == (3, Decimal("6.00"))
    assert (row["regions_cnt"], row["products_cnt"]) == (1, 2)


def test_monthly_from_rollup_is_the_same(spark):
    df = core(spark, [("a", "r1", "p1", "1.00", True), ("a", None, "p1", "2.00", True), ("b", "r1", "p2", "3.00", True)])
    direct = sorted(map(tuple, marts.monthly(df).collect()))
    rolled = sorted(map(tuple, marts.monthly_from_rollup(marts.by_region_product_monthly(df)).collect()))
    assert direct == rolled


def test_weekend(spark):
    days = [date(2024, 1, 5), date(2024, 1, 6), date(2024, 1, 7), date(2024, 1, 8)]  # Fri Sat Sun Mon
    df = spark.createDataFrame([(d, Decimal("1.00")) for d in days], "sale_date date, amount decimal(12,2)")
    assert {r["is_weekend"]: r["rows_cnt"] for r in marts.weekday_split(df).collect()} == {True: 2, False: 2}


def one(spark, value):
    return spark.createDataFrame([(Decimal(value),)], "v decimal(18,2)") if value else spark.createDataFrame(
        [], "v decimal(18,2)")


def test_checks(spark):
    rows = reconcile.run_checks([
        reconcile.Check("same", one(spark, "5.00"), one(spark, "5.00")),
        reconcile.Check("off_by_a_cent", one(spark, "5.00"), one(spark, "5.01")),
        reconcile.Check("less", one(spark, "4.00"), one(spark, "5.00"), "at_most"),
        reconcile.Check("within", one(spark, "5.01"), one(spark, "5.00"), "at_most"),
        reconcile.Check("more", one(spark, "5.02"), one(spark, "5.00"), "at_most"),
        reconcile.Check("nothing_is_zero", one(spark, None), one(spark, "0.00")),
    ])
    got = {r["check_name"]: r["ok"] for r in rows.collect()}
    assert got == {"same": True, "off_by_a_cent": False, "less": True, "within": True, "more": False,
                   "nothing_is_zero": True}


def test_require_raises_with_the_values(spark):
    import pytest

    failing = reconcile.run_checks([reconcile.Check("sums", one(spark, "1.00"), one(spark, "2.00"))])
    with pytest.raises(AssertionError, match="sums: 1.00 vs 2.00"):
        reconcile.require(failing)


def test_segments(spark):
    df = spark.createDataFrame([(0,), (4,), (1,), (-1,), (None,)], "id bigint")
    assert {r["segment"]: r["rows_cnt"] for r in distribution.segment_counts(df, 4).collect()} == {0: 3, 1: 1, 3: 1}


def test_generated_rows(spark):
    from tarnworks.functions.fixed_values import PRODUCTS, SALES_REGIONS
    from tarnworks.sources import generators

    rows = generators.seed_sales(generators.series(spark, 720)).collect()
    assert {r["id"] for r in rows} == set(range(1, 721))
    assert min(r["sale_date"] for r in rows) == date(2025, 1, 1) and max(r["sale_date"] for r in rows) == date(2025, 6, 29)
    pairs = {(r["region"], r["product"]) for r in rows}
    assert pairs == set(zip(SALES_REGIONS, PRODUCTS))
    assert all(Decimal("0.00") <= r["amount"] <= Decimal("1000.00") for r in rows)


def test_generated_events(spark):
    from tarnworks.sources import generators

    base = F.lit("2025-01-01 00:00:00").cast("timestamp")
    rows = generators.seed_events(generators.series(spark, 400), base).orderBy("id").collect()
    assert (rows[0]["id"], rows[0]["ts"].second, rows[59]["ts"].minute) == (1, 1, 1)
    assert len({r["region"] for r in rows}) == 4 and len({r["product"] for r in rows}) == 4
    assert all(1 <= r["amount"] <= 1000 for r in rows)
