from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tarnworks.operators import conform, quality
from tarnworks.schemas import LANDING_EVENTS, LANDING_SALES

LOADED = datetime(2025, 1, 1)
TS = datetime(2024, 3, 31, 23, 59, 59)

# id, raw amount, amount in core, is_valid in core, out of range in quality
EDGES = [
    (1, 1000.0, "1000.00", True, 0),
    (2, 1000.004, "1000.00", True, 1),
    (3, 0.004, "0.00", False, 0),
    (4, 0.0, "0.00", False, 1),
    (5, -1.0, "-1.00", False, 1),
    (6, None, None, None, 0),
    (None, 5.0, "5.00", False, 0),
    (7, float("nan"), None, None, 1),
    (8, 1e12, None, None, 1),
]


def events(spark, rows):
    """rows of (id, ts, region, product, amount, offset, loaded_at)"""
    data = [(i, ts, r, p, a, 0, o, loaded, "kafka") for i, ts, r, p, a, o, loaded in rows]
    return spark.createDataFrame(data, LANDING_EVENTS)


def no_sales(spark):
    return spark.createDataFrame([], LANDING_SALES)


def core_of(spark, landing_events, landing_sales=None):
    sales = no_sales(spark) if landing_sales is None else landing_sales
    return conform.build_core(conform.unify(sales, landing_events))


@pytest.fixture(scope="module")
def edge_landing(spark):
    return events(spark, [(e[0], TS, "North", "widget", e[1], i, LOADED) for i, e in enumerate(EDGES)])


def test_core_edge_rows(spark, edge_landing):
    got = {row["id"]: (row["amount"], row["is_valid"]) for row in core_of(spark, edge_landing).collect()}
    want = {e[0]: (None if e[2] is None else Decimal(e[2]), e[3]) for e in EDGES}
    assert got == want


def test_quality_edge_rows(spark, edge_landing):
    landing = conform.landing_union(no_sales(spark), edge_landing)
    for id_, _, _, _, out in EDGES:
        only = landing.where(F.col("id").eqNullSafe(F.lit(id_)))
        assert quality.profile(only).first()["amount_out_of_range_cnt"] == out, id_


def test_quality_counts_null_ids_as_duplicates(spark):
    rows = [(1, TS, None, "p", 1.0, 0, LOADED), (1, TS, "a", "p", None, 1, LOADED),
            (None, TS, "a", "p", 1.0, 2, LOADED), (None, TS, "a", "p", 2000.0, 3, LOADED)]
    got = quality.profile(conform.landing_union(no_sales(spark), events(spark, rows))).first()
    assert (got["rows_cnt"], got["null_id_cnt"], got["null_region_cnt"], got["null_amount_cnt"]) == (4, 2, 1, 1)
    assert got["dup_id_cnt"] == 3  # four rows, one known id
    assert got["amount_out_of_range_cnt"] == 1


def test_core_columns_and_values(spark):
    row = core_of(spark, events(spark, [(1, TS, "NoRTH", "widget", 9.995, 0, LOADED)])).first()
    assert list(row.asDict()) == conform.CORE_COLUMNS
    assert row["region"] == "north" and row["sale_date"] == date(2024, 3, 31)
    assert row["sale_month"] == date(2024, 3, 1) and row["amount"] == Decimal("10.00")


def test_core_types(spark):
    types = dict(core_of(spark, events(spark, [])).dtypes)
    assert types["id"] == "bigint" and types["amount"] == "decimal(12,2)" and types["sale_month"] == "date"


def test_null_ids_collapse_to_one_row_per_source(spark):
    sale = (None, date(2024, 1, 1), "EMEA", "widget", Decimal("1.00"), LOADED, "greenplum")
    sales = spark.createDataFrame([sale, sale], LANDING_SALES)
    stream = events(spark, [(None, TS, "a", "p", 1.0, i, LOADED) for i in range(3)])
    got = sorted(row["_source"] for row in core_of(spark, stream, sales).collect())
    assert got == ["greenplum", "kafka"]


@pytest.mark.parametrize("first, second, winner", [
    ((TS, 5, datetime(2025, 1, 2)), (TS, 9, LOADED), 1),  # later load wins over later offset
    ((datetime(2024, 1, 1), 9, LOADED), (datetime(2024, 1, 2), 5, LOADED), 2),  # then the later event
    ((TS, 5, LOADED), (TS, 9, LOADED), 2),  # then the later offset
    ((None, 9, LOADED), (TS, 5, LOADED), 2),  # a known time beats an unknown one
])
def test_survivor(spark, first, second, winner):
    rows = [(1, ts, "r", f"p{n}", 1.0, offset, loaded) for n, (ts, offset, loaded) in ((1, first), (2, second))]
    assert core_of(spark, events(spark, rows)).first()["product"] == f"p{winner}"


def test_same_id_of_two_sources_stays_apart(spark):
    sales = spark.createDataFrame(
        [(1, date(2024, 1, 1), "EMEA", "widget", Decimal("1.00"), LOADED, "greenplum")], LANDING_SALES)
    assert core_of(spark, events(spark, [(1, TS, "a", "p", 1.0, 0, LOADED)]), sales).count() == 2


def test_groups_are_trimmed_before_the_shuffle(spark, sf_dir):
    from tarnworks.plans.batch_queries import core

    plan = core(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    partial = plan.rindex("WindowGroupLimit")
    assert "Partial" in plan[partial:plan.index("\n", partial)]
    assert plan.index("Exchange hashpartitioning(id") < partial


def test_lineage_defaults_to_now(spark):
    row = conform.with_lineage(spark.range(1), "kafka").first()
    assert row["_source"] == "kafka" and abs((datetime.now() - row["_loaded_at"]).total_seconds()) < 86_400
