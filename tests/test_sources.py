from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import compare
from tarnworks.plans import operational_db
from tarnworks.plans.catalogue import all_queries
from tarnworks.plans.oracles import ORACLES
from tarnworks.schemas import SALES
from tarnworks.sources import files, jdbc
from tarnworks.workspace import shared_root, stage


@pytest.fixture(scope="module")
def source(spark):
    source = operational_db.embedded_source(spark)
    rows = [(i if i % 5 else None, date(2025, 1, 1), "EMEA", "widget", Decimal("1.25")) for i in range(100)]
    df = spark.createDataFrame(rows, SALES)
    jdbc.write_table(df.toDF(*[c.upper() for c in df.columns]), source, "sales", operational_db.SALES_TYPES)
    return source


def test_ranges_cover_every_row(spark, source):
    df = jdbc.read_table(spark, source, "sales", partition_column="id", partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 100
    assert df.where("id IS NULL").count() == 20


def test_predicates_split_the_read(spark, source):
    df = jdbc.read_table(spark, source, "sales", predicates=["id < 50", "id >= 50", "id IS NULL"])
    assert df.rdd.getNumPartitions() == 3 and df.count() == 100


def test_filter_reaches_the_database(spark, source):
    plan = jdbc.read_table(spark, source, "sales").where("ID = 7").select("AMOUNT")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(ID), *EqualTo(ID,7)]" in text and "ReadSchema: struct<AMOUNT" in text


def test_aggregate_runs_in_the_database(spark, source):
    row = jdbc.read_query(spark, source, "SELECT region, COUNT(*) AS n, SUM(amount) AS t FROM sales GROUP BY region").first()
    assert tuple(row) == ("EMEA", 100, Decimal("125.00"))


def test_empty_table_is_read(spark, source):
    empty = spark.createDataFrame([], SALES)
    jdbc.write_table(empty.toDF(*[c.upper() for c in empty.columns]), source, "nothing", operational_db.SALES_TYPES)
    assert jdbc.read_table(spark, source, "nothing", partition_column="id", partitions=4).count() == 0


def connect(data):
    """The tables in ``data``, each a folder of Parquet files, for SQL."""
    con = duckdb.connect()
    for name in ("lineitem", "part", "supplier", "nation", "region"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data.removeprefix('file:')}/{name}.parquet/*.parquet')")
    return con


@pytest.fixture
def sales_data(spark, folder):
    """Sales whose keys repeat or are NULL; every part and region but one is named."""
    data = folder("data")
    tables = {
        "part": ([(1, "p"), (2, None)], "p_partkey long, p_type string"),
        "supplier": ([(1, 1), (2, 2)], "s_suppkey long, s_nationkey int"),
        "nation": ([(1, 1), (2, 2)], "n_nationkey int, n_regionkey int"),
        "region": ([(1, "EMEA"), (2, None)], "r_regionkey int, r_name string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{data}/{name}.parquet")

    def write(parts, suppliers):
        items = [(i // 2 if i % 5 else None, 1 + i % parts, 1 + i % 3 % suppliers, 1, datetime(2025, 1, 1), float(i)) for i in range(120)]
        schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz, l_quantity double"
        spark.createDataFrame(items, schema).repartition(4).write.parquet(f"{data}/lineitem.parquet")
        return data

    return write


def test_embedded_sales_are_loaded_by_one_writer(spark, sales_data, monkeypatch):
    """Several writers keep each other from locking the table, and Derby then holds a lock for each row."""
    data, writers = sales_data(1, 1), []

    def counted(df, *args):
        writers.append(df.rdd.getNumPartitions())
        jdbc.write_table(df, *args)

    monkeypatch.setattr(operational_db, "write_table", counted)
    assert all_queries()["scan_jdbc"](spark, data).count() == 120
    assert set(writers) == {1}


@pytest.mark.parametrize("name", ["scan_jdbc", "federated_region_totals", "etl_region_product", "verify_paths"])
def test_embedded_sales_hold_null_texts(spark, sales_data, name):
    data = sales_data(2, 2)
    assert compare.differences(all_queries()[name](spark, data), connect(data), ORACLES[name]) == []


def test_scan_pushes_filter_and_columns(spark, sf_dir):
    from pyspark.sql import functions as F

    df = files.scan(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_orderkey"], F.col("l_returnflag") == "R")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan


def test_staging_uses_the_configured_folder(spark):
    staged = stage(spark.range(5), "x")
    assert staged.count() == 5
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root and root in staged.inputFiles()[0]


def test_no_registered_query_uses_a_cross_join(spark, sf_dir):
    from tarnworks.plans.catalogue import all_queries

    for name in ("core_sales", "mart_monthly", "mart_quality", "reconcile_layers", "dedup_ranked", "replicated_counts"):
        plan = all_queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
