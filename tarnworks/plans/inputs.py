"""The two landing tables, derived from the star-schema and event tables of a dataset folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.functions.fixed_values import RELATIONAL_SOURCE, STREAM_SOURCE
from tarnworks.operators.conform import with_lineage

LOADED_AT = "2025-01-01 00:00:00"


def loaded_at():
    return F.lit(LOADED_AT).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A dataset table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relational source: one sale per line item.

    Each lookup joins directly as a table scan, so Spark knows its size: it is broadcast while
    that stays under the threshold and shuffled, with skew splitting, beyond it.
    """
    item = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        item.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_shipdate").cast("date").alias("sale_date"),
            F.col("r_name").alias("region"),
            F.col("p_type").alias("product"),
            (F.col("l_quantity") * 21.5).cast("decimal(12,2)").alias("amount"),
        )
    )


def sales_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as typed rows, with NULLs, repeated ids and bad amounts mixed in."""
    return as_sales_events(table(spark, sf_dir, "events"))


def as_sales_events(events: DataFrame) -> DataFrame:
    """Rows of the event table, from a batch or a stream, as sales events."""
    n = F.col("event_id")
    return events.select(
        F.when(n % 101 != 0, n - n % 3).alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(n % 97 != 0, F.upper("event_type")).alias("region"),
        F.concat(F.lit("p"), (F.col("user_id") % 4).cast("string")).alias("product"),
        F.when(n % 89 == 0, None)
        .when(n % 83 == 0, -F.col("value") * 4)
        .otherwise(F.col("value") * 4)
        .alias("amount"),
        (F.col("user_id") % 3).cast("int").alias("kafka_partition"),
        n.alias("kafka_offset"),
    )


def landing_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_lineage(sales(spark, sf_dir), RELATIONAL_SOURCE, loaded_at())


def landing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_lineage(sales_events(spark, sf_dir), STREAM_SOURCE, loaded_at())
