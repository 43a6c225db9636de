"""Aggregates over sales: the marts and the smaller reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnworks.functions.money import to_mart_money
from tarnworks.functions.times import is_weekend


def totals_by_region_product(sales: DataFrame, *more: Column) -> DataFrame:
    """Sum per (region, product); ``more`` aggregates ride along."""
    return sales.groupBy("region", "product").agg(F.sum("amount").alias("total_amount"), *more)


def by_region_product_monthly(core: DataFrame) -> DataFrame:
    return (
        core.where("is_valid")
        .groupBy("sale_month", "_source", "region", "product")
        .agg(
            F.count("*").alias("orders_cnt"),
            to_mart_money(F.sum("amount")).alias("total_amount"),
            to_mart_money(F.avg("amount")).alias("avg_amount"),
        )
    )


def monthly(core: DataFrame) -> DataFrame:
    """Monthly totals with distinct regions and products.

    Two distinct counts over raw rows would triple them. Rolling up to (region, product) first
    leaves a table with one row per combination, and the distinct counts run over that.
    """
    rollup = (
        core.where("is_valid")
        .groupBy("sale_month", "_source", "region", "product")
        .agg(F.count("*").alias("n"), F.sum("amount").alias("s"))
    )
    return rollup.groupBy("sale_month", "_source").agg(
        F.sum("n").alias("orders_cnt"),
        to_mart_money(F.sum("s")).alias("total_amount"),
        F.count_distinct("region").alias("regions_cnt"),
        F.count_distinct("product").alias("products_cnt"),
    )


def monthly_from_rollup(by_region_product: DataFrame) -> DataFrame:
    """The same totals from the stored mart, which is far smaller than core."""
    return by_region_product.groupBy("sale_month", "_source").agg(
        F.sum("orders_cnt").alias("orders_cnt"),
        to_mart_money(F.sum("total_amount")).alias("total_amount"),
        F.count_distinct("region").alias("regions_cnt"),
        F.count_distinct("product").alias("products_cnt"),
    )


def grand_total(sales: DataFrame) -> DataFrame:
    return sales.agg(F.round(F.sum("amount"), 2).alias("total"))


def region_stats(sales: DataFrame) -> DataFrame:
    return sales.groupBy("region").agg(
        F.count("*").alias("rows_cnt"),
        F.round(F.sum("amount"), 2).alias("total"),
    )


def one_region_stats(sales: DataFrame, region: str) -> DataFrame:
    return sales.where(F.col("region") == region).agg(
        F.lit(region).alias("region"),
        F.count("*").alias("rows_cnt"),
        F.round(F.sum("amount"), 2).alias("total"),
    )


def region_stats_total(sales: DataFrame) -> DataFrame:
    """Grand total of the per-region totals, each rounded before it is added."""
    return region_stats(sales).agg(
        F.count("*").alias("regions_cnt"),
        F.sum("rows_cnt").alias("rows_cnt"),
        F.round(F.sum("total"), 2).alias("total"),
    )


def approx_regions(sales: DataFrame) -> DataFrame:
    return sales.agg(
        F.count("*").alias("rows_cnt"),
        F.approx_count_distinct("region").alias("regions_cnt"),
    )


def distinct_regions(sales: DataFrame) -> DataFrame:
    return sales.select("region").distinct().orderBy(F.col("region").asc_nulls_first())


def latest_event(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("rows_cnt"), F.max("ts").alias("latest_ts"))


def valid_total(core: DataFrame, source: str) -> DataFrame:
    return core.where(F.col("is_valid") & (F.col("_source") == source)).agg(
        F.count("*").alias("rows_cnt"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(18,2)").alias("total"),
    )


def weekday_split(sales: DataFrame) -> DataFrame:
    return sales.groupBy(is_weekend(F.col("sale_date")).alias("is_weekend")).agg(
        F.count("*").alias("rows_cnt"),
        to_mart_money(F.sum("amount")).alias("total_amount"),
    )
