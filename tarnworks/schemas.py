"""Declared schemas. Nothing is inferred from JSON."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
MART_MONEY = T.DecimalType(18, 2)

SALES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("sale_date", T.DateType()),
    T.StructField("region", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("amount", MONEY),
])

EVENT_VALUE = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("region", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("amount", T.DoubleType()),
])

SALES_EVENTS = T.StructType([
    *EVENT_VALUE.fields,
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
])

LINEAGE = [
    T.StructField("_loaded_at", T.TimestampType()),
    T.StructField("_source", T.StringType()),
]

LANDING_SALES = T.StructType([*SALES.fields, *LINEAGE])
LANDING_EVENTS = T.StructType([*SALES_EVENTS.fields, *LINEAGE])

TOPIC_RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

REGION_PRODUCT_TOTALS = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("total_amount", T.DecimalType(22, 2)),
])

SERVING_BY_REGION_PRODUCT = T.StructType([
    T.StructField("sale_month", T.DateType()),
    T.StructField("_source", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("orders_cnt", T.LongType()),
    T.StructField("total_amount", MART_MONEY),
    T.StructField("avg_amount", MART_MONEY),
])

SERVING_MONTHLY = T.StructType([
    T.StructField("sale_month", T.DateType()),
    T.StructField("_source", T.StringType()),
    T.StructField("orders_cnt", T.LongType()),
    T.StructField("total_amount", MART_MONEY),
    T.StructField("regions_cnt", T.LongType()),
    T.StructField("products_cnt", T.LongType()),
])

SERVING_QUALITY = T.StructType([
    T.StructField("_source", T.StringType()),
    T.StructField("month", T.DateType()),
    T.StructField("rows_cnt", T.LongType()),
    T.StructField("null_id_cnt", T.LongType()),
    T.StructField("null_region_cnt", T.LongType()),
    T.StructField("null_amount_cnt", T.LongType()),
    T.StructField("dup_id_cnt", T.LongType()),
    T.StructField("amount_out_of_range_cnt", T.LongType()),
    T.StructField("checked_at", T.TimestampType()),
])
