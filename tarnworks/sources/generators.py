"""Generated sales and events, repeatable because values come from the key and not from a seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.functions.fixed_values import (
    EVENT_REGIONS,
    PRODUCTS,
    SALES_DAYS,
    SALES_FIRST_DAY,
    SALES_REGIONS,
)

_MODULUS = 100_003
_FACTOR = 48_271


def series(spark: SparkSession, rows: int, column: str = "g") -> DataFrame:
    return spark.range(1, rows + 1).select(F.col("id").alias(column))


def scatter(key: Column) -> Column:
    """A number in [0, 100003) that jumps around as the key counts up."""
    return (key % _MODULUS) * _FACTOR % _MODULUS


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def seed_sales(keys: DataFrame, column: str = "g") -> DataFrame:
    """Sales rows for integer keys: 180 days in turn, region and product in step, 0.00-1000.00."""
    g = F.col(column)
    return keys.select(
        g.cast("bigint").alias("id"),
        F.date_add(F.lit(SALES_FIRST_DAY).cast("date"), (g % SALES_DAYS).cast("int")).alias("sale_date"),
        _pick(SALES_REGIONS, g % 4).alias("region"),
        _pick(PRODUCTS, g % 4).alias("product"),
        ((scatter(g) % 100_001).cast("decimal(12,2)") / 100).cast("decimal(12,2)").alias("amount"),
    )


def seed_events(keys: DataFrame, base_ts: Column, column: str = "g") -> DataFrame:
    """Events with ids 1..N, one second apart from ``base_ts``, amounts 1.00-1000.00."""
    g = F.col(column)
    h = scatter(g)
    return keys.select(
        g.cast("bigint").alias("id"),
        F.timestamp_micros(F.unix_micros(base_ts) + g.cast("bigint") * 1_000_000).alias("ts"),
        _pick(EVENT_REGIONS, h % 4).alias("region"),
        _pick(PRODUCTS, F.floor(h / 4) % 4).alias("product"),
        F.round(1 + (h % 99_901) / 100, 2).alias("amount"),
    )
