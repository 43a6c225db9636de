"""Landing to core: lineage columns, one schema for both sources, deduplication, validity flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnworks.functions.fixed_values import AMOUNT_HIGH, AMOUNT_LOW
from tarnworks.functions.money import to_money, valid_flag
from tarnworks.functions.times import month_of, or_now

# id first: Spark sorts on an 8-byte prefix of the leading column, and the source tag is nearly constant.
DEDUP_KEY = ["id", "_source"]

# Which duplicate survives: the last loaded, then the latest event, then its topic position.
# The sale columns close the order, so rows that still tie are copies of each other.
SURVIVOR_ORDER = [
    "_loaded_at", "event_ts", "kafka_partition", "kafka_offset",
    "sale_date", "amount", "region", "product",
]

CORE_COLUMNS = [
    "id", "sale_date", "region", "product", "amount",
    "is_valid", "sale_month", "_source", "_loaded_at",
]


def survivor_order() -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in SURVIVOR_ORDER]


def with_lineage(df: DataFrame, source: str, loaded_at: Column | None = None) -> DataFrame:
    return df.withColumns({"_loaded_at": or_now(loaded_at), "_source": F.lit(source)})


def conform_sales(landing: DataFrame) -> DataFrame:
    return landing.select(
        F.col("id").try_cast("bigint").alias("id"),
        "sale_date",
        F.lower("region").alias("region"),
        "product",
        to_money(F.col("amount")).alias("amount"),
        "_source",
        "_loaded_at",
        F.lit(None).cast("timestamp").alias("event_ts"),
        F.lit(None).cast("int").alias("kafka_partition"),
        F.lit(None).cast("bigint").alias("kafka_offset"),
    )


def conform_events(landing: DataFrame) -> DataFrame:
    return landing.select(
        F.col("id").try_cast("bigint").alias("id"),
        F.col("ts").cast("date").alias("sale_date"),
        F.lower("region").alias("region"),
        "product",
        to_money(F.col("amount")).alias("amount"),
        "_source",
        "_loaded_at",
        F.col("ts").cast("timestamp").alias("event_ts"),
        "kafka_partition",
        F.col("kafka_offset").cast("bigint").alias("kafka_offset"),
    )


def unify(landing_sales: DataFrame, landing_events: DataFrame) -> DataFrame:
    return conform_sales(landing_sales).unionByName(conform_events(landing_events))


def keep_survivors(unified: DataFrame) -> DataFrame:
    """One row per (source, id); all NULL ids of a source count as one id.

    The rank filter is a top-1 per group: Spark trims every group inside each map task before
    the shuffle, so an id that holds a third of all rows sends one row per task.
    """
    window = Window.partitionBy(*DEDUP_KEY).orderBy(*survivor_order())
    return unified.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def build_core(unified: DataFrame, low=AMOUNT_LOW, high=AMOUNT_HIGH) -> DataFrame:
    flagged = keep_survivors(unified).withColumns({
        "is_valid": valid_flag(F.col("id"), F.col("amount"), low, high),
        "sale_month": month_of(F.col("sale_date")),
    })
    return flagged.select(*CORE_COLUMNS)


def landing_union(landing_sales: DataFrame, landing_events: DataFrame) -> DataFrame:
    """UNION ALL of the raw landings on the columns quality looks at.

    Amounts meet as doubles here: quality judges what arrived, not what core rounded.
    """
    def part(df: DataFrame, day: Column) -> DataFrame:
        return df.select(
            "_source",
            month_of(day).alias("month"),
            F.col("id").cast("bigint").alias("id"),
            "region",
            F.col("amount").cast("double").alias("amount"),
        )

    sales = part(landing_sales, F.col("sale_date"))
    events = part(landing_events, F.col("ts").cast("date"))
    return sales.unionByName(events)
