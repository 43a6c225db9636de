"""Landing, core, marts, quality, serving copies and their reconciliation.

Each step reads tables and replaces tables, so each can be run again on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.functions.fixed_values import RELATIONAL_SOURCE, STREAM_SOURCE
from tarnworks.functions.money import money_total
from tarnworks.functions.times import to_second
from tarnworks.operators import conform, marts, quality
from tarnworks.operators.distribution import in_serving_order
from tarnworks.operators.reconcile import Check, require, run_checks
from tarnworks.schemas import (
    LANDING_EVENTS,
    SERVING_BY_REGION_PRODUCT,
    SERVING_MONTHLY,
    SERVING_QUALITY,
)
from tarnworks.tables.named import NamedTable
from tarnworks.tables.versioned import VersionedTable

BY_REGION_PRODUCT = "sales_by_region_product_monthly"
MONTHLY = "sales_monthly"
QUALITY = "sales_quality"

SERVING = {
    BY_REGION_PRODUCT: (SERVING_BY_REGION_PRODUCT, ["sale_month", "region", "product"]),
    MONTHLY: (SERVING_MONTHLY, ["sale_month"]),
    QUALITY: (SERVING_QUALITY, ["month", "_source"]),
}

# Serving columns take no NULL; a NULL becomes the empty value of its type.
EMPTY_VALUES = {
    "string": "",
    "bigint": "0",
    "decimal(18,2)": "0",
    "date": "1970-01-01",
    "timestamp": "1970-01-01 00:00:00",
}


class Lake:
    """Named tables, with a database for each layer, stored under one root folder.

    ``prefix`` begins the databases' names and keeps several lakes of one catalog apart.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root
        self.prefix = prefix

    def table(self, layer: str, name: str) -> NamedTable:
        return NamedTable(self.spark, f"{self.prefix}{layer}", name, f"{self.root}/{layer}")


def land_sales(lake: Lake, sales: DataFrame, loaded_at: Column | None = None) -> None:
    lake.table("landing", "sales").overwrite(conform.with_lineage(sales, RELATIONAL_SOURCE, loaded_at))


def land_events(lake: Lake, source: VersionedTable | NamedTable, loaded_at: Column | None = None) -> None:
    """Replace landing with the streamed table. Without one, keep the landing there is, or declare
    an empty one, so that the steps after it always find a table."""
    landing = lake.table("landing", "sales_events")
    if source.exists():
        landing.overwrite(conform.with_lineage(source.read(), STREAM_SOURCE, loaded_at))
    else:
        landing.create(LANDING_EVENTS)


def build_core(lake: Lake) -> dict[str, int]:
    """Rebuild core; the row counters come from the write itself."""
    unified = conform.unify(lake.table("landing", "sales").read(), lake.table("landing", "sales_events").read())
    core, counters = quality.observe_layer(conform.build_core(unified), "core")
    lake.table("core", "sales").overwrite(core)
    return counters.get


def build_marts(lake: Lake) -> None:
    """Both marts from one scan of core: the monthly one rolls up the finer one."""
    core = lake.table("core", "sales").read()
    by_region_product = lake.table("mart", BY_REGION_PRODUCT)
    by_region_product.overwrite(marts.by_region_product_monthly(core))
    lake.table("mart", MONTHLY).overwrite(marts.monthly_from_rollup(by_region_product.read()))


def build_quality(lake: Lake, checked_at: Column | None = None) -> None:
    landing = conform.landing_union(
        lake.table("landing", "sales").read(), lake.table("landing", "sales_events").read(),
    )
    lake.table("mart", QUALITY).overwrite(quality.profile(landing, checked_at))


def serving_rows(mart: DataFrame, name: str) -> DataFrame:
    schema, order = SERVING[name]
    filled = mart.select(*[
        F.coalesce(F.col(f.name), F.lit(EMPTY_VALUES[f.dataType.simpleString()]).cast(f.dataType)).alias(f.name)
        for f in schema.fields
    ])
    if "checked_at" in schema.names:
        filled = filled.withColumn("checked_at", to_second(F.col("checked_at")))
    return in_serving_order(filled, schema, order)


def publish(lake: Lake) -> dict[str, int]:
    """Copy the marts to serving tables in serving order; readers see the old copy or the new one."""
    published = {}
    for name in SERVING:
        published[name] = lake.table("serving", name).overwrite(serving_rows(lake.table("mart", name).read(), name))
    return published


def verify_publish(lake: Lake, source_sales: DataFrame) -> DataFrame:
    def total(layer: str, name: str, column: str, keep: Column | None = None) -> DataFrame:
        rows = lake.table(layer, name).read()
        return (rows if keep is None else rows.where(keep)).agg(money_total(F.col(column)).alias("v"))

    def rows(layer: str, name: str) -> DataFrame:
        return lake.table(layer, name).read().agg(F.count("*").alias("v"))

    relational = F.col("_source") == RELATIONAL_SOURCE
    core_valid = total("core", "sales", "amount", F.col("is_valid") & relational)
    return run_checks([
        Check("serving_by_region_product", total("serving", BY_REGION_PRODUCT, "total_amount"),
              total("mart", BY_REGION_PRODUCT, "total_amount")),
        Check("serving_monthly", total("serving", MONTHLY, "total_amount"), total("mart", MONTHLY, "total_amount")),
        Check("serving_quality_rows", rows("serving", QUALITY), rows("mart", QUALITY)),
        Check("mart_equals_core", total("serving", MONTHLY, "total_amount", relational), core_valid),
        Check("core_within_source", core_valid, source_sales.agg(money_total(F.col("amount")).alias("v")), "at_most"),
    ])


def run(
    lake: Lake,
    sales: DataFrame,
    events: VersionedTable | NamedTable,
    loaded_at: Column | None = None,
) -> DataFrame:
    """The whole chain; raises when a layer does not reconcile. Returns the check results."""
    land_sales(lake, sales, loaded_at)
    land_events(lake, events, loaded_at)
    build_core(lake)
    build_marts(lake)
    build_quality(lake, loaded_at)
    publish(lake)
    return require(verify_publish(lake, sales))
