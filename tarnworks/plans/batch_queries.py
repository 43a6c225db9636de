"""Registered queries over plain DataFrames and the relational source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.functions.fixed_values import RELATIONAL_SOURCE
from tarnworks.functions.money import money_total
from tarnworks.operators import conform, distincts, distribution, marts, numbering, quality, reconcile
from tarnworks.plans import aggregate_etl, inputs, operational_db
from tarnworks.sources import files, generators, jdbc
from tarnworks.tables.named import NamedTable
from tarnworks.tables.versioned import VersionedTable
from tarnworks.workspace import fresh_dir, fresh_name, stage

SEGMENTS = 4


def unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.unify(inputs.landing_sales(spark, sf_dir), inputs.landing_events(spark, sf_dir))


def core(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.build_core(unified(spark, sf_dir))


def landing_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.landing_union(inputs.landing_sales(spark, sf_dir), inputs.landing_events(spark, sf_dir))


def dedup_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unified(spark, sf_dir).select(*conform.DEDUP_KEY, *conform.SURVIVOR_ORDER)
    return numbering.rank_rows(rows, conform.DEDUP_KEY, conform.survivor_order()).select(
        "_source", "id", "sale_date", "region", "product", "amount", "kafka_offset", "rn",
    )


def mart_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.profile(landing_union(spark, sf_dir), inputs.loaded_at())


def _stored(spark: SparkSession, rows: DataFrame, label: str) -> NamedTable:
    table = NamedTable(spark, fresh_name(label), label, fresh_dir(spark, label))
    table.overwrite(rows)
    return table


def distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact distinct ids of each source by quarter, and over all time, both from one table of monthly bitmaps."""
    bitmaps = _stored(spark, distincts.id_bitmaps(landing_union(spark, sf_dir), ["_source", "month"], "id"), "id_bitmaps").read()
    quarter = F.trunc("month", "quarter").alias("quarter")
    whole = distincts.distinct_ids(bitmaps, ["_source"]).withColumn("quarter", F.lit(None).cast("date"))
    return distincts.distinct_ids(bitmaps, ["_source", quarter]).unionByName(whole)


def approx_distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct ids of each source by year, estimated from a table of monthly sketches, held against the exact number."""
    landing = landing_union(spark, sf_dir)
    sketches = _stored(spark, distincts.id_sketches(landing, ["_source", "month"], "id"), "id_sketches").read()
    year = F.trunc("month", "year").alias("year")
    # bitmaps of years from the start: those of months would be twelve times as many, nearly all of their bits empty
    exact = distincts.distinct_ids(
        distincts.id_bitmaps(landing.withColumn("year", year), ["_source", "year"], "id"), ["_source", "year"], "exact_cnt",
    )
    both = exact.join(distincts.estimated_ids(sketches, ["_source", year]), ["_source", "year"])
    near = F.abs(F.col("ids_cnt") - F.col("exact_cnt")) <= F.col("exact_cnt") * 0.02
    return both.select("_source", "year", "exact_cnt", near.alias("within_2_percent"))


def order_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mart_quality(spark, sf_dir).orderBy("_source", F.col("month").asc_nulls_first())


def top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = marts.totals_by_region_product(inputs.sales(spark, sf_dir))
    return totals.orderBy(F.col("region").asc_nulls_first(), F.col("product").asc_nulls_first()).limit(20)


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters collected while core is written, not by reading it again."""
    observed, counters = quality.observe_layer(core(spark, sf_dir), "layer_counts")
    VersionedTable(spark, fresh_dir(spark, "core")).overwrite(observed)
    seen = counters.get
    return spark.createDataFrame([(seen["rows_cnt"], seen["valid_cnt"])], "rows_cnt bigint, valid_cnt bigint")


def reconcile_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales_total = inputs.sales(spark, sf_dir).agg(money_total(F.col("amount")).alias("v"))
    rows = stage(core(spark, sf_dir), "core")  # three totals follow from it
    relational = F.col("_source") == RELATIONAL_SOURCE
    valid = rows.where(F.col("is_valid") & relational).agg(money_total(F.col("amount")).alias("v"))
    by_product = marts.by_region_product_monthly(rows).where(relational)
    monthly = marts.monthly(rows).where(relational)
    return reconcile.run_checks([
        reconcile.Check("mart_equals_core", by_product.agg(money_total(F.col("total_amount")).alias("v")), valid),
        reconcile.Check("marts_agree", by_product.agg(money_total(F.col("total_amount")).alias("v")),
                        monthly.agg(money_total(F.col("total_amount")).alias("v"))),
        reconcile.Check("core_within_source", valid, sales_total, "at_most"),
        reconcile.Check("core_equals_source", valid, sales_total),
    ])


def scan_pushdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    late_returns = (F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return files.scan(inputs.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_quantity"], late_returns)


def scan_jdbc(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = operational_db.sales_source(spark, sf_dir)
    rows = jdbc.read_table(spark, source, operational_db.SALES_TABLE, partition_column="id",
                           partitions=spark.sparkContext.defaultParallelism)
    return lower_names(rows)


def federated_region_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = operational_db.sales_source(spark, sf_dir)
    asked = jdbc.read_query(
        spark, source,
        f"SELECT region, COUNT(*) AS rows_cnt, SUM(amount) AS total FROM {operational_db.SALES_TABLE} GROUP BY region",
    )
    return lower_names(asked).select(
        "region",
        F.col("rows_cnt").cast("bigint").alias("rows_cnt"),
        F.round("total", 2).cast("decimal(18,2)").alias("total"),
    )


def lower_names(df: DataFrame) -> DataFrame:
    """Databases differ in how they fold unquoted names."""
    return df.select(*[F.col(c).alias(c.lower()) for c in df.columns])


def etl_region_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = VersionedTable(spark, fresh_dir(spark, "totals"))
    aggregate_etl.load_totals(scan_jdbc(spark, sf_dir), target)
    return target.read()


def verify_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = operational_db.sales_source(spark, sf_dir)
    target = VersionedTable(spark, fresh_dir(spark, "totals"))
    aggregate_etl.load_totals(scan_jdbc(spark, sf_dir), target)
    checks = aggregate_etl.verify_paths(source, operational_db.SALES_TABLE, target, "loaded_totals")
    return reconcile.require(checks)


def seed_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = inputs.table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("g"))
    return generators.seed_sales(keys)


def seed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = inputs.table(spark, sf_dir, "events").select((F.col("event_id") + 1).alias("g"))
    return generators.seed_events(keys, inputs.loaded_at())


def segment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distribution.segment_counts(inputs.sales(spark, sf_dir), SEGMENTS)


def replicated_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = inputs.table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return distribution.replicated_counts(lookup, SEGMENTS)


QUERIES = {
    "scan_jdbc": scan_jdbc,
    "scan_pushdown": scan_pushdown,
    "federated_region_totals": federated_region_totals,
    "etl_region_product": etl_region_product,
    "verify_paths": verify_paths,
    "seed_sales": seed_sales,
    "seed_events": seed_events,
    "segment_counts": segment_counts,
    "replicated_counts": replicated_counts,
    "landing_sales": inputs.landing_sales,
    "landing_union": landing_union,
    "core_unified": unified,
    "core_sales": core,
    "dedup_ranked": dedup_ranked,
    "core_valid_total": lambda spark, d: marts.valid_total(core(spark, d), RELATIONAL_SOURCE),
    "mart_by_region_product_monthly": lambda spark, d: marts.by_region_product_monthly(core(spark, d)),
    "mart_monthly": lambda spark, d: marts.monthly(core(spark, d)),
    "mart_quality": mart_quality,
    "layer_counts": layer_counts,
    "reconcile_layers": reconcile_layers,
    "sales_by_region_product": lambda spark, d: marts.totals_by_region_product(inputs.sales(spark, d)),
    "grand_total": lambda spark, d: marts.grand_total(inputs.sales(spark, d)),
    "region_stats": lambda spark, d: marts.region_stats(inputs.sales(spark, d)),
    "region_stats_total": lambda spark, d: marts.region_stats_total(inputs.sales(spark, d)),
    "one_region_stats": lambda spark, d: marts.one_region_stats(inputs.sales(spark, d), "ASIA"),
    "approx_regions": lambda spark, d: marts.approx_regions(inputs.sales(spark, d)),
    "distinct_ids": distinct_ids,
    "approx_distinct_ids": approx_distinct_ids,
    "distinct_regions": lambda spark, d: marts.distinct_regions(inputs.sales(spark, d)),
    "weekday_split": lambda spark, d: marts.weekday_split(inputs.sales(spark, d)),
    "order_by": order_by,
    "top_n": top_n,
}
