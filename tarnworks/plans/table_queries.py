"""Registered queries over versioned tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnworks.operators.marts import totals_by_region_product
from tarnworks.plans import inputs, medallion
from tarnworks.sources import files, generators
from tarnworks.tables import days, rowops, upkeep
from tarnworks.tables.named import NamedTable
from tarnworks.tables.partitioned import DayTable, PartitionedTable
from tarnworks.tables.versioned import VersionedTable
from tarnworks.workspace import fresh_dir, fresh_name

# Orders up to this day are the first load of the demo table, later ones arrive as changes.
FIRST_LOAD_END = "1998-01-01"
AFTER_ALL = datetime(2100, 1, 1, tzinfo=timezone.utc)


def new_table(spark: SparkSession, label: str) -> VersionedTable:
    return VersionedTable(spark, fresh_dir(spark, label))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals_by_region_product(inputs.sales(spark, sf_dir))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in the shape of the demo table: id, ts, kind, payload."""
    return inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        F.col("o_orderstatus").alias("kind"),
        F.col("o_orderpriority").alias("payload"),
    )


def first_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events(spark, sf_dir).where(F.col("ts") < F.lit(FIRST_LOAD_END).cast("timestamp"))


def later_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_events(spark, sf_dir).where(F.col("ts") >= F.lit(FIRST_LOAD_END).cast("timestamp"))


def orders_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Two appends: the first load and the later orders."""
    first = first_orders(spark, sf_dir)
    table = new_table(spark, "orders").create(first.schema)
    table.append(first)
    table.append(later_orders(spark, sf_dir))
    return table


def events_table(spark: SparkSession, sf_dir: str) -> VersionedTable:
    table = new_table(spark, "events")
    table.overwrite(inputs.sales_events(spark, sf_dir))
    return table


# ---- sinks ------------------------------------------------------------------


def new_named(spark: SparkSession, label: str) -> NamedTable:
    return NamedTable(spark, fresh_name(label), label, fresh_dir(spark, label))


def write_replace(spark, sf_dir):
    table = new_named(spark, "replaced")
    table.overwrite(inputs.sales_events(spark, sf_dir))
    table.overwrite(totals(spark, sf_dir))
    return table.read()


def create_if_absent(spark, sf_dir):
    """Rows read back after creating, filling and creating again."""
    rows = inputs.sales_events(spark, sf_dir)
    table = new_named(spark, "created")
    seen = []
    for step in ("created", "filled", "created_again"):
        if step == "filled":
            table.append(rows)
        else:
            table.create(rows.schema)
        seen.append((step, table.read().count()))
    return spark.createDataFrame(seen, "step string, rows_cnt bigint")


def write_append(spark, sf_dir):
    table = new_named(spark, "appended")
    table.overwrite(totals(spark, sf_dir))
    table.append(spark.sql("SELECT * FROM VALUES ('POLAR', 'sundries', 17.25), (NULL, 'sundries', 0.50) AS extra(region, product, total_amount)"))
    return table.read()


def append_arrow(spark, sf_dir):
    table = new_named(spark, "appended")
    table.overwrite(totals(spark, sf_dir))
    fields = pa.schema([("region", pa.string()), ("product", pa.string()), ("total_amount", pa.decimal128(22, 2))])
    late = [{"region": name, "product": "correction", "total_amount": Decimal(cents).scaleb(-2)} for name, cents in (("POLAR", -250), ("INLAND", 4075))]
    table.append(spark.createDataFrame(pa.Table.from_pylist(late, schema=fields)))
    return table.read()


def insert_select(spark, sf_dir):
    schema = T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("region", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("amount", T.DecimalType(12, 2)),
    ])
    table = new_named(spark, "copied").create(schema)
    rows = inputs.sales(spark, sf_dir).select(*schema.names)
    table.append(rows)
    return table.read()


def seed_if_empty(spark, sf_dir):
    """Rows read back after each of two attempts; the second finds the table filled and leaves it."""
    keys = inputs.table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("g"))
    rows = generators.seed_sales(keys)
    table = new_named(spark, "seeded").create(rows.schema)
    seen = []
    for attempt in (1, 2):
        table.seed(rows)
        seen.append((attempt, table.read().count()))
    return spark.createDataFrame(seen, "attempt int, rows_cnt bigint")


def _event_rows(spark, sf_dir) -> DataFrame:
    return inputs.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("kind"),
        F.col("props").alias("payload"),
    )


def partition_by_day(spark, sf_dir):
    """A span of some days and hours, read from a table laid out by day."""
    table = DayTable(spark, fresh_name("by_day"), "events", fresh_dir(spark, "by-day"), "ts").create(_event_rows(spark, sf_dir))
    return table.between("2024-01-02 06:00:00", "2024-01-11 18:00:00")


def landing_fallback(spark, sf_dir):
    """Landing rows: no source yet, source present, source gone again."""
    lake = _new_lake(spark)
    landing = lake.table("landing", "sales_events")
    missing = new_table(spark, "absent")
    seen = []
    for step, source in (("absent", missing), ("present", events_table(spark, sf_dir)), ("gone", missing)):
        medallion.land_events(lake, source, inputs.loaded_at())
        seen.append((step, landing.read().count()))
    return spark.createDataFrame(seen, "step string, rows_cnt bigint")


# ---- scans ------------------------------------------------------------------


def _rewritten(spark, sf_dir) -> VersionedTable:
    table = new_table(spark, "rewritten")
    table.overwrite(totals(spark, sf_dir))
    table.overwrite(totals(spark, sf_dir))
    return table


def _count_and_total(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("rows_cnt"), F.round(F.sum("total_amount"), 2).alias("total"))


def scan_raw_glob(spark, sf_dir):
    return _count_and_total(files.raw_glob(spark, f"{_rewritten(spark, sf_dir).root}/data/*/*.parquet"))


def scan_versioned(spark, sf_dir):
    return _count_and_total(_rewritten(spark, sf_dir).read())


def file_size_profile(spark, sf_dir):
    """Files and rows of each year of a compacted table, and whether the sketch of file sizes, merged over all years, holds them."""
    table = delivered_orders(spark, sf_dir)
    table.compact(min_input_files=2)
    profile = files.size_profile(table.files(), "_part", "bytes")
    ends = files.size_quantiles(profile, [0.0, 1.0]).first()
    whole = profile.agg(F.sum("file_count").alias("n"), F.min("min_bytes").alias("least"), F.max("max_bytes").alias("most")).first()
    agrees = (ends["file_count"], ends["quantiles"]) == (whole["n"], [whole["least"], whole["most"]])
    rows = spark.table(table.name).groupBy("_part").agg(F.count("*").alias("rows_cnt"))
    return profile.join(rows, "_part").select(
        F.col("_part").alias("year"), "file_count", "rows_cnt", F.lit(agrees).alias("sketch_agrees"),
    )


# ---- versions ---------------------------------------------------------------


def table_history(spark, sf_dir):
    table = orders_table(spark, sf_dir)
    rowops.delete_merge_on_read(table, F.col("kind") == "P")
    total = F.try_element_at("summary", F.lit("total-records")).cast("bigint")
    return table.history().select("version", "operation", total.alias("total_records"))


def time_travel(spark, sf_dir):
    """The table as its first load left it, addressed by snapshot id."""
    table = orders_table(spark, sf_dir)
    rowops.delete_copy_on_write(table, F.col("kind") == "P")
    return table.read(snapshot_id=table.snapshot(version=1).snapshot_id)


def schema_evolution(spark, sf_dir):
    first = first_orders(spark, sf_dir)
    table = new_table(spark, "evolved").create(first.schema)
    table.append(first)
    table.add_column("source", T.StringType())
    table.append(later_orders(spark, sf_dir).withColumn("source", F.lit("web")))
    return table.read()


def shipped_updates(spark, sf_dir) -> DataFrame:
    """One change per order that has line items; returned items are booked under the negated key, as a new row."""
    items, key = inputs.table(spark, sf_dir, "lineitem"), F.col("l_orderkey")
    booked = F.when(F.col("l_returnflag") == "R", -key).otherwise(key)
    return items.groupBy(booked.alias("id")).agg(F.max("l_returnflag").alias("kind"))


def partitioned(spark, name: str, part) -> PartitionedTable:
    """A new table whose rows lie by a text of their time."""
    return PartitionedTable(spark, fresh_name(name), name, fresh_dir(spark, name), part, ["ts"])


def merge_upsert(spark, sf_dir):
    table = partitioned(spark, "orders", F.date_format("ts", "yyyy-MM")).create(order_events(spark, sf_dir))
    table.merge(shipped_updates(spark, sf_dir), ["id"], ["kind"], ["id", "kind"])
    return table.read()


def delete_copy_on_write(spark, sf_dir):
    table = partitioned(spark, "events", F.to_date("ts")).create(inputs.sales_events(spark, sf_dir))
    table.delete(F.col("region") == "CLICK")
    return table.read()


def delete_merge_on_read(spark, sf_dir):
    table = events_table(spark, sf_dir)
    rowops.delete_merge_on_read(table, F.col("region") == "CLICK")
    rowops.delete_merge_on_read(table, F.col("amount") > 500)
    return table.read()


def table_delete_files(spark, sf_dir):
    table = events_table(spark, sf_dir)
    rowops.delete_merge_on_read(table, F.col("region") == "CLICK")
    return table.delete_files().agg(
        F.sum("record_count").alias("deleted_rows"),
        (F.count("*") > 0).alias("has_delete_files"),
    )


def delivered_orders(spark, sf_dir) -> PartitionedTable:
    """Orders by year, delivered in three parts, so that every year has small files."""
    orders, part = order_events(spark, sf_dir), F.pmod("id", F.lit(3))
    table = partitioned(spark, "orders", F.year("ts")).create(orders.where(part == 0))
    return table.append(orders.where(part == 1)).append(orders.where(part == 2))


def compact_files(spark, sf_dir):
    """The rows, and whether the first run left fewer files and the second had nothing to do."""
    table = delivered_orders(spark, sf_dir)
    before = table.files().count()
    table.compact(min_input_files=2)
    fewer = table.files().count() < before
    settled = table.compact(min_input_files=2) == 0
    return table.read().withColumns({"fewer_files": F.lit(fewer), "settled": F.lit(settled)})


def compact_deletes(spark, sf_dir):
    table = events_table(spark, sf_dir)
    rowops.delete_merge_on_read(table, F.col("region") == "CLICK")
    upkeep.compact(table, rewrite_all=True)
    upkeep.drop_dangling_deletes(table)
    return table.read().withColumn("delete_files", F.lit(table.delete_files().count()).cast("bigint"))


def expire_snapshots(spark, sf_dir):
    table = orders_table(spark, sf_dir)
    rowops.delete_copy_on_write(table, F.col("kind") == "P")
    upkeep.expire_snapshots(table, AFTER_ALL, retain_last=1, dry_run=False)
    return table.read().withColumn("snapshots", F.lit(len(table.log.versions())))


def orphan_files(spark, sf_dir):
    """Rows in files that a job wrote without ever committing them."""
    table = orders_table(spark, sf_dir)
    table.write_rows(later_orders(spark, sf_dir), [])
    orphans = upkeep.orphan_files(table, now=datetime.now(timezone.utc) + timedelta(days=4))
    paths = [f"{table.root}/{row[0]}" for row in orphans.select("path").toLocalIterator()]
    return spark.read.schema(table.snapshot().struct).parquet(*paths).agg(F.count("*").alias("orphan_rows"))


def table_files(spark, sf_dir):
    table = orders_table(spark, sf_dir)
    return table.data_files().select(F.col("path").alias("file_path"), "record_count", "file_size_in_bytes")


def _by_day(spark, sf_dir) -> VersionedTable:
    rows = _event_rows(spark, sf_dir)
    table = days.create(new_table(spark, "by-day"), rows.schema, "ts")
    days.append(table, rows, "ts")
    return table


def table_partitions(spark, sf_dir):
    return _by_day(spark, sf_dir).partitions().select("partition", "record_count")


# ---- layers -----------------------------------------------------------------


def _new_lake(spark: SparkSession) -> medallion.Lake:
    return medallion.Lake(spark, fresh_dir(spark, "lake"), fresh_name("lake") + "_")


def _lake(spark, sf_dir) -> medallion.Lake:
    lake = _new_lake(spark)
    medallion.run(lake, inputs.sales(spark, sf_dir), events_table(spark, sf_dir), inputs.loaded_at())
    return lake


def publish_marts(spark, sf_dir):
    return _lake(spark, sf_dir).table("serving", medallion.BY_REGION_PRODUCT).read()


def verify_publish(spark, sf_dir):
    return medallion.verify_publish(_lake(spark, sf_dir), inputs.sales(spark, sf_dir))


def medallion_flow(spark, sf_dir):
    return _lake(spark, sf_dir).table("serving", medallion.MONTHLY).read()


QUERIES = {
    "write_replace": write_replace,
    "create_if_absent": create_if_absent,
    "write_append": write_append,
    "append_arrow": append_arrow,
    "insert_select": insert_select,
    "seed_if_empty": seed_if_empty,
    "partition_by_day": partition_by_day,
    "landing_fallback": landing_fallback,
    "scan_raw_glob": scan_raw_glob,
    "scan_versioned": scan_versioned,
    "file_size_profile": file_size_profile,
    "table_history": table_history,
    "time_travel": time_travel,
    "schema_evolution": schema_evolution,
    "merge_upsert": merge_upsert,
    "delete_copy_on_write": delete_copy_on_write,
    "delete_merge_on_read": delete_merge_on_read,
    "table_delete_files": table_delete_files,
    "compact_files": compact_files,
    "compact_deletes": compact_deletes,
    "expire_snapshots": expire_snapshots,
    "orphan_files": orphan_files,
    "table_files": table_files,
    "table_partitions": table_partitions,
    "publish_marts": publish_marts,
    "verify_publish": verify_publish,
    "medallion_flow": medallion_flow,
}
