"""Data-quality profile of the raw landing rows, and row counters taken while writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tarnworks.functions.fixed_values import AMOUNT_HIGH, AMOUNT_LOW
from tarnworks.functions.money import out_of_range
from tarnworks.functions.times import or_now
from tarnworks.operators.distincts import IDS, id_bitmaps


def profile(
    landing: DataFrame,
    checked_at: Column | None = None,
    low=AMOUNT_LOW,
    high=AMOUNT_HIGH,
    ids_are_sequence: bool = True,
) -> DataFrame:
    """Six counters per (source, month), before any row is dropped.

    Every NULL id counts as a duplicate. Distinct ids are bits of bitmaps, so rows meet by (source, month, bucket of ids),
    combined in tasks first: neither the NULL ids nor a large month land in one task. Ids that aren't numbers of a sequence
    would fill bitmaps badly; without ``ids_are_sequence`` rows meet by id instead, for the same result.
    """
    missing = lambda name: F.count_if(F.col(name).isNull())
    counters = [
        F.count("*").alias("n"),
        missing("id").alias("no_id"),
        missing("region").alias("no_region"),
        missing("amount").alias("no_amount"),
        F.count_if(out_of_range(F.col("amount"), low, high)).alias("out"),
    ]
    groups = ["_source", "month"]
    if ids_are_sequence:
        parts = id_bitmaps(landing, groups, "id", *counters).withColumn("known", F.bitmap_count(IDS))
    else:
        parts = landing.groupBy(*groups, "id").agg(*counters).withColumn("known", F.when(F.col("id").isNull(), 0).otherwise(1))
    return parts.groupBy(*groups).agg(
        F.sum("n").alias("rows_cnt"),
        F.sum("no_id").alias("null_id_cnt"),
        F.sum("no_region").alias("null_region_cnt"),
        F.sum("no_amount").alias("null_amount_cnt"),
        (F.sum("n") - F.sum("known")).alias("dup_id_cnt"),
        F.sum("out").alias("amount_out_of_range_cnt"),
    ).withColumn("checked_at", or_now(checked_at))


def observe_layer(core: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows and valid rows as a side effect of the write that follows."""
    counters = Observation(name)
    observed = core.observe(
        counters,
        F.count("*").alias("rows_cnt"),
        F.count_if("is_valid").alias("valid_cnt"),
    )
    return observed, counters
