"""Streams over the event table of a dataset folder: read where it lies, or delivered to an inbox in parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.functions.messages import encode_event
from tarnworks.plans import inputs
from tarnworks.sources import event_files
from tarnworks.sources.event_files import EventFiles
from tarnworks.workspace import fresh_dir

SPOILT_EVERY, SPOILT_AT = 50, 7


def as_messages(events: DataFrame) -> DataFrame:
    """Rows of the event table with a topic's columns; an event's number is its offset."""
    return inputs.as_sales_events(events).select(
        F.col("region").cast("binary").alias("key"),
        encode_event("id", "ts", "region", "product", "amount").alias("value"),
        F.col("kafka_partition").alias("partition"), F.col("kafka_offset").alias("offset"), F.col("ts").alias("timestamp"),
    )


def with_spoilt_values(events: DataFrame) -> DataFrame:
    """Messages of which one in fifty isn't JSON."""
    spoilt = F.concat(F.lit("{spoilt "), F.col("offset").cast("string")).cast("binary")
    return as_messages(events).withColumn(
        "value", F.when(F.col("offset") % SPOILT_EVERY == SPOILT_AT, spoilt).otherwise(F.col("value")),
    )


def arrived(spark: SparkSession, sf_dir: str, messages=as_messages) -> EventFiles:
    """The event table itself. Braces make its path a pattern, which a stream takes for a file as for a folder."""
    schema = inputs.table(spark, sf_dir, "events").schema
    return EventFiles(f"{sf_dir}/{{events.parquet}}", schema, messages)


def inbox(spark: SparkSession, sf_dir: str) -> EventFiles:
    """A folder for deliveries."""
    return EventFiles(fresh_dir(spark, "inbox"), inputs.table(spark, sf_dir, "events").schema, as_messages)


def deliver(spark: SparkSession, sf_dir: str, box: EventFiles, keep: Column) -> int:
    """Put the events that satisfy ``keep`` into the inbox; returns how many."""
    return event_files.deliver(inputs.table(spark, sf_dir, "events").where(keep), box.path)
