"""Topics filled from the event table of a dataset folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.functions.messages import encode_event
from tarnworks.plans import inputs
from tarnworks.sources.topic import Topic, produce
from tarnworks.workspace import fresh_dir

PARTITIONS = 3


def messages(events: DataFrame, keyed: bool = True, placed: bool = True) -> DataFrame:
    """Typed events as messages, in ``kafka_offset`` order; ``placed`` keeps their partition."""
    key = F.col("region").cast("binary") if keyed else F.lit(None).cast("binary")
    columns = [key.alias("key"), encode_event("id", "ts", "region", "product", "amount").alias("value"), "kafka_offset"]
    if placed:
        columns.append(F.col("kafka_partition").alias("partition"))
    return events.select(*columns, F.col("ts").alias("timestamp"))


def new_topic(spark: SparkSession) -> Topic:
    return Topic(fresh_dir(spark, "topic"), partitions=PARTITIONS)


def deliver(spark: SparkSession, sf_dir: str, topic: Topic, keep: Column | None = None) -> int:
    """Send the events, or those that satisfy ``keep``; returns how many were delivered."""
    events = inputs.sales_events(spark, sf_dir)
    if keep is not None:
        events = events.where(keep)
    return produce(messages(events), topic, ["kafka_offset"])


def filled_topic(spark: SparkSession, sf_dir: str) -> Topic:
    """A topic with all events."""
    topic = new_topic(spark)
    deliver(spark, sf_dir, topic)
    return topic
