"""Event topics.

With ``kafka.bootstrap.servers`` configured the functions use Spark's Kafka connector. Without it
a topic is a folder of Parquet files with the connector's columns, which a streaming query reads
file by file with the same checkpoint rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tarnworks.functions.messages import partition_of
from tarnworks.operators.numbering import number_within
from tarnworks.schemas import TOPIC_RECORD
from tarnworks.sources import filesystem as fs

COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]


@dataclass(frozen=True)
class Topic:
    """``name`` is a topic name for Kafka, a folder otherwise."""

    name: str
    options: dict[str, str] = field(default_factory=dict)
    partitions: int = 3

    @property
    def on_kafka(self) -> bool:
        return "kafka.bootstrap.servers" in self.options


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """Everything in the topic, as a batch."""
    if topic.on_kafka:
        reader = spark.read.format("kafka").options(**topic.options).option("subscribe", topic.name)
        return reader.option("startingOffsets", "earliest").load().select(*COLUMNS)
    if not fs.exists(spark, topic.name):
        return spark.createDataFrame([], TOPIC_RECORD).withColumn("topic", F.lit(topic.name)).select(*COLUMNS)
    return spark.read.schema(TOPIC_RECORD).parquet(topic.name).withColumn("topic", F.lit(topic.name)).select(*COLUMNS)


def stream_topic(spark: SparkSession, topic: Topic, limits: dict[str, str] | None = None) -> DataFrame:
    """The topic as a stream from the earliest offset. ``limits`` are the source's rate options."""
    if topic.on_kafka:
        reader = spark.readStream.format("kafka").options(**topic.options).option("subscribe", topic.name)
        return reader.option("startingOffsets", "earliest").options(**(limits or {})).load().select(*COLUMNS)
    reader = spark.readStream.schema(TOPIC_RECORD).options(**(limits or {}))
    return reader.parquet(topic.name).withColumn("topic", F.lit(topic.name)).select(*COLUMNS)


def produce(messages: DataFrame, topic: Topic, order: list[str], order_is_unique: bool = True) -> int:
    """Append ``messages`` (key, value and optionally partition, timestamp); return how many.

    Messages of one key share a partition and keep ``order``; unkeyed ones spread by a hash of
    their place in the order. Offsets stay dense per partition and continue from the last ones,
    numbered without pulling a partition into one task.
    """
    spark = messages.sparkSession
    delivered = Observation()
    counter = F.count(F.lit(1)).alias("messages")
    if topic.on_kafka:
        present = [name for name in ("key", "value", "partition", "timestamp") if name in messages.columns]
        writer = messages.select(*present).observe(delivered, counter).write.format("kafka")
        writer.options(**topic.options).option("topic", topic.name).save()
        return delivered.get["messages"]

    if "partition" not in messages.columns:
        place_by = F.coalesce(F.col("key").cast("string"), F.concat_ws("|", *order))
        messages = messages.withColumn("partition", partition_of(place_by, topic.partitions))
    if "timestamp" not in messages.columns:
        messages = messages.withColumn("timestamp", F.current_timestamp())
    by = [F.col(name).asc_nulls_first() for name in order]
    numbered = number_within(messages, ["partition"], by, "_n", order_is_unique=order_is_unique)
    highs = watermarks(spark, topic).select("partition", "high")  # a row a partition; Spark picks the join
    records = numbered.join(highs, "partition", "left").withColumn(
        "offset", F.coalesce(F.col("high"), F.lit(0)) + F.col("_n") - 1,
    )
    typed = records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TOPIC_RECORD.fields])
    typed.observe(delivered, counter).write.mode("append").parquet(topic.name)
    return delivered.get["messages"]


def peek(spark: SparkSession, topic: Topic, n: int) -> DataFrame:
    """The first ``n`` messages by (partition, offset); no reader position moves.

    Only the first ``n`` offsets of each partition can be among them; the others go before the sort.
    """
    messages = read_topic(spark, topic)
    lows = watermarks(spark, topic).select("partition", "low")
    near = messages.join(lows, "partition").where(F.col("offset") < F.col("low") + n).select(*COLUMNS)
    return near.orderBy("partition", "offset").limit(n)


def watermarks(spark: SparkSession, topic: Topic) -> DataFrame:
    """Low and high (next) offset per partition."""
    return read_topic(spark, topic).groupBy("partition").agg(
        F.min("offset").alias("low"),
        (F.max("offset") + 1).alias("high"),
    )


def topic_size(spark: SparkSession, topic: Topic) -> DataFrame:
    """``ever``: messages ever written (sum of highs). ``held``: messages still there."""
    return watermarks(spark, topic).agg(
        F.coalesce(F.sum("high"), F.lit(0)).alias("ever"),
        F.coalesce(F.sum(F.col("high") - F.col("low")), F.lit(0)).alias("held"),
    )
