"""Registered queries over topics and streams."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.functions.fixed_values import RAW_MAX_RECORDS, RAW_MIN_RECORDS, STREAM_SOURCE
from tarnworks.functions.messages import decode_event
from tarnworks.operators.conform import with_lineage
from tarnworks.operators.marts import latest_event
from tarnworks.operators.reconcile import require
from tarnworks.plans import event_stream, event_topic, inputs
from tarnworks.schemas import SALES_EVENTS
from tarnworks.sources import topic as topics
from tarnworks.streaming import ingest, raw_landing
from tarnworks.streaming.runs import together
from tarnworks.streaming.versioned_sink import ingest_versions
from tarnworks.tables.versioned import VersionedTable
from tarnworks.workspace import fresh_dir, fresh_name

# Events before this moment arrive first, the others in a second delivery.
SECOND_DELIVERY = "2024-01-15 00:00:00"


def early():
    return F.col("ts") < F.lit(SECOND_DELIVERY).cast("timestamp")


def new_events_table(spark: SparkSession, label: str = "streamed") -> ingest.EventTable:
    return ingest.EventTable(spark, fresh_name(label), "sales_events", fresh_dir(spark, label))


def ingested(spark: SparkSession, records: DataFrame) -> ingest.EventTable:
    """A new table with all the stream has."""
    table = new_events_table(spark)
    ingest.ingest(records, table)
    return table


def streamed_table(spark: SparkSession, sf_dir: str) -> ingest.EventTable:
    """All events, produced to a topic and streamed from it with the places they took there."""
    return ingested(spark, topics.stream_topic(spark, event_topic.filled_topic(spark, sf_dir)))


def spoilt_table(spark: SparkSession, sf_dir: str) -> ingest.EventTable:
    """Events of which some are malformed, streamed from where they lie."""
    return ingested(spark, event_stream.arrived(spark, sf_dir, event_stream.with_spoilt_values).stream(spark))


def two_deliveries(spark: SparkSession, sf_dir: str) -> ingest.EventTable:
    """Deliver, ingest, ingest again with nothing new, deliver the rest, ingest.

    The first delivery ends before the first event of the second one's time: a topic takes messages in their order.
    """
    topic, table = event_topic.new_topic(spark), new_events_table(spark)
    first = inputs.sales_events(spark, sf_dir).where(~early()).agg(F.min("kafka_offset")).first()[0]
    begun = F.lit(False) if first is None else F.col("kafka_offset") >= first
    event_topic.deliver(spark, sf_dir, topic, ~begun)
    ingest.ingest(topics.stream_topic(spark, topic), table)
    ingest.ingest(topics.stream_topic(spark, topic), table)
    event_topic.deliver(spark, sf_dir, topic, begun)
    ingest.ingest(topics.stream_topic(spark, topic), table)
    return table


def versions_of_two_deliveries(spark: SparkSession, sf_dir: str) -> VersionedTable:
    topic, table = event_topic.new_topic(spark), VersionedTable(spark, fresh_dir(spark, "streamed"))
    checkpoint = fresh_dir(spark, "checkpoint")
    for part in (early(), ~early()):
        event_topic.deliver(spark, sf_dir, topic, part)
        ingest_versions(spark, topic, table, checkpoint)
    return table


def topic_peek(spark, sf_dir):
    first = topics.peek(spark, event_topic.filled_topic(spark, sf_dir), 3)
    return first.select("partition", "offset", F.col("key").cast("string").alias("key"),
                        decode_event(F.col("value")).alias("e")).select("partition", "offset", "key", "e.*")


def topic_watermarks(spark, sf_dir):
    marks = topics.watermarks(spark, event_topic.filled_topic(spark, sf_dir))
    return marks.withColumn("held", F.col("high") - F.col("low"))


def topic_produce(spark, sf_dir):
    """Messages placed by key: rows with their topic position."""
    topic = event_topic.new_topic(spark)
    events = inputs.sales_events(spark, sf_dir)
    topics.produce(event_topic.messages(events, placed=False), topic, ["kafka_offset"])
    return ingest.parse_events(topics.read_topic(spark, topic))


def topic_produce_unkeyed(spark, sf_dir):
    topic = event_topic.new_topic(spark)
    events = inputs.sales_events(spark, sf_dir)
    delivered = topics.produce(event_topic.messages(events, keyed=False, placed=False), topic, ["kafka_offset"])
    held = topics.topic_size(spark, topic)
    stored = topics.read_topic(spark, topic).agg(
        F.count("*").alias("messages"), F.count("key").alias("keyed"),
        (F.max("offset") + 1 < F.count("*")).alias("spread"),
    )
    size = held.first()["held"]
    return stored.select("messages", "keyed", "spread", F.lit(delivered).cast("bigint").alias("delivered"),
                         (F.lit(size) - F.col("messages")).alias("offset_gaps"))


def parse_events(spark, sf_dir):
    return ingest.parse_events(topics.read_topic(spark, event_topic.filled_topic(spark, sf_dir)))


def stream_incremental(spark, sf_dir):
    return two_deliveries(spark, sf_dir).read()


def stream_quarantine(spark, sf_dir):
    """The text of messages that aren't JSON, and where they came from."""
    return spoilt_table(spark, sf_dir).quarantine()


def message_quality(spark, sf_dir):
    """Good and malformed messages of each topic partition."""
    return spoilt_table(spark, sf_dir).message_counts()


def snapshot_summary(spark, sf_dir):
    history = versions_of_two_deliveries(spark, sf_dir).history()

    def counter(name: str):
        return F.try_element_at("summary", F.lit(name)).cast("bigint")

    return history.where("operation = 'append'").select(
        "operation", counter("added-records").alias("added_records"), counter("total-records").alias("total_records"),
    )


def stream_two_readers(spark, sf_dir):
    """Each reader keeps its own position: one has read the first delivery when both are run, side by side, for the rest."""
    box = event_stream.inbox(spark, sf_dir)
    tables = {name: new_events_table(spark, name) for name in ("eager", "late")}
    event_stream.deliver(spark, sf_dir, box, early())
    ingest.ingest(box.stream(spark), tables["eager"])
    event_stream.deliver(spark, sf_dir, box, ~early())
    together(spark, {name: partial(_start, spark, box, table) for name, table in tables.items()})
    rows = [
        table.read().agg(F.lit(name).alias("reader"), F.count("*").alias("rows_cnt"), F.count("id").alias("ids_cnt"))
        for name, table in tables.items()
    ]
    return rows[0].unionByName(rows[1])


def _start(spark, box, table):
    return table.start(ingest.parse_events(box.stream(spark), audit=True))


def pumped(spark, sf_dir) -> DataFrame:
    table = ingest.sorted_events(spark, fresh_name("pumped"), "sales_events", fresh_dir(spark, "pumped"))
    ingest.pump(event_stream.arrived(spark, sf_dir).stream(spark), table)
    return table.read()


def raw_json_landing(spark, sf_dir):
    folder = fresh_dir(spark, "raw")
    raw_landing.land_raw(event_stream.arrived(spark, sf_dir).stream(spark), folder, fresh_dir(spark, "checkpoint"))
    lines = raw_landing.read_raw(spark, folder)
    return lines.select(decode_event(F.col("value")).alias("e")).select("e.*")


def raw_object_sizes(spark, sf_dir):
    """Lines that were landed, and whether every object keeps to the limits."""
    folder = fresh_dir(spark, "raw")
    raw_landing.land_raw(event_stream.arrived(spark, sf_dir).stream(spark), folder, fresh_dir(spark, "checkpoint"))
    sizes = spark.read.text(folder).groupBy(F.input_file_name().alias("object")).agg(F.count("*").alias("lines"))
    return sizes.agg(
        F.sum("lines").alias("lines_cnt"), (F.max("lines") <= RAW_MAX_RECORDS).alias("none_above"),
        ((F.min("lines") >= RAW_MIN_RECORDS) | (F.count("*") == 1)).alias("none_below"),
    )


def verify_stream_counts(spark, sf_dir):
    return ingest.verify_counts(two_deliveries(spark, sf_dir))


def stream_flow(spark, sf_dir):
    """Deliver, ingest, verify; raises when the counts differ. Returns events per region."""
    box, table = event_stream.inbox(spark, sf_dir), new_events_table(spark)
    delivered = event_stream.deliver(spark, sf_dir, box, F.lit(True))
    ingest.ingest(box.stream(spark), table)
    require(ingest.verify_counts(table, delivered=delivered))
    return table.read().groupBy("region").agg(F.count("*").alias("rows_cnt"), F.max("ts").alias("latest_ts"))


def landing_events(spark, sf_dir):
    """The streamed table, found by its name in the catalog, with lineage columns."""
    named = spark.table(streamed_table(spark, sf_dir).name).select(*SALES_EVENTS.names)
    return with_lineage(named, STREAM_SOURCE, inputs.loaded_at())


QUERIES = {
    "topic_peek": topic_peek,
    "topic_watermarks": topic_watermarks,
    "topic_produce": topic_produce,
    "topic_produce_unkeyed": topic_produce_unkeyed,
    "parse_events": parse_events,
    "stream_ingest": lambda spark, d: streamed_table(spark, d).read(),
    "stream_incremental": stream_incremental,
    "stream_two_readers": stream_two_readers,
    "stream_mv_pump": pumped,
    "stream_latest": lambda spark, d: latest_event(pumped(spark, d)),
    "raw_json_landing": raw_json_landing,
    "raw_object_sizes": raw_object_sizes,
    "stream_quarantine": stream_quarantine,
    "message_quality": message_quality,
    "verify_stream_counts": verify_stream_counts,
    "snapshot_summary": snapshot_summary,
    "stream_flow": stream_flow,
    "landing_events": landing_events,
}
