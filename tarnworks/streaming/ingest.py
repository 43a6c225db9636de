"""Messages to tables, exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tarnworks.functions.messages import decode_event
from tarnworks.functions.times import to_second
from tarnworks.operators.reconcile import Check, run_checks
from tarnworks.schemas import EVENT_VALUE, SALES_EVENTS
from tarnworks.tables.streamed import SortedBatches, StreamedTable

CORRUPT = "_corrupt"
AUDITED_EVENTS = T.StructType([*SALES_EVENTS.fields, T.StructField(CORRUPT, T.StringType())])


def parse_events(records: DataFrame, audit: bool = False) -> DataFrame:
    """Typed event columns plus where each message came from. No message is dropped: one that isn't JSON, or has a
    field of another type, keeps its position and what could be read. ``audit`` adds the text of such messages."""
    event = decode_event(F.col("value"), corrupt_column=CORRUPT if audit else None)
    fields = {field.name: F.col(f"_event.{field.name}") for field in EVENT_VALUE.fields}
    position = {name: F.col(name.removeprefix("kafka_")) for name in SALES_EVENTS.names if name not in fields}
    corrupt = {CORRUPT: F.col(f"_event.{CORRUPT}")} if audit else {}
    read = {**fields, **position, **corrupt}
    return records.withColumn("_event", event).select(*[column.alias(name) for name, column in read.items()])


class EventTable(StreamedTable):
    """Streamed events, and in the same pass the text of the malformed ones: ``read`` gives every message a row,
    ``quarantine`` the malformed messages, ``message_counts`` both kinds by topic partition."""

    def __init__(self, spark, database: str, name: str, root: str):
        super().__init__(spark, database, name, root, AUDITED_EVENTS)

    def read(self) -> DataFrame:
        return super().read().select(*SALES_EVENTS.names)

    def quarantine(self) -> DataFrame:
        return super().read().where(F.col(CORRUPT).isNotNull()).select("kafka_partition", "kafka_offset", F.col(CORRUPT).alias("message"))

    def message_counts(self) -> DataFrame:
        return super().read().groupBy("kafka_partition").agg(
            F.count("*").alias("messages"), F.count_if(F.col(CORRUPT).isNull()).alias("good"), F.count(CORRUPT).alias("malformed"),
        )


def ingest(records: DataFrame, table: EventTable, timeout: float | None = None) -> StreamingQuery:
    """Append the events that arrived since the last run."""
    return table.append(parse_events(records, audit=True), timeout)


def sorted_events(spark, database: str, name: str, root: str) -> SortedBatches:
    """A table for ``pump``, in the order of (region, ts)."""
    return SortedBatches(spark, database, name, root, EVENT_VALUE, ["region", "ts"])


def pump(records: DataFrame, table: SortedBatches, timeout: float | None = None) -> StreamingQuery:
    """Keep a sorted copy of the messages: whole-second times, rows ordered by (region, ts) batch by batch."""
    events = parse_events(records).select(*EVENT_VALUE.names).withColumn("ts", to_second(F.col("ts")))
    return table.append(events, timeout)


def verify_counts(table: StreamedTable | SortedBatches, source: DataFrame | None = None, delivered: int | None = None) -> DataFrame:
    """Messages read, by the query's own progress, against rows in the table, and against messages delivered where that is
    known. ``source``, the messages as a batch, is counted only when progress was lost with a driver."""
    spark = table.spark
    read = table.read_log.messages()
    if read is None and source is None:
        raise ValueError(f"the progress of {table.name} has gaps; give the source to count")
    total = source.agg(F.count("*").alias("messages")) if read is None else _one(spark, read)
    checks = [Check("topic_equals_table", total, table.read().agg(F.count("*").alias("rows_cnt")))]
    if delivered is not None:
        checks.append(Check("delivered_equals_read", _one(spark, delivered), total))
    return run_checks(checks)


def _one(spark, value: int) -> DataFrame:
    return spark.range(1).select(F.lit(value).cast("bigint").alias("v"))
