"""Streams into versioned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tarnworks.schemas import SALES_EVENTS
from tarnworks.sources.topic import Topic, stream_topic
from tarnworks.streaming.ingest import parse_events
from tarnworks.streaming.runs import drain
from tarnworks.tables.versioned import VersionedTable


def table_sink(table: VersionedTable):
    """A foreachBatch function that appends each micro-batch once.

    The table remembers the last batch of every query, so a batch replayed after a crash between
    the table commit and the checkpoint commit is skipped.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query is None:
            raise RuntimeError("the micro-batch does not name its query")
        table.append(batch, writer=(query, batch_id))

    return write


def ingest_versions(
    spark: SparkSession, topic: Topic, table: VersionedTable, checkpoint: str, limits: dict[str, str] | None = None,
    timeout: float | None = None,
) -> StreamingQuery:
    """Append the events that arrived since the last run, a version for each micro-batch."""
    table.create(SALES_EVENTS)
    events = parse_events(stream_topic(spark, topic, limits))
    return drain(events.writeStream.outputMode("append").foreachBatch(table_sink(table)), checkpoint, timeout)
