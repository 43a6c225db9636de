"""What a streaming query has read, by its own account: a row for each micro-batch, from the query's progress reports.

A check of messages against rows then needs no second look at the source. Progress is reported after a batch is
committed, so a driver lost in between leaves a batch out: the numbers have a gap, or a batch that was committed but not reported
is reported as empty when the next run skips it. ``messages`` knows both cases and gives None, and the caller counts the source.
Rows count as often as a batch is read, so sinks must read it once, without sampling it or scanning it again.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tarnworks.sources import filesystem as fs

SCHEMA = "batch_id bigint, rows bigint, ends bigint"
REPORT_SECONDS = 60


class UnreportedRun(RuntimeError):
    """The session didn't report the end of a query in time."""


def end_offsets(offset: str | None) -> int | None:
    """Sum of a topic's end offsets, one for each partition; None for sources that count otherwise."""
    held = json.loads(offset) if offset else None
    if not isinstance(held, dict) or not held or not all(isinstance(v, dict) for v in held.values()):
        return None
    return sum(int(end) for partitions in held.values() for end in partitions.values())


class _Follower(StreamingQueryListener):
    """Batches of the queries that start while it listens; a row a batch is all that stays in memory."""

    def __init__(self):
        self.batches: dict[str, list[tuple[int, int, int | None]]] = {}
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if "addBatch" not in progress.durationMs:  # nothing was there to read
            return
        ends = [end_offsets(source.endOffset) for source in progress.sources]
        total = sum(ends) if ends and None not in ends else None
        self.batches.setdefault(str(progress.runId), []).append((progress.batchId, progress.numInputRows, total))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()


class ReadLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @contextmanager
    def following(self) -> Iterator[list]:
        """Queries put into the list that this yields are recorded, once they have ended."""
        follower, queries = _Follower(), []
        self.spark.streams.addListener(follower)
        try:
            yield queries
        finally:
            try:
                for query in queries:
                    if not follower.ended.setdefault(str(query.runId), threading.Event()).wait(REPORT_SECONDS):
                        raise UnreportedRun(f"no report of run {query.runId}")
            finally:
                self.spark.streams.removeListener(follower)
                rows = [row for query in queries for row in follower.batches.get(str(query.runId), [])]
                if rows:
                    self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def messages(self) -> int | None:
        """Messages read so far: the topic's end offsets where the source has them, else the rows of all batches."""
        if not fs.exists(self.spark, self.folder):
            return 0
        each = self.spark.read.schema(SCHEMA).parquet(self.folder).groupBy("batch_id").agg(
            F.max("rows").alias("rows"), F.max("ends").alias("ends"),
        )
        known = each.agg(
            F.count("*").alias("batches"), F.max("batch_id").alias("last"), F.sum("rows").alias("rows"),
            F.count_if(F.col("rows") == 0).alias("empty"), F.max("ends").alias("ends"), F.count("ends").alias("with_ends"),
        ).first()
        if known["with_ends"] and known["with_ends"] == known["batches"]:
            return known["ends"]  # the last batch's say it all
        return known["rows"] if known["batches"] == known["last"] + 1 and not known["empty"] else None
