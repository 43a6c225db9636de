"""Running streaming queries to the end of what is there: one, or several at once."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

POOL = "spark.scheduler.pool"


class StreamTimeout(RuntimeError):
    """The backlog was not read in time."""


def wait(query: StreamingQuery, timeout: float | None = None) -> StreamingQuery:
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise StreamTimeout(f"no end after {timeout} s")
    return query


def drain(writer: DataStreamWriter, checkpoint: str, timeout: float | None = None) -> StreamingQuery:
    """Read what is there now, then stop. The checkpoint makes the next run start where this ended."""
    return wait(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(), timeout)


def together(
    spark: SparkSession, readers: Mapping[str, Callable[[], StreamingQuery]], attempts: int = 2, timeout: float | None = None,
) -> dict[str, list[StreamingQuery]]:
    """Start a query of each reader, side by side, and wait for all; returns each reader's runs.

    Every reader has a scheduler pool of its own name, so that under ``spark.scheduler.mode=FAIR`` a long batch of one
    leaves the others their share of the executors. A run that fails is started again from its checkpoint, up to
    ``attempts`` runs, while the others go on. The last failure is raised after all have ended.
    """
    runs: dict[str, list[StreamingQuery]] = {name: [] for name in readers}
    failures: dict[str, Exception] = {}
    waiting = list(readers)
    before = spark.sparkContext.getLocalProperty(POOL)
    try:
        for _ in range(attempts):
            failures = {}
            for name in waiting:
                spark.sparkContext.setLocalProperty(POOL, name)  # a query keeps the pool of the thread that starts it
                try:
                    runs[name].append(readers[name]())
                except Exception as failure:
                    failures[name] = failure
            for name in waiting:
                if name not in failures:
                    try:
                        wait(runs[name][-1], timeout)
                    except Exception as failure:
                        failures[name] = failure
            waiting = list(failures)
            if not waiting:
                return runs
    finally:
        spark.sparkContext.setLocalProperty(POOL, before)
    raise next(iter(failures.values()))
