"""Message values as JSON lines, one text object per batch of records."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tarnworks.functions.fixed_values import RAW_MAX_DELAY, RAW_MAX_RECORDS, RAW_MIN_RECORDS
from tarnworks.operators.numbering import number_within
from tarnworks.streaming.runs import wait

OBJECTS_AT_ONCE = 10_000


def admission(
    min_records: int = RAW_MIN_RECORDS, max_records: int = RAW_MAX_RECORDS, max_delay: str = RAW_MAX_DELAY,
    objects_at_once: int = OBJECTS_AT_ONCE,
) -> dict[str, str]:
    """Rate options of a Kafka source: a batch starts when it can fill an object, or after the delay, and holds many
    objects at most. A source of files has no such options; its batches are paced by the trigger."""
    return {
        "minOffsetsPerTrigger": str(min_records), "maxTriggerDelay": max_delay,
        "maxOffsetsPerTrigger": str(max_records * objects_at_once),
    }


def into_objects(lines: DataFrame, order: list[str], min_records: int, max_records: int) -> DataFrame:
    """(object, value): lines joined into objects of equal size, in ``order``, none above the maximum.

    As few objects as there can be hold more than half the maximum each, so none is below the minimum unless all lines
    together are. Lines are numbered from range-sorted chunks; an object's lines are all that ever meet in one task.
    """
    if max_records < 2 * min_records:
        raise ValueError("the maximum must be at least twice the minimum")
    numbered = number_within(lines.withColumn("_all", F.lit(0)), ["_all"], [F.col(c).asc_nulls_first() for c in order], "_n", order_is_unique=True)
    rows = numbered.agg(F.max("_n")).first()[0] or 0
    objects = max(1, math.ceil(rows / max_records))
    place = F.call_function("div", (F.col("_n") - 1).cast("decimal(38,0)") * objects, F.lit(max(rows, 1)).cast("decimal(38,0)"))
    held = F.array_sort(F.collect_list(F.struct("_n", F.coalesce("value", F.lit("")).alias("value"))))
    return numbered.groupBy(place.alias("object")).agg(F.array_join(F.transform(held, lambda line: line["value"]), "\n").alias("value"))


def land_raw(
    records: DataFrame, folder: str, checkpoint: str, min_records: int = RAW_MIN_RECORDS, max_records: int = RAW_MAX_RECORDS,
    trigger: dict | None = None, timeout: float | None = None,
) -> StreamingQuery:
    """Write the values, without keys, as text objects of ``min_records`` to ``max_records`` lines where there are so many.

    Takes what is there, unless ``trigger`` says otherwise: ``{"processingTime": RAW_MAX_DELAY}`` lands what has arrived every half
    minute and returns the running query. A batch has a folder of its own, which a replay writes anew; a failed write fails the
    batch, so no message is lost or doubled.
    """
    def write(batch: DataFrame, number: int) -> None:
        lines = batch.select("partition", "offset", F.col("value").cast("string").alias("value"))
        objects = into_objects(lines, ["partition", "offset"], min_records, max_records).select("value")
        objects.write.mode("overwrite").option("maxRecordsPerFile", "1").text(f"{folder}/batch={number}")

    writer = records.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    query = writer.trigger(**(trigger or {"availableNow": True})).start()
    return query if trigger else wait(query, timeout)


def read_raw(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.text(folder).select("value")
