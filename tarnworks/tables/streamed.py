"""Catalog tables that streaming queries fill.

``StreamedTable`` takes Spark's own file sink, whose commit log lists the files of every finished micro-batch: a query that is killed and
started again adds nothing twice and nothing is lost, and readers of the table see finished batches only. ``SortedBatches``
has a partition for each micro-batch, which a replay overwrites.

Both own the checkpoint of the one query that writes them. Batches are known by number, so a second query with a checkpoint of
its own would count from zero again; it takes a table of its own instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tarnworks.sources import filesystem as fs
from tarnworks.streaming.read_log import ReadLog
from tarnworks.streaming.runs import wait

BATCH = "_batch"


class _Filled:
    def __init__(self, spark: SparkSession, database: str, name: str, root: str, schema: T.StructType):
        self.spark = spark
        self.database = database
        self.name = f"`{database}`.`{name}`"
        self.schema = schema
        self.root = fs.qualified(spark, root)
        self.folder = f"{self.root}/{name}"
        self.checkpoint = f"{self.root}/_progress/{name}/checkpoint"
        self.read_log = ReadLog(spark, f"{self.root}/_progress/{name}/read")

    def exists(self) -> bool:
        return self.spark.catalog.databaseExists(self.database) and self.spark.catalog.tableExists(self.name)

    def _database(self) -> None:
        location = self.root.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{location}'")

    def _typed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])

    def start(self, rows: DataFrame) -> StreamingQuery:
        raise NotImplementedError

    def append(self, rows: DataFrame, timeout: float | None = None) -> StreamingQuery:
        """Add what the stream ``rows`` has now, from where the last run ended, and record how much that was."""
        with self.read_log.following() as queries:
            queries.append(self.start(rows))
            return wait(queries[0], timeout)


class StreamedTable(_Filled):
    def create(self) -> StreamedTable:
        """Declare the table; does nothing when it is there."""
        if not self.exists():
            self._database()
            self.spark.catalog.createTable(self.name, path=self.folder, source="parquet", schema=self.schema)
        return self

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def start(self, rows: DataFrame) -> StreamingQuery:
        self.create()
        writer = self._typed(rows).writeStream.outputMode("append").option("checkpointLocation", self.checkpoint)
        return writer.trigger(availableNow=True).toTable(self.name)


class SortedBatches(_Filled):
    """Every file of a batch is in the order of ``order``; a batch is read once and not shuffled."""

    def __init__(self, spark: SparkSession, database: str, name: str, root: str, schema: T.StructType, order: list[str]):
        super().__init__(spark, database, name, root, schema)
        self.order = order

    def create(self) -> SortedBatches:
        if not self.exists():
            self._database()
            fields = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
            empty = self.spark.createDataFrame([], fields).write.partitionBy(BATCH)
            empty.option("partitionOverwriteMode", "dynamic").option("path", self.folder).saveAsTable(self.name)
        return self

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).drop(BATCH)

    def write(self, batch: DataFrame, number: int) -> None:
        """Put a batch into its partition, in place of whatever an earlier attempt left there."""
        laid = self._typed(batch).withColumn(BATCH, F.lit(number).cast("bigint")).sortWithinPartitions(BATCH, *self.order)
        laid.write.insertInto(self.name, overwrite=True)

    def start(self, rows: DataFrame) -> StreamingQuery:
        self.create()
        writer = rows.writeStream.outputMode("append").option("checkpointLocation", self.checkpoint)
        return writer.trigger(availableNow=True).foreachBatch(self.write).start()
