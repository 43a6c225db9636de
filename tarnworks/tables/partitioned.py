"""MERGE and DELETE on a catalog table: only partitions that hold a matching row are written again.

The partitions to rewrite are found by a join and handed on as a small staged table, which prunes the second scan while
it runs. Spark's dynamic partition overwrite replaces them when the job commits, so a job that loses executors, or fails,
leaves the old rows. Expects one writer at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.sources import filesystem as fs
from tarnworks.workspace import fresh_dir

PART = "_part"
TARGET_FILE_BYTES = 512 * 1024 * 1024
MOST_TASKS = 20_000  # beyond it a task writes several files


class RepeatedKeys(ValueError):
    """Two updates would change the same row."""


class PartitionedTable:
    """A managed Parquet table, partitioned by the text of an expression over its own columns.

    The expression must be deterministic; NULL becomes the partition ``none``. Rows spread over several
    files where a partition is large. A column of the rows may not be called ``_part``.
    """

    def __init__(self, spark: SparkSession, database: str, name: str, root: str, part: Column, part_of: list[str]):
        self.spark = spark
        self.database = database
        self.name = f"`{database}`.`{name}`"
        self.root = fs.qualified(spark, root)
        self.part = F.coalesce(part.cast("string"), F.lit("none"))
        self.part_of = part_of  # the columns that the expression reads

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(PART)

    def create(self, df: DataFrame) -> PartitionedTable:
        """Write the first rows."""
        if PART in df.columns:
            raise ValueError(f"{PART} is the name of the partition column")
        location = self.root.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{location}'")
        self._arranged(df).write.partitionBy(PART).option("partitionOverwriteMode", "dynamic").saveAsTable(self.name)
        return self

    def append(self, df: DataFrame) -> PartitionedTable:
        """Add rows as new files of their partitions."""
        columns = self.read().columns
        self._arranged(df.select(*columns)).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        return self

    def files(self) -> DataFrame:
        """(_part, path, bytes) of every file; the files are listed, not read."""
        place = self.spark.sql(f"DESCRIBE EXTENDED {self.name}").where("col_name = 'Location'").first()["data_type"]
        listed = self.spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter="*.parquet").load(place)
        part = F.regexp_extract("path", rf"/{PART}=([^/]*)/[^/]*$", 1)
        plain = F.url_decode(F.replace(part, F.lit("+"), F.lit("%2B")))
        return listed.select(plain.alias(PART), "path", F.col("length").alias("bytes"))

    def compact(self, target_bytes: int = TARGET_FILE_BYTES, min_input_files: int = 5) -> int:
        """Write partitions of many small files anew in files near the target size; returns how many partitions.

        A partition is written again if it has ``min_input_files`` or more and at most half as many will do, so a second run
        finds nothing to do. Rows are dealt by their place, which parts copies of a row as well as others. Partitions replace
        each other when the job commits.
        """
        with _Staging(self.spark, "compact") as staged:
            wanted = F.greatest(F.ceil(F.sum("bytes") / target_bytes), F.lit(1)).alias("wanted")
            crowded = staged.write(
                self.files().groupBy(PART).agg(F.count("*").alias("n"), wanted)
                .where((F.col("n") >= min_input_files) & (F.col("wanted") * 2 <= F.col("n"))).select(PART, "wanted"), "crowded",
            )
            count, total = crowded.agg(F.count("*"), F.sum("wanted")).first()
            if count:
                rows = self.spark.table(self.name)
                place = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("_place")
                dealt = rows.select(*rows.columns, place).join(crowded, PART).withColumn("_slot", F.pmod("_place", "wanted"))
                # a given number of tasks, for small ones that are put together would write fewer files
                dealt.repartition(min(total, MOST_TASKS), PART, "_slot").select(*rows.columns).write.insertInto(self.name, overwrite=True)
                self.spark.catalog.refreshTable(self.name)
            return count

    def merge(self, updates: DataFrame, on: list[str], set_columns: list[str], insert_columns: list[str] | None = None) -> None:
        """Update matched rows and insert the others with the given columns, the rest NULL.

        NULL keys never match, so such updates are inserted. A key repeated in ``updates`` is an error, a key repeated in
        the table is updated in every row. Columns that decide the partition can't be set.
        """
        if set(set_columns) & set(self.part_of):
            raise ValueError(f"{self.part_of} decide the partition and stay as they are")
        insert_columns = insert_columns or updates.columns
        with _Staging(self.spark, "merge") as staged:
            updates = staged.write(updates, "updates")
            known = updates.dropna(subset=on)
            if not known.groupBy(*on).count().where("count > 1").isEmpty():
                raise RepeatedKeys(f"updates repeat a value of {on}")
            rows = self.spark.table(self.name)
            # combined in the tasks that find the matches: a key repeated in the table stays small
            matches = staged.write(rows.join(known.select(*on), on, "left_semi").select(*on, PART).distinct(), "matches")
            fields = [f for f in rows.schema.fields if f.name != PART]
            fresh = updates.join(matches.select(*on), on, "left_anti").select(*[
                (F.col(f.name) if f.name in insert_columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
            ])
            touched = staged.write(_counted(matches.select(PART).union(fresh.select(self.part))), "touched")
            # a left join, whose table side Spark can split where a key is hot
            change = known.select(
                *[F.col(c).alias(f"_key{i}") for i, c in enumerate(on)],
                *[F.col(c).alias(f"_new{i}") for i, c in enumerate(set_columns)], F.lit(True).alias("_changed"),
            )
            same = [rows[c] == F.col(f"_key{i}") for i, c in enumerate(on)]
            new = {c: f"_new{i}" for i, c in enumerate(set_columns)}
            old = rows.join(touched.where("hits > 0").select(PART), PART, "left_semi").join(change, same, "left").select(*[
                F.when(F.col("_changed"), F.col(new[f.name]).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
                if f.name in new else F.col(f.name) for f in fields
            ])
            self._replace(old.unionByName(fresh))

    def delete(self, predicate: Column) -> None:
        """Remove matching rows; rows where the predicate is NULL stay."""
        hit = F.coalesce(predicate, F.lit(False))
        with _Staging(self.spark, "delete") as staged:
            rows = self.spark.table(self.name)
            counts = staged.write(rows.groupBy(PART).agg(F.count_if(hit).alias("hits"), F.count("*").alias("n")), "touched")
            some = counts.where("hits > 0 and hits < n").select(PART)
            self._replace(rows.join(some, PART, "left_semi").where(~hit).drop(PART))
            # an overwrite leaves partitions without new rows alone; catalog entries, not rows, pass the driver
            for whole in counts.where("hits = n").select(PART).collect():
                value = whole[0].replace("\\", "\\\\").replace("'", "\\'")
                self.spark.sql(f"ALTER TABLE {self.name} DROP PARTITION (`{PART}` = '{value}')")

    def _arranged(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PART, self.part).hint("rebalance", PART)

    def _replace(self, df: DataFrame) -> None:
        self._arranged(df).write.insertInto(self.name, overwrite=True)
        self.spark.catalog.refreshTable(self.name)


class DayTable(PartitionedTable):
    """Rows lie by the day of a timestamp column; a span of time opens the files of its days only."""

    def __init__(self, spark: SparkSession, database: str, name: str, root: str, ts: str):
        super().__init__(spark, database, name, root, F.to_date(ts), [ts])
        self.ts = ts

    def between(self, low: str, high: str) -> DataFrame:
        """Rows with low <= ts < high."""
        start, end = (F.lit(bound).cast("timestamp") for bound in (low, high))
        days = F.col(PART).between(F.to_date(start).cast("string"), F.to_date(end).cast("string"))
        ts = F.col(self.ts)
        return self.spark.table(self.name).where(days & (ts >= start) & (ts < end)).drop(PART)


class _Staging:
    """Intermediate tables in the shared folder, removed when the change is done."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = fresh_dir(spark, label)

    def __enter__(self) -> _Staging:
        return self

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __exit__(self, *failure) -> None:
        fs.delete(self.spark, self.root, recursive=True)


def _counted(parts: DataFrame) -> DataFrame:
    return parts.toDF(PART).groupBy(PART).agg(F.count("*").alias("hits"))
