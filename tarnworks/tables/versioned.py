"""A Parquet table with snapshots.

Layout under the table root::

    data/__commit=<id>/[k=v/]*.parquet   rows
    deletes/__commit=<id>/*.parquet      deleted positions (file_path, row_index)
    meta/<id>/                         file lists of partly live commits
    _log/<version>.json                snapshot headers

Rows are only ever written by Spark jobs into a folder of their own; a version becomes visible
when its header is created. Old files stay until snapshots are expired, so readers of earlier
versions are never disturbed.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnworks.sources import filesystem as fs
from tarnworks.tables.snapshot import FILE_LIST, Snapshot, SnapshotLog, new_snapshot_id, now

FILE, ROW = "__located_file", "__located_row"
POSITIONS = T.StructType([
    T.StructField("file_path", T.StringType()),
    T.StructField("row_index", T.LongType()),
])
# path inside the table, taken from a full file URI
RELATIVE = r"((?:data|deletes)/__commit=[0-9a-f]{32}/.*)$"
COMMIT_FOLDER = r"^((?:data|deletes)/__commit=[0-9a-f]{32})/"


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = fs.qualified(spark, root)
        self.log = SnapshotLog(spark, self.root)

    # ---- create and look up -------------------------------------------------

    def exists(self) -> bool:
        return bool(self.log.versions())

    def create(self, schema: T.StructType, partition_by: list[str] | None = None) -> VersionedTable:
        """Declare an empty table; does nothing when the table is there."""
        if not self.exists():
            self.log.commit(Snapshot(
                version=0, snapshot_id=new_snapshot_id(), parent=None, committed_at=now(),
                operation="create", schema=_nullable(schema).jsonValue(),
                partition_by=partition_by or [], summary=_summary(0, 0),
            ))
        return self

    def snapshot(self, version: int | None = None, snapshot_id: int | None = None) -> Snapshot:
        if snapshot_id is not None:
            found = [s for s in self.log.all() if s.snapshot_id == snapshot_id]
            if not found:
                raise LookupError(f"no snapshot {snapshot_id} in {self.root}")
            return found[0]
        if version is not None:
            return self.log.load(version)
        latest = self.log.latest()
        if latest is None:
            raise LookupError(f"no table at {self.root}")
        return latest

    # ---- read ---------------------------------------------------------------

    def read(self, version: int | None = None, snapshot_id: int | None = None) -> DataFrame:
        """Rows of a version, the latest by default."""
        return self.scan(self.snapshot(version, snapshot_id))

    def scan(self, snapshot: Snapshot, located: bool = False, paths: list[str] | None = None) -> DataFrame:
        """Rows of a snapshot, or of some of its files, with deleted positions left out.

        ``located`` keeps the file and row position of each row. Files without deleted rows are
        read apart, so that only the touched ones are joined with the positions.
        """
        positions = self.positions(snapshot)
        if positions is None:
            return self._files(snapshot, self._live_paths(snapshot) if paths is None else paths, located)

        touched = {row[0] for row in positions.select("file_path").distinct().toLocalIterator()}
        if paths is None:
            paths = self._live_paths(snapshot, split={commit_of(path) for path in touched})
        dirty = [path for path in paths if path in touched]
        if not dirty:
            return self._files(snapshot, paths, located)
        rows = self._files(snapshot, dirty, located=True)
        kept = rows.join(
            positions,
            (rows[FILE] == positions["file_path"]) & (rows[ROW] == positions["row_index"]),
            "left_anti",
        )
        if not located:
            kept = kept.drop(FILE, ROW)
        clean = [path for path in paths if path not in touched]
        return self._files(snapshot, clean, located).unionByName(kept) if clean else kept

    def _files(self, snapshot: Snapshot, paths: list[str], located: bool) -> DataFrame:
        schema = snapshot.struct
        places = [F.lit(None).cast("string").alias(FILE), F.lit(None).cast("bigint").alias(ROW)]
        if not paths:
            empty = self.spark.createDataFrame([], schema)
            return empty.select("*", *places) if located else empty
        rows = (
            self.spark.read.schema(schema)
            .option("basePath", f"{self.root}/data")
            .parquet(*[f"{self.root}/{path}" for path in paths])
        )
        if located:
            places = [
                relative(F.col("_metadata.file_path")).alias(FILE),
                F.col("_metadata.row_index").alias(ROW),
            ]
            return rows.select(*schema.names, *places)
        return rows.select(*schema.names)

    def _live_paths(self, snapshot: Snapshot, split: set[str] = frozenset()) -> list[str]:
        """Folders where whole commits are live, single files elsewhere and in ``split``.

        Only path names reach the driver, as for any Parquet reader.
        """
        whole = [folder for folder in snapshot.folders if folder not in split]
        single = self.list_files(snapshot.file_list, [folder for folder in snapshot.folders if folder in split])
        if single is not None:
            whole += [row[0] for row in single.select("path").toLocalIterator()]
        return whole

    def positions(self, snapshot: Snapshot) -> DataFrame | None:
        """Deleted positions of a snapshot; None when it has none."""
        if not snapshot.deletes:
            return None
        return self.spark.read.schema(POSITIONS).parquet(*[f"{self.root}/{f}" for f in snapshot.deletes])

    # ---- write --------------------------------------------------------------

    def overwrite(self, df: DataFrame) -> int:
        """Replace all rows and the schema. Creates the table when it is not there."""
        base = self.log.latest()
        partition_by = [name for name in base.partition_by if name in df.columns] if base else []
        return self.commit(base, "overwrite", df, schema=_nullable(df.schema), partition_by=partition_by)

    def append(self, df: DataFrame, writer: tuple[str, int] | None = None) -> int | None:
        """Add rows, matched by column name.

        ``writer`` is (stream name, batch number): a batch committed before is skipped, which makes
        a replayed micro-batch harmless.
        """
        base = self.snapshot()
        if writer and base.writers.get(writer[0], -1) >= writer[1]:
            return None
        columns = [
            (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in base.struct.fields
        ]
        unknown = set(df.columns) - set(base.struct.names)
        if unknown:
            raise ValueError(f"columns not in the table: {sorted(unknown)}")
        return self.commit(base, "append", df.select(*columns), writer=writer)

    def add_column(self, name: str, data_type: T.DataType) -> int:
        """Widen the schema. No file is rewritten; old rows read NULL."""
        base = self.snapshot()
        if name in base.struct.names:
            raise ValueError(f"column {name} exists")
        schema = T.StructType([*base.struct.fields, T.StructField(name, data_type, True)])
        return self.commit(base, "alter", schema=schema)

    def commit(
        self,
        base: Snapshot | None,
        operation: str,
        rows: DataFrame | None = None,
        *,
        schema: T.StructType | None = None,
        partition_by: list[str] | None = None,
        live: tuple[list[str], str | None] | None = None,
        deletes: list[str] | None = None,
        writer: tuple[str, int] | None = None,
        removed: int = 0,
    ) -> int:
        """Write ``rows`` and publish the next version.

        ``live`` names the folders and the file list that stay; by default all do, or none when
        overwriting. ``removed`` is the number of rows taken away with what does not stay.
        """
        fresh = base is None or operation == "overwrite"
        folders, file_list = live or (([], None) if fresh else (base.folders, base.file_list))
        if deletes is None:
            deletes = [] if fresh else base.deletes
        partition_by = base.partition_by if partition_by is None else partition_by
        added = 0
        if rows is not None:
            folder, added = self.write_rows(rows, partition_by)
            folders = [*folders, folder]
        before = 0 if fresh else int(base.summary["total-records"])
        writers = dict(base.writers) if base else {}
        if writer:
            writers[writer[0]] = writer[1]
        version = base.version + 1 if base else 0
        self.log.commit(Snapshot(
            version=version, snapshot_id=new_snapshot_id(), parent=base.version if base else None,
            committed_at=now(), operation=operation, schema=(schema or base.struct).jsonValue(),
            partition_by=partition_by, folders=folders, file_list=file_list, deletes=deletes,
            summary=_summary(added, before + added - removed), writers=writers,
        ))
        return version

    def write_rows(self, rows: DataFrame, partition_by: list[str]) -> tuple[str, int]:
        """Write a commit folder; return it and its number of rows.

        The rows are counted in the stage that writes them, where a retried task counts once.
        """
        folder = f"data/__commit={uuid.uuid4().hex}"
        if partition_by:
            # rebalance gathers each partition value and splits the ones that are too big for a task
            rows = rows.hint("rebalance", *partition_by)
        seen = Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(*partition_by).parquet(
            f"{self.root}/{folder}"
        )
        return folder, seen.get["rows"]

    # ---- file lists ---------------------------------------------------------

    def list_files(self, file_list: str | None, folders: list[str]) -> DataFrame | None:
        """Files of a saved list and of whole folders, with sizes and row counts.

        Folders are listed by a Spark job; row counts come from the Parquet footers.
        """
        parts = []
        if file_list:
            parts.append(self.spark.read.schema(FILE_LIST).parquet(f"{self.root}/{file_list}"))
        if folders:
            files = (
                self.spark.read.schema("_none int")
                .option("recursiveFileLookup", "true")
                .parquet(*[f"{self.root}/{folder}" for folder in folders])
                .groupBy(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_size").alias("bytes"))
                .agg(F.count("*").alias("n"))
            )
            path = relative(F.col("uri"))
            parts.append(files.select(
                path.alias("path"),
                F.regexp_extract(path, r"^data/__commit=[0-9a-f]{32}/(.*?)/?[^/]*$", 1).alias("partition"),
                F.col("n").alias("record_count"),
                F.col("bytes").alias("file_size_in_bytes"),
            ))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def without_files(self, snapshot: Snapshot, gone: DataFrame, paths: list[str]) -> tuple[list[str], str | None]:
        """What stays live without the files in ``gone`` (column ``path``; ``paths`` on the driver).

        Folders that lose no file stay whole; the rest of the others goes into a new file list.
        """
        hit = {commit_of(path) for path in paths}
        folders = [folder for folder in snapshot.folders if folder not in hit]
        some = self.list_files(snapshot.file_list, [folder for folder in snapshot.folders if folder in hit])
        if some is None:
            return folders, None
        file_list = f"meta/{uuid.uuid4().hex}"
        some.join(gone, "path", "left_anti").write.parquet(f"{self.root}/{file_list}")
        return folders, file_list

    def rows_in(self, snapshot: Snapshot, gone: DataFrame, paths: list[str]) -> int:
        """Visible rows of some live files."""
        hit = {commit_of(path) for path in paths}
        some = self.list_files(snapshot.file_list, [folder for folder in snapshot.folders if folder in hit])
        count = some.join(gone, "path", "left_semi").agg(F.sum("record_count")).first()[0] or 0
        positions = self.positions(snapshot)
        if positions is not None:
            dead = positions.join(gone.withColumnRenamed("path", "file_path"), "file_path", "left_semi")
            count -= dead.count()
        return count

    # ---- metadata tables ----------------------------------------------------

    def data_files(self, snapshot: Snapshot | None = None) -> DataFrame:
        snapshot = snapshot or self.snapshot()
        files = self.list_files(snapshot.file_list, snapshot.folders)
        return self.spark.createDataFrame([], FILE_LIST) if files is None else files

    def delete_files(self, snapshot: Snapshot | None = None) -> DataFrame:
        snapshot = snapshot or self.snapshot()
        files = self.list_files(None, snapshot.deletes)
        return self.spark.createDataFrame([], FILE_LIST) if files is None else files

    def partitions(self, snapshot: Snapshot | None = None) -> DataFrame:
        return self.data_files(snapshot).groupBy("partition").agg(
            F.sum("record_count").alias("record_count"),
            F.count("*").alias("file_count"),
        )

    def history(self) -> DataFrame:
        """One row per retained version, with the summary as a map."""
        rows = [
            (s.version, s.snapshot_id, s.parent, datetime.fromtimestamp(s.committed_at, timezone.utc), s.operation, s.summary)
            for s in self.log.all()
        ]
        schema = (
            "version bigint, snapshot_id bigint, parent bigint, committed_at timestamp, "
            "operation string, summary map<string,string>"
        )
        return self.spark.createDataFrame(rows, schema)


def relative(uri: Column) -> Column:
    return F.url_decode(F.replace(F.regexp_extract(uri, RELATIVE, 1), F.lit("+"), F.lit("%2B")))


def commit_of(path: str) -> str:
    return "/".join(path.split("/")[:2])


def _summary(added: int, total: int) -> dict[str, str]:
    return {"added-records": str(added), "total-records": str(total)}


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
