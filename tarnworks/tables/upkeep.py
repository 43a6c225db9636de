"""Table maintenance: compaction, delete clean-up, snapshot expiry, orphan removal."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.functions.fixed_values import ORPHAN_AGE_DAYS
from tarnworks.sources import filesystem as fs
from tarnworks.tables.rowops import replace_files
from tarnworks.tables.snapshot import FILE_LIST, Snapshot
from tarnworks.tables.versioned import COMMIT_FOLDER, FILE, ROW, VersionedTable, relative
from tarnworks.workspace import stage

TARGET_FILE_BYTES = 512 * 1024 * 1024
ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def compact(
    table: VersionedTable,
    target_bytes: int = TARGET_FILE_BYTES,
    min_input_files: int = 5,
    rewrite_all: bool = False,
) -> int:
    """Rewrite small files, and all files with ``rewrite_all``, into files near the target size.

    A partition is left alone if it has fewer than ``min_input_files`` files below three quarters of the target,
    or if as many files would come out as go in, so that a second run finds nothing to do. Deleted positions of the
    rewritten files are applied where the files are read. Without partition columns the rows are then dealt over as many
    writers as files are wanted; with them Spark gathers each partition value and splits those beyond the target size.
    """
    base = table.snapshot()
    chosen = table.data_files(base)
    if not rewrite_all:
        small = stage(chosen.where(F.col("file_size_in_bytes") < 0.75 * target_bytes), "small-files")
        crowded = small.groupBy("partition").agg(F.count("*").alias("n"), F.sum("file_size_in_bytes").alias("bytes")).where(
            (F.col("n") >= min_input_files) & (F.ceil(F.col("bytes") / target_bytes) < F.col("n"))
        )
        chosen = small.join(crowded, "partition", "left_semi")
    chosen = stage(chosen, "compact-files")
    size = chosen.agg(F.count("*"), F.coalesce(F.sum("file_size_in_bytes"), F.lit(0))).first()
    if size[0] == 0:
        return base.version
    paths = [row[0] for row in chosen.select("path").toLocalIterator()]
    rows = table.scan(base, located=True, paths=paths)
    if not base.partition_by:
        # dealt by place, which parts copies of a row; a shuffle, so that reading and joining keep their own tasks
        rows = rows.repartition(max(1, math.ceil(size[1] / target_bytes)), F.xxhash64(FILE, ROW))
    rows = rows.drop(FILE, ROW)
    with _advisory_size(table.spark, target_bytes):
        return replace_files(table, "replace", base, chosen.select("path"), paths, rows)


@contextmanager
def _advisory_size(spark: SparkSession, size: int) -> Iterator[None]:
    """Let rebalanced writes aim at this size; the session's own setting comes back afterwards."""
    before = spark.conf.get(ADVISORY_SIZE)
    spark.conf.set(ADVISORY_SIZE, str(size))
    try:
        yield
    finally:
        spark.conf.set(ADVISORY_SIZE, before)


def drop_dangling_deletes(table: VersionedTable) -> int:
    """Forget deleted positions of files that are no longer live."""
    base = table.snapshot()
    positions = table.positions(base)
    if positions is None:
        return base.version
    live = table.data_files(base).select(F.col("path").alias("file_path"))
    standing = stage(positions.join(live, "file_path", "left_semi"), "standing-deletes")
    deletes: list[str] = []
    if not standing.isEmpty():
        deletes = [f"deletes/__commit={uuid.uuid4().hex}"]
        standing.write.parquet(f"{table.root}/{deletes[0]}")
    return table.commit(base, "replace", deletes=deletes)


def expire_snapshots(
    table: VersionedTable,
    older_than: datetime,
    retain_last: int = 1,
    dry_run: bool = True,
) -> DataFrame:
    """Drop old versions and the files only they refer to; returns those files.

    ``retain_last`` newest versions always stay. With ``dry_run`` nothing is deleted.
    """
    snapshots = table.log.all()
    newest = {s.version for s in snapshots[-max(1, retain_last):]}
    limit = older_than.replace(tzinfo=older_than.tzinfo or timezone.utc).timestamp()
    expired = [s for s in snapshots if s.version not in newest and s.committed_at < limit]
    kept = [s for s in snapshots if s not in expired]
    if not expired:
        return table.spark.createDataFrame([], "path string")

    dropped = sorted(_whole_folders(expired) - _whole_folders(kept))
    lists = sorted(_file_lists(expired) - _file_lists(kept))
    old = reduce(DataFrame.unionByName, [listing(table, dropped).select("path"), *_listed(table, lists)])
    dead = stage(_unreferenced(table, old.distinct(), kept), "expired-files")
    if dry_run:
        return dead
    # headers first: once they are gone no reader can start on the files removed next
    for snapshot in expired:
        table.log.drop(snapshot.version)
    _delete_files(table, dead, kept)
    for name in lists:
        fs.delete(table.spark, f"{table.root}/{name}", recursive=True)
    return dead


def orphan_files(
    table: VersionedTable,
    older_than: timedelta = timedelta(days=ORPHAN_AGE_DAYS),
    dry_run: bool = True,
    now: datetime | None = None,
) -> DataFrame:
    """Files under the table root that no retained version refers to and that are old enough."""
    if older_than < timedelta(days=ORPHAN_AGE_DAYS) and not dry_run:
        raise ValueError(f"refusing to remove files younger than {ORPHAN_AGE_DAYS} days")
    kept = table.log.all()
    limit = (now or datetime.now(timezone.utc)) - older_than
    present = listing(table, ["data", "deletes"]).where(F.col("modified_at") < F.lit(limit))
    orphans = stage(_unreferenced(table, present, kept), "orphan-files")
    if not dry_run:
        # one by one: a folder may also hold files too young to judge
        for row in orphans.select("path").toLocalIterator():
            fs.delete(table.spark, f"{table.root}/{row[0]}")
    return orphans


LISTING = "path string, modified_at timestamp, file_size_in_bytes bigint"


def listing(table: VersionedTable, folders: list[str] = ["data"]) -> DataFrame:  # noqa: B006
    """Parquet files below folders of the table; contents are not read."""
    present = [f"{table.root}/{folder}" for folder in folders if fs.exists(table.spark, f"{table.root}/{folder}")]
    if not present:
        return table.spark.createDataFrame([], LISTING)
    files = (
        table.spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(present)
    )
    return files.select(
        relative(F.col("_metadata.file_path")).alias("path"),
        F.col("modificationTime").alias("modified_at"),
        F.col("length").alias("file_size_in_bytes"),
    )


def _whole_folders(snapshots: list[Snapshot]) -> set[str]:
    return {folder for s in snapshots for folder in [*s.folders, *s.deletes]}


def _file_lists(snapshots: list[Snapshot]) -> set[str]:
    return {s.file_list for s in snapshots if s.file_list}


def _listed(table: VersionedTable, file_lists: list[str]) -> list[DataFrame]:
    if not file_lists:
        return []
    names = [f"{table.root}/{name}" for name in file_lists]
    return [table.spark.read.schema(FILE_LIST).parquet(*names).select("path")]


def _unreferenced(table: VersionedTable, files: DataFrame, kept: list[Snapshot]) -> DataFrame:
    """Files that no kept version refers to, neither singly nor with their whole folder."""
    folders = table.spark.createDataFrame([(f,) for f in sorted(_whole_folders(kept))], "_folder string")
    rest = files.join(folders, F.regexp_extract("path", COMMIT_FOLDER, 1) == F.col("_folder"), "left_anti")
    for live in _listed(table, sorted(_file_lists(kept))):
        rest = rest.join(live, "path", "left_anti")
    return rest


def _delete_files(table: VersionedTable, dead: DataFrame, kept: list[Snapshot]) -> None:
    """Delete whole commit folders where nothing is live, single files elsewhere."""
    commit = F.regexp_extract("path", COMMIT_FOLDER, 1).alias("folder")
    used = table.spark.createDataFrame([], "folder string")
    for live in _listed(table, sorted(_file_lists(kept))):
        used = live.select(commit).distinct()
    folders = dead.select(commit).distinct().join(used, "folder", "left_anti")
    single = dead.select("path", commit).join(used, "folder", "left_semi").select("path")
    for row in folders.toLocalIterator():
        fs.delete(table.spark, f"{table.root}/{row[0]}", recursive=True)
    for row in single.toLocalIterator():
        fs.delete(table.spark, f"{table.root}/{row[0]}")
