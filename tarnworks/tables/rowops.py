"""Row-level changes as Spark jobs: MERGE, and DELETE in both styles."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tarnworks.tables.snapshot import Snapshot
from tarnworks.tables.versioned import FILE, ROW, VersionedTable
from tarnworks.workspace import stage


class DuplicateUpdateKeys(ValueError):
    """Two updates would change the same row."""


def merge(
    table: VersionedTable,
    updates: DataFrame,
    on: list[str],
    set_columns: list[str],
    insert_columns: list[str] | None = None,
) -> int:
    """Update matched rows, insert the others with the given columns (the rest NULL).

    Only files that hold a matched row are rewritten. NULL keys never match, so such updates are
    inserted. A key repeated in ``updates`` is an error and nothing is written.
    """
    base = table.snapshot()
    insert_columns = insert_columns or updates.columns
    # read several times below; staging also gives the planner its size for the join choice
    updates = stage(updates, "merge-updates")
    known = updates.where(_all_set(on))
    if not known.groupBy(*on).count().where("count > 1").isEmpty():
        raise DuplicateUpdateKeys(f"updates repeat a value of {on}")

    located = table.scan(base, located=True)
    hits = located.select(*on, FILE).join(known.select(*on), on, "left_semi").select(F.col(FILE).alias("path")).distinct()
    gone = stage(hits, "merge-files")
    touched = [row[0] for row in gone.toLocalIterator()]

    schema = base.struct
    parts = []
    if touched:
        rows = table.scan(base, paths=touched)
        source = known.select(
            *[F.col(c).alias(f"_u_{c}") for c in dict.fromkeys([*on, *set_columns])],
            F.lit(True).alias("_matched"),
        )
        same = _equal(rows, source, on, "_u_")
        updated = rows.join(source, same, "left").select(*[
            F.when(F.col("_matched"), F.col(f"_u_{f.name}")).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
            if f.name in set_columns else F.col(f.name)
            for f in schema.fields
        ])
        parts.append(updated)
        # one row per key before the anti join: a key repeated in the table stays small
        present = table.scan(base, paths=touched).select(*on).distinct()
        fresh = updates.join(present, on, "left_anti")
    else:
        fresh = updates
    parts.append(fresh.select(*[
        (F.col(f.name) if f.name in insert_columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]))
    written = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return replace_files(table, "merge", base, gone, touched, written)


def delete_copy_on_write(table: VersionedTable, predicate: Column) -> int:
    """Rewrite the files that hold matching rows. Rows where the predicate is NULL stay."""
    base = table.snapshot()
    gone = stage(
        table.scan(base, located=True).where(predicate).select(F.col(FILE).alias("path")).distinct(),
        "delete-files",
    )
    touched = [row[0] for row in gone.toLocalIterator()]
    if not touched:
        return base.version
    kept = table.scan(base, paths=touched).where(~F.coalesce(predicate, F.lit(False)))
    return replace_files(table, "delete", base, gone, touched, kept)


def delete_merge_on_read(table: VersionedTable, predicate: Column) -> int:
    """Record the positions of matching rows and leave the data files alone."""
    base = table.snapshot()
    matches = table.scan(base, located=True).where(predicate)
    folder = f"deletes/__commit={uuid.uuid4().hex}"
    positions = matches.select(F.col(FILE).alias("file_path"), F.col(ROW).alias("row_index"))
    seen = Observation()
    positions.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{table.root}/{folder}")
    removed = seen.get["rows"]
    if removed == 0:
        return base.version
    return table.commit(base, "delete", deletes=[*base.deletes, folder], removed=removed)


def replace_files(
    table: VersionedTable, operation: str, base: Snapshot, gone: DataFrame, paths: list[str], rows: DataFrame,
) -> int:
    """Swap the files in ``gone`` (``paths`` on the driver) for a commit that holds ``rows``."""
    if not paths:
        return table.commit(base, operation, rows)
    live = table.without_files(base, gone, paths)
    return table.commit(base, operation, rows, live=live, removed=table.rows_in(base, gone, paths))


def _all_set(columns: list[str]) -> Column:
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def _equal(left: DataFrame, right: DataFrame, on: list[str], prefix: str) -> Column:
    condition = F.lit(True)
    for name in on:
        condition = condition & (left[name] == right[f"{prefix}{name}"])
    return condition
