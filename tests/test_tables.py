import threading
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnworks.sources import filesystem as fs
from tarnworks.tables import days, rowops, upkeep
from tarnworks.tables.named import NamedTable
from tarnworks.tables.snapshot import CommitConflict
from tarnworks.tables.versioned import VersionedTable
from tarnworks.workspace import fresh_name

FUTURE = datetime(2100, 1, 1, tzinfo=timezone.utc)


def table_of(spark, path, *batches, schema="id bigint, v string", partition_by=None):
    table = VersionedTable(spark, path).create(T._parse_datatype_string(schema), partition_by)
    for batch in batches:
        table.append(spark.createDataFrame(batch, schema).coalesce(1))
    return table


def letters(spark, path):
    """Four commits of one row, as small files pile up."""
    return table_of(spark, path, [(1, "ash")], [(2, "birch")], [(3, "cedar")], [(4, "dogwood")])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def total(table):
    return int(table.snapshot().summary["total-records"])


def test_versions_and_time_travel(spark, folder):
    table = letters(spark, folder())
    assert table.log.versions() == [0, 1, 2, 3, 4]
    assert rows(table.read(version=2)) == [(1, "ash"), (2, "birch")]
    first = table.snapshot(version=1)
    assert rows(table.read(snapshot_id=first.snapshot_id)) == [(1, "ash")]
    assert [r["operation"] for r in table.history().orderBy("version").collect()] == ["create"] + ["append"] * 4
    assert table.read(version=0).count() == 0
    with pytest.raises(LookupError):
        table.read(snapshot_id=1)


def test_overwrite_changes_schema_and_old_version_stays(spark, folder):
    table = letters(spark, folder())
    table.overwrite(spark.createDataFrame([(9.5,)], "x double"))
    assert table.read().columns == ["x"] and total(table) == 1
    assert table.read(version=4).count() == 4


def test_create_keeps_what_is_there(spark, folder):
    table = letters(spark, folder())
    table.create(T._parse_datatype_string("other int"))
    assert table.read().columns == ["id", "v"]


def test_append_matches_names_and_refuses_unknown_columns(spark, folder):
    table = letters(spark, folder())
    table.append(spark.createDataFrame([("e", 5)], "v string, id int"))
    table.append(spark.createDataFrame([(6,)], "id int"))
    assert (5, "e") in rows(table.read()) and (6, None) in rows(table.read())
    with pytest.raises(ValueError, match="other"):
        table.append(spark.createDataFrame([(7, 1)], "id int, other int"))


def test_added_column_reads_null(spark, folder):
    table = table_of(spark, folder(), [(1, "ash")])
    table.add_column("source", T.StringType())
    table.append(spark.createDataFrame([(2, "birch", "web")], "id bigint, v string, source string"))
    assert rows(table.read()) == [(1, "ash", None), (2, "birch", "web")]
    assert table.read(version=1).columns == ["id", "v"]


def test_lost_race_raises(spark, folder):
    table = letters(spark, folder())
    stale = table.snapshot(version=3)
    with pytest.raises(CommitConflict):
        table.commit(stale, "append", spark.createDataFrame([(5, "e")], "id bigint, v string"), live=(stale.folders, None))
    assert table.read().count() == 4


def test_replayed_batch_is_skipped(spark, folder):
    table = table_of(spark, folder())
    batch = spark.createDataFrame([(1, "ash")], "id bigint, v string")
    assert table.append(batch, writer=("q", 0)) == 1
    assert table.append(batch, writer=("q", 0)) is None
    assert table.append(batch, writer=("other", 0)) == 2
    assert table.append(batch, writer=("q", 1)) == 3


def test_whole_commits_are_read_as_folders(spark, folder):
    table = letters(spark, folder())
    assert len(table.snapshot().folders) == 4 and table.snapshot().file_list is None
    rowops.delete_copy_on_write(table, F.col("id") == 2)
    changed = table.snapshot()
    assert len(changed.folders) == 4 and changed.file_list  # three untouched commits and the new one
    assert rows(table.read()) == [(1, "ash"), (3, "cedar"), (4, "dogwood")]


def test_partition_values_with_odd_characters(spark, folder):
    names = ["MIDDLE EAST", "A%B+C=:é", None, "x/y"]
    batch = [(i, name) for i, name in enumerate(names)]
    table = table_of(spark, folder(), batch, batch, schema="n int, region string", partition_by=["region"])
    assert rows(table.read()) == sorted(batch * 2, key=repr)
    rowops.delete_copy_on_write(table, F.col("n") == 1)
    rowops.delete_merge_on_read(table, F.col("n") == 0)
    assert rows(table.read()) == sorted([b for b in batch if b[0] > 1] * 2, key=repr)
    assert {r["partition"] for r in table.partitions().collect()} >= {"region=MIDDLE EAST"}


def test_rewriting_a_table_from_itself(spark, folder):
    table = letters(spark, folder())
    table.overwrite(table.read().withColumn("v", F.upper("v")))
    assert rows(table.read()) == [(1, "ASH"), (2, "BIRCH"), (3, "CEDAR"), (4, "DOGWOOD")]


# ---- merge and delete ---------------------------------------------------------

EVENTS = "id bigint, ts timestamp, kind string, payload string"


def event_table(spark, path):
    d = datetime(2025, 1, 1)
    return table_of(spark, path, [(1, d, "click", "a")], [(2, d, "view", "b"), (3, d, "click", "c")], schema=EVENTS)


def test_merge(spark, folder):
    table = event_table(spark, folder())
    before = {r["path"] for r in table.data_files().collect()}
    rowops.merge(table, spark.createDataFrame([(1, "refund"), (5, "hover")], "id int, kind string"), ["id"], ["kind"])
    got = {r["id"]: (r["kind"], r["payload"]) for r in table.read().collect()}
    assert got == {1: ("refund", "a"), 2: ("view", "b"), 3: ("click", "c"), 5: ("hover", None)}
    assert len(before & {r["path"] for r in table.data_files().collect()}) == 1  # the untouched file
    assert total(table) == 4


def test_merge_inserts_null_keys_and_rejects_repeated_ones(spark, folder):
    table = event_table(spark, folder())
    rowops.merge(table, spark.createDataFrame([(None, "x"), (None, "y")], "id int, kind string"), ["id"], ["kind"])
    assert table.read().where("id IS NULL").count() == 2
    version = table.snapshot().version
    with pytest.raises(rowops.DuplicateUpdateKeys):
        rowops.merge(table, spark.createDataFrame([(1, "x"), (1, "y")], "id int, kind string"), ["id"], ["kind"])
    assert table.snapshot().version == version


def test_merge_can_set_null_and_updates_repeated_rows(spark, folder):
    table = table_of(spark, folder(), [(1, "ash"), (1, "b"), (2, "c")])
    rowops.merge(table, spark.createDataFrame([(1, None)], "id int, v string"), ["id"], ["v"])
    assert rows(table.read()) == [(1, None), (1, None), (2, "c")]


def test_merge_after_position_deletes(spark, folder):
    table = letters(spark, folder())
    rowops.delete_merge_on_read(table, F.col("id") == 2)
    rowops.merge(table, spark.createDataFrame([(2, "again"), (3, "C")], "id int, v string"), ["id"], ["v"])
    assert rows(table.read()) == [(1, "ash"), (2, "again"), (3, "C"), (4, "dogwood")] and total(table) == 4


@pytest.mark.parametrize("delete", [rowops.delete_copy_on_write, rowops.delete_merge_on_read])
def test_delete_keeps_rows_where_the_predicate_is_null(spark, folder, delete):
    table = table_of(spark, folder(), [(1, "ash"), (2, None), (3, "beech")])
    delete(table, F.col("v") == "ash")
    assert rows(table.read()) == [(2, None), (3, "beech")] and total(table) == 2
    assert rows(table.read(version=1)) == [(1, "ash"), (2, None), (3, "beech")]


def test_delete_without_matches_commits_nothing(spark, folder):
    table = letters(spark, folder())
    assert rowops.delete_copy_on_write(table, F.col("id") == 99) == 4
    assert rowops.delete_merge_on_read(table, F.col("id") == 99) == 4


def test_position_deletes_leave_data_files_alone(spark, folder):
    table = letters(spark, folder())
    before = rows(table.data_files())
    rowops.delete_merge_on_read(table, F.col("id") == 2)
    rowops.delete_merge_on_read(table, F.col("id") >= 2)
    assert rows(table.data_files()) == before
    assert table.delete_files().agg(F.sum("record_count")).first()[0] == 3
    assert rows(table.read()) == [(1, "ash")] and total(table) == 1


# ---- maintenance ----------------------------------------------------------------


def test_compaction_merges_small_files(spark, folder):
    table = letters(spark, folder())
    assert upkeep.compact(table, min_input_files=5) == 4  # too few files
    upkeep.compact(table, min_input_files=2)
    assert table.data_files().count() == 1 and rows(table.read()) == [(1, "ash"), (2, "birch"), (3, "cedar"), (4, "dogwood")]
    assert total(table) == 4


def test_compaction_splits_at_the_target_size(spark, folder):
    table = VersionedTable(spark, folder())
    table.overwrite(spark.range(40_000).select("id", F.xxhash64("id").alias("x")).repartition(8))
    size = table.data_files().agg(F.sum("file_size_in_bytes")).first()[0]
    upkeep.compact(table, target_bytes=size // 3, min_input_files=2)
    assert 3 <= table.data_files().count() <= 4 and table.read().distinct().count() == 40_000


def test_compaction_reads_and_joins_in_tasks_of_their_own(spark, folder, monkeypatch):
    """However few files are wanted, only the last step, which writes them, has as few tasks."""
    table = VersionedTable(spark, folder())
    table.overwrite(spark.range(0, 1000, numPartitions=4))
    rowops.delete_merge_on_read(table, F.col("id") % 2 == 0)
    seen, replace_files = [], upkeep.replace_files
    monkeypatch.setattr(upkeep, "replace_files", lambda *a: seen.append(a[-1]) or replace_files(*a))
    upkeep.compact(table, rewrite_all=True)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" not in plan and plan.index("REPARTITION_BY_NUM") < plan.index("Join")
    assert table.data_files().count() == 1
    assert sorted(row["id"] for row in table.read().collect()) == list(range(1, 1000, 2))


def test_compaction_settles_by_partition(spark, folder):
    batches = [[(i, "x")] for i in range(3)] + [[(9, "y")]]
    table = table_of(spark, folder(), *batches, partition_by=["v"])
    done = upkeep.compact(table, min_input_files=2)
    assert {r["partition"]: r["file_count"] for r in table.partitions().collect()} == {"v=x": 1, "v=y": 1}
    assert done == 5 and upkeep.compact(table, min_input_files=2) == done  # y's only file was never touched
    assert rows(table.read()) == [(0, "x"), (1, "x"), (2, "x"), (9, "y")]
    assert upkeep.compact(letters(spark, folder()), target_bytes=1) == 4  # nothing below the target


def test_named_table(spark, folder):
    table = NamedTable(spark, fresh_name("shop"), "till", folder("it's a shop"))
    assert not table.exists()
    table.create(T._parse_datatype_string("id bigint not null"))
    assert table.exists() and table.read().count() == 0
    assert table.overwrite(spark.range(5).withColumn("commit", F.lit("mine"))) == 5
    assert table.create(T._parse_datatype_string("other int")).read().columns == ["id", "commit"]
    assert table.overwrite(table.read().where("id < 2")) == 2  # reads the rows it replaces
    table.vacuum()
    assert len(fs.list_names(spark, table.folder)) == 1
    assert rows(spark.sql(f"SELECT * FROM {table.name}")) == [(0, "mine"), (1, "mine")]
    with pytest.raises(Exception):
        table.overwrite(spark.range(3).select(F.raise_error(F.lit("broken")).alias("id")))
    assert table.read().count() == 2  # a failed job leaves the rows


def test_readers_see_old_rows_or_new_ones_at_any_moment(spark, folder):
    """One thread reads while another publishes fifty times; a version's rows all carry its number."""
    table = NamedTable(spark, fresh_name("shop"), "till", folder("shop"))

    def version(n):
        return spark.range(20).select(F.lit(n).cast("bigint").alias("v"))

    table.overwrite(version(0))
    seen, failures, done = [], [], threading.Event()

    def poll(session):
        while not done.is_set():
            try:
                got = session.table(table.name).agg(F.min("v"), F.max("v"), F.count("*")).first()
                seen.append(tuple(got))
            except Exception as failure:
                failures.append(failure)

    readers = [threading.Thread(target=poll, args=(session,)) for session in (spark, spark.newSession())]
    for reader in readers:
        reader.start()
    for n in range(1, 51):
        table.overwrite(version(n))
    done.set()
    for reader in readers:
        reader.join()
    assert not failures and len(seen) > 10
    assert all(low == high and count == 20 for low, high, count in seen)
    assert table.read().first()["v"] == 50


def test_rows_of_another_schema_are_declared_anew(spark, folder):
    table = NamedTable(spark, fresh_name("shop"), "till", folder("shop"))
    table.overwrite(spark.range(3))
    table.overwrite(spark.range(2).withColumn("more", F.lit("x")))
    assert table.read().columns == ["id", "more"] and table.read().count() == 2
    table.vacuum()
    assert table.read().count() == 2


def test_failure_before_the_swap_keeps_the_old_rows(spark, folder, monkeypatch):
    table = NamedTable(spark, fresh_name("shop"), "till", folder("shop"))
    table.overwrite(spark.range(3))
    monkeypatch.setattr(NamedTable, "exists", lambda self: (_ for _ in ()).throw(RuntimeError("power cut")))
    with pytest.raises(RuntimeError, match="power cut"):
        table.overwrite(spark.range(9))
    monkeypatch.undo()
    assert table.read().count() == 3
    assert table.overwrite(spark.range(9)) == 9 and table.read().count() == 9


def test_append_to_a_named_table(spark, folder):
    table = NamedTable(spark, fresh_name("shop"), "till", folder("shop")).create(T._parse_datatype_string("id bigint, v string, n decimal(10,2)"))
    assert table.append(spark.createDataFrame([("x", 1)], "v string, id int")) == 1  # by name, absent columns NULL
    with pytest.raises(ValueError, match="not in the table"):
        table.append(spark.range(1).withColumn("other", F.lit(1)))
    with pytest.raises(Exception):
        table.append(spark.range(3).withColumn("v", F.raise_error(F.lit("broken")).cast("string")))
    assert rows(table.read()) == [(1, "x", None)]
    assert table.seed(spark.range(5)) == 0 and table.read().count() == 1
    empty = NamedTable(spark, fresh_name("shop"), "till", folder("shop")).create(T._parse_datatype_string("id bigint"))
    assert empty.seed(spark.range(5)) == 5 and empty.read().count() == 5
    assert empty.append(empty.read()) == 5 and empty.read().count() == 10  # rows of its own


def test_delete_repair_sequence(spark, folder):
    table = letters(spark, folder())
    upkeep.compact(table, min_input_files=2)
    rowops.delete_merge_on_read(table, F.col("id") == 2)
    assert table.delete_files().count() > 0
    upkeep.compact(table, rewrite_all=True)
    assert table.delete_files().count() > 0  # dangling now
    upkeep.drop_dangling_deletes(table)
    assert table.delete_files().count() == 0
    dropped = upkeep.expire_snapshots(table, FUTURE, retain_last=1, dry_run=False)
    assert dropped.count() > 0 and table.log.versions() == [table.snapshot().version]
    assert rows(table.read()) == [(1, "ash"), (3, "cedar"), (4, "dogwood")] and total(table) == 3
    on_disk = upkeep.listing(table, ["data", "deletes"])
    assert rows(on_disk.select("path")) == rows(table.data_files().select("path"))


def test_dangling_cleanup_keeps_live_positions(spark, folder):
    table = letters(spark, folder())
    rowops.delete_merge_on_read(table, F.col("id").isin(2, 3))
    rowops.delete_copy_on_write(table, F.col("v") == "cedar")  # nothing left to match: no commit
    upkeep.drop_dangling_deletes(table)
    assert rows(table.read()) == [(1, "ash"), (4, "dogwood")]


def test_expiry_keeps_shared_files_and_recent_versions(spark, folder):
    table = letters(spark, folder())
    rowops.delete_copy_on_write(table, F.col("id") == 2)
    preview = upkeep.expire_snapshots(table, FUTURE, retain_last=1)
    assert preview.count() == 1 and len(table.log.versions()) == 6  # dry run
    upkeep.expire_snapshots(table, FUTURE, retain_last=2, dry_run=False)
    assert table.log.versions() == [4, 5]
    assert rows(table.read(version=4)) == [(1, "ash"), (2, "birch"), (3, "cedar"), (4, "dogwood")]
    upkeep.expire_snapshots(table, FUTURE, retain_last=1, dry_run=False)
    assert rows(table.read()) == [(1, "ash"), (3, "cedar"), (4, "dogwood")]
    assert not fs.exists(spark, f"{table.root}/{preview.first()['path']}")
    long_ago = datetime(2000, 1, 1, tzinfo=timezone.utc)
    assert upkeep.expire_snapshots(table, long_ago, dry_run=False).count() == 0


def test_expiry_deletes_single_files_of_a_half_live_commit(spark, folder):
    table = VersionedTable(spark, folder()).create(T._parse_datatype_string("id bigint"))
    table.append(spark.range(8).repartition(4))
    one_file = table.scan(table.snapshot(), located=True).where("id = 3").first()["__located_file"]
    rowops.delete_copy_on_write(table, F.col("id") == 3)
    upkeep.expire_snapshots(table, FUTURE, dry_run=False)
    assert not fs.exists(spark, f"{table.root}/{one_file}")
    assert sorted(r["id"] for r in table.read().collect()) == [0, 1, 2, 4, 5, 6, 7]


def test_orphans(spark, folder):
    table = letters(spark, folder())
    table.write_rows(spark.createDataFrame([(9, "x")], "id bigint, v string"), [])  # never committed
    assert upkeep.orphan_files(table).count() == 0  # too young
    later = datetime.now(timezone.utc) + timedelta(days=4)
    assert upkeep.orphan_files(table, now=later).count() >= 1
    with pytest.raises(ValueError):
        upkeep.orphan_files(table, older_than=timedelta(hours=1), dry_run=False)
    upkeep.orphan_files(table, now=later, dry_run=False)
    assert upkeep.listing(table).count() == 4 and table.read().count() == 4


# ---- days -----------------------------------------------------------------------


def test_day_layout_prunes_folders(spark, folder):
    schema = T._parse_datatype_string("id bigint, ts timestamp")
    data = [(i, datetime(2024, 1, 1 + i // 4, 6 * (i % 4))) for i in range(20)]
    table = days.create(VersionedTable(spark, folder()), schema, "ts")
    days.append(table, spark.createDataFrame(data, schema), "ts")
    got = days.between(table, "ts", "2024-01-02 06:00:00", "2024-01-03 12:00:00")
    assert sorted(r["id"] for r in got.collect()) == list(range(5, 10))
    assert got.columns == ["id", "ts"] and days.read(table).count() == 20
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_day" in plan


def test_columns_named_like_internals_keep_their_values(spark, folder):
    rows = spark.sql("SELECT 'mine' AS commit, 7L AS _row, 'f' AS _file")
    table = VersionedTable(spark, folder()).create(rows.schema)
    table.append(rows)
    assert [tuple(r) for r in table.read().collect()] == [("mine", 7, "f")]


def test_headers_appear_whole_or_not_at_all(spark, folder):
    from tarnworks.sources import filesystem as fs

    path = f"{folder()}/1.json"
    fs.create_text(spark, path, "first")
    with pytest.raises(FileExistsError):
        fs.create_text(spark, path, "second")
    assert fs.read_text(spark, path) == "first"
    assert fs.list_names(spark, path.rsplit("/", 1)[0]) == ["1.json"]
