import pytest
from pyspark.sql import functions as F

from tarnworks.tables.partitioned import PartitionedTable, RepeatedKeys
from tarnworks.workspace import fresh_dir, fresh_name

SHAPE = "k int, grp string, v string"
ROWS = [(1, "north", "a"), (2, "north", "b"), (3, "south", "c"), (3, "east", "d"), (None, "east", "e"), (4, None, "f")]


@pytest.fixture
def table(spark):
    database = fresh_name("parts")
    made = PartitionedTable(spark, database, "stock", fresh_dir(spark, "parts"), F.col("grp"), ["grp"])
    yield made.create(spark.createDataFrame(ROWS, SHAPE))
    spark.sql(f"DROP DATABASE `{database}` CASCADE")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(table):
    return {r[0] for r in table.spark.table(table.name).select("_metadata.file_path", "_part").collect() if r[1] == "north"}


def test_merge_updates_every_match_and_inserts_the_rest(spark, table):
    before = files(table)
    table.merge(spark.createDataFrame([(3, "x"), (9, "y"), (None, "z")], "k int, v string"), ["k"], ["v"])
    assert rows(table.read()) == sorted([
        (1, "north", "a"), (2, "north", "b"), (3, "south", "x"), (3, "east", "x"), (None, "east", "e"), (4, None, "f"),
        (9, None, "y"), (None, None, "z"),
    ], key=str)
    assert files(table) == before  # a partition without a match isn't written again


def test_merge_inserts_into_a_partition_without_a_match(spark, table):
    table.merge(spark.createDataFrame([(7, "north", "n"), (4, "north", None)], SHAPE), ["k"], ["v"])
    assert rows(table.read()) == sorted([*ROWS[:5], (4, None, None), (7, "north", "n")], key=str)


def test_merge_refuses_repeated_keys_and_moves(spark, table):
    with pytest.raises(RepeatedKeys):
        table.merge(spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string"), ["k"], ["v"])
    with pytest.raises(ValueError):
        table.merge(spark.createDataFrame([(1, "x")], "k int, grp string"), ["k"], ["grp"])
    assert rows(table.read()) == sorted(ROWS, key=str)


def test_merge_without_updates(spark, table):
    table.merge(spark.createDataFrame([], "k int, v string"), ["k"], ["v"])
    assert rows(table.read()) == sorted(ROWS, key=str)


def test_delete_rewrites_some_and_drops_whole_partitions(spark, table):
    before = files(table)
    table.delete(F.col("k") >= 3)
    assert rows(table.read()) == sorted([(1, "north", "a"), (2, "north", "b"), (None, "east", "e")], key=str)
    assert files(table) == before
    table.delete(F.col("k") == 77)
    table.delete(F.lit(True))
    assert rows(table.read()) == []


# ---- files and compaction ----------------------------------------------------------


@pytest.fixture
def pile(spark):
    """Ten deliveries of two groups, one of them also of a name that a path must escape."""
    database = fresh_name("pile")
    made = PartitionedTable(spark, database, "stock", fresh_dir(spark, "pile"), F.col("grp"), ["grp"])

    def delivery(i):
        return spark.createDataFrame([(i, "a=b/c +%é", "x"), (i, "plain", "y"), (i, "plain", "y")], SHAPE)

    made.create(delivery(0))
    for i in range(1, 10):
        made.append(delivery(i))
    made.append(spark.createDataFrame([(99, "alone", "z")], SHAPE))
    yield made
    spark.sql(f"DROP DATABASE `{database}` CASCADE")


def per_part(table):
    return {r["_part"]: r["n"] for r in table.files().groupBy("_part").agg(F.count("*").alias("n")).collect()}


def test_compaction_writes_crowded_partitions_once(spark, pile):
    before = rows(pile.read())
    assert per_part(pile) == {"a=b/c +%é": 10, "plain": 10, "alone": 1}
    alone = {r["path"] for r in pile.files().where("_part = 'alone'").collect()}
    assert pile.compact(min_input_files=11) == 0
    assert pile.compact() == 2
    assert per_part(pile) == {"a=b/c +%é": 1, "plain": 1, "alone": 1}
    assert alone == {r["path"] for r in pile.files().where("_part = 'alone'").collect()}  # left as it was
    assert rows(pile.read()) == before
    assert pile.compact() == pile.compact(min_input_files=1) == 0


def test_compaction_aims_at_the_target_size(spark, pile):
    before = rows(pile.read())
    size = pile.files().where("_part = 'plain'").agg(F.sum("bytes")).first()[0]
    assert pile.compact(target_bytes=size // 3, min_input_files=2) == 2  # copies of one row are dealt over the files too
    assert 2 <= per_part(pile)["plain"] <= 4
    assert rows(pile.read()) == before


def test_compaction_reads_no_path_on_the_driver(spark, pile, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    def refuse(self, *a, **k):
        raise AssertionError("rows came to the driver")

    monkeypatch.setattr(DataFrame, "toLocalIterator", refuse)
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: refuse(self) if "path" in self.columns else collect(self))
    assert pile.compact() == 2


def test_append_and_merge_after_compaction(spark, pile):
    pile.compact()
    pile.append(spark.createDataFrame([("w", 7, "plain")], "v string, k int, grp string"))  # matched by name
    pile.merge(spark.createDataFrame([(99, "q")], "k int, v string"), ["k"], ["v"])
    assert pile.read().where("grp = 'alone'").first()["v"] == "q" and pile.read().where("v = 'w'").count() == 1


def test_size_sketches_merge_over_folders(spark):
    from tarnworks.sources import files as scans

    sizes = [(f"d{i % 7}", (i * 7919) % 10_007) for i in range(5000)]
    listed = spark.createDataFrame(sizes, "folder string, bytes bigint")
    profile = scans.size_profile(listed, "folder", "bytes", small_bytes=100)
    assert profile.agg(F.sum("file_count"), F.sum("total_bytes"), F.sum("small_files")).first()[:] == (
        5000, sum(s for _, s in sizes), sum(s < 100 for _, s in sizes))
    got = scans.size_quantiles(profile, [0.0, 0.1, 0.5, 0.9, 1.0]).first()
    ordered = sorted(s for _, s in sizes)
    assert got["file_count"] == 5000 and got["quantiles"][0] == ordered[0] and got["quantiles"][-1] == ordered[-1]
    for rank, value in zip((0.1, 0.5, 0.9), got["quantiles"][1:4]):
        assert abs(sum(s <= value for s in ordered) / 5000 - rank) < 0.01
    by_folder = scans.size_quantiles(profile, [0.5], ["folder"])
    assert by_folder.count() == 7 and by_folder.agg(F.sum("file_count")).first()[0] == 5000


def test_days_prune_partitions(spark):
    from datetime import datetime, timedelta

    from tarnworks.tables.partitioned import DayTable

    database = fresh_name("days")
    rows = spark.createDataFrame([(h, datetime(2024, 1, 1) + timedelta(hours=h)) for h in range(96)] + [(None, None)], "id int, ts timestamp")
    table = DayTable(spark, database, "hours", fresh_dir(spark, "days"), "ts").create(rows)
    got = table.between("2024-01-02 06:00:00", "2024-01-03 12:00:00")
    assert sorted(r["id"] for r in got.collect()) == list(range(30, 60)) and got.columns == ["id", "ts"]
    assert len({f.split("_part=")[1].split("/")[0] for f in got.inputFiles()}) <= 5
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_part" in plan
    assert table.read().count() == 97
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
