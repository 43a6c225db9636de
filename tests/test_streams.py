import json
from datetime import datetime
from functools import partial
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tarnworks.functions.messages import decode_event, encode_event
from tarnworks.operators import conform
from tarnworks.operators.reconcile import require
from tarnworks.plans import event_stream, inputs, medallion
from tarnworks.plans.catalogue import all_queries
from tarnworks.schemas import EVENT_VALUE
from tarnworks.sources.topic import Topic, peek, produce, read_topic, stream_topic, topic_size, watermarks
from tarnworks.streaming import ingest, raw_landing, read_log
from tarnworks.streaming.runs import drain, together, wait
from tarnworks.streaming.versioned_sink import ingest_versions, table_sink
from tarnworks.tables.versioned import VersionedTable
from tarnworks.workspace import fresh_name

MESSAGE = "n int, key binary, value binary"


def send(spark, topic, values, key=b"north", first=0):
    rows = [(first + i, key, v if v is None else v.encode()) for i, v in enumerate(values)]
    return produce(spark.createDataFrame(rows, MESSAGE), topic, ["n"])


def event(i, region="north"):
    return json.dumps({"id": i, "ts": "2025-01-01T00:00:01", "region": region, "product": "widget", "amount": 1.5})


@pytest.fixture
def topic(folder):
    return Topic(folder("topic"), partitions=3)


# ---- messages ---------------------------------------------------------------------


@pytest.mark.parametrize("text, want", [
    ("not json", (None, None, None, None, None)),
    ('{"id":"x","ts":"bad","amount":2}', (None, None, None, None, 2.0)),
    ('{"id":3000000000}', (3_000_000_000, None, None, None, None)),
    ('{"id":30000000000000000000}', (None, None, None, None, None)),
    (None, (None, None, None, None, None)),
    ('{"id":1,"more":true,"ts":"2025-01-01T00:00:01"}', (1, datetime(2025, 1, 1, 0, 0, 1), None, None, None)),
])
def test_decoding_is_permissive(spark, text, want):
    row = spark.createDataFrame([(text,)], "value string").select(decode_event(F.col("value")).alias("e")).select("e.*")
    got = tuple(row.first())
    assert got == want


def test_corrupt_text_can_be_kept(spark):
    df = spark.createDataFrame([("not json",), ('{"id":1}',)], "value string")
    got = df.select(decode_event(F.col("value"), corrupt_column="_corrupt").alias("e")).select("e.*").collect()
    assert [r["_corrupt"] for r in got] == ["not json", None]


def test_encoding_round_trip_keeps_microseconds(spark):
    row = (7, datetime(2024, 1, 1, 2, 3, 4, 567891), "north", "widget", 26.2)
    df = spark.createDataFrame([row], EVENT_VALUE)
    back = df.select(decode_event(encode_event(*EVENT_VALUE.names)).alias("e")).select("e.*")
    assert tuple(back.first()) == row


# ---- topic ------------------------------------------------------------------------


def test_offsets_continue_and_stay_dense(spark, topic):
    assert send(spark, topic, [event(i) for i in range(5)]) == 5
    assert send(spark, topic, [event(i) for i in range(3)], key=b"south", first=5) == 3
    assert send(spark, topic, [event(i) for i in range(4)], first=8) == 4
    by_partition = {}
    for r in read_topic(spark, topic).collect():
        by_partition.setdefault(r["partition"], []).append(r["offset"])
    assert all(sorted(offsets) == list(range(len(offsets))) for offsets in by_partition.values())
    keys = read_topic(spark, topic).groupBy("key").agg(F.count_distinct("partition").alias("p")).collect()
    assert all(r["p"] == 1 for r in keys)
    assert topic_size(spark, topic).first()["ever"] == 12


def test_key_order_is_kept(spark, topic):
    send(spark, topic, [event(i) for i in range(50)])
    rows = read_topic(spark, topic).orderBy("offset").select(decode_event(F.col("value")).alias("e")).select("e.id")
    assert [r["id"] for r in rows.collect()] == list(range(50))


def test_unkeyed_messages_use_all_partitions(spark, topic):
    send(spark, topic, [event(i) for i in range(60)], key=None)
    assert watermarks(spark, topic).count() == 3


def test_empty_topic(spark, topic):
    assert watermarks(spark, topic).count() == 0
    assert tuple(topic_size(spark, topic).first()) == (0, 0)


def test_trimmed_topic_counts_both_ways(spark, folder):
    trimmed = Topic(folder("topic"))
    rows = [(b"k", b"v", 0, o, datetime(2025, 1, 1)) for o in range(10, 15)]
    columns = "key binary, value binary, partition int, offset bigint, timestamp timestamp"
    spark.createDataFrame(rows, columns).write.parquet(trimmed.name)
    size = topic_size(spark, trimmed).first()
    assert (size["ever"], size["held"]) == (15, 5)
    assert [r["offset"] for r in peek(spark, trimmed, 3).collect()] == [10, 11, 12]


def test_peek_does_not_read_past_the_first_offsets(spark, topic):
    send(spark, topic, [event(i) for i in range(20)])
    first = peek(spark, topic, 3)
    assert [r["offset"] for r in first.collect()] == [0, 1, 2]


def test_peek_has_one_plan_for_any_number_of_partitions(spark, folder):
    """The bound is a join with the partitions' low marks, so 300 partitions are handled as three are."""
    wide = Topic(folder("topic"), partitions=300)
    send(spark, wide, [event(i) for i in range(20)])
    first = [(r["partition"], r["offset"]) for r in peek(spark, wide, 3).collect()]
    every = sorted((r["partition"], r["offset"]) for r in read_topic(spark, wide).collect())
    assert first == every[:3]


def test_kafka_is_used_when_configured(spark):
    on_kafka = Topic("sales_events", {"kafka.bootstrap.servers": "broker:9092"})
    with pytest.raises(Exception, match="(?i)kafka"):
        stream_topic(spark, on_kafka)


# ---- streams ----------------------------------------------------------------------


@pytest.fixture
def table(spark, folder):
    return ingest.EventTable(spark, fresh_name("streamed"), "sales_events", folder("streamed"))


def records_of(spark, topic, **limits):
    return stream_topic(spark, topic, limits)


def ids(table):
    return sorted(r["id"] for r in table.read().collect())


def test_reruns_add_exactly_the_new_messages(spark, topic, table):
    def run():
        ingest.ingest(records_of(spark, topic), table, timeout=120)
        return table.read().count()

    send(spark, topic, [event(i) for i in range(10)])
    assert run() == 10
    assert run() == 10
    send(spark, topic, [event(i) for i in range(4)] + ["broken"], first=10)
    assert run() == 15
    assert table.read_log.messages() == 15
    assert require(ingest.verify_counts(table, delivered=15)).count() == 2
    broken = table.read().where("id IS NULL").first()
    assert broken["kafka_offset"] == 14 and broken["amount"] is None


def test_counting_does_not_read_the_source(spark, topic, table):
    send(spark, topic, [event(i) for i in range(3)])
    ingest.ingest(records_of(spark, topic), table, timeout=120)
    files = ingest.verify_counts(table).inputFiles()
    assert files and all("/sales_events/" in f and topic.name not in f for f in files)


def test_run_that_dies_within_a_batch_leaves_nothing_behind(spark, topic, table):
    """Some files of the batch are written when a task fails for good; readers never see them."""
    for part in range(4):
        send(spark, topic, [event(10 * part + i) for i in range(10)], first=10 * part)
    fatal = F.when(F.col("offset") == 33, F.raise_error(F.lit("power cut"))).otherwise(F.col("offset"))
    with pytest.raises(Exception, match="power cut"):
        ingest.ingest(records_of(spark, topic).withColumn("offset", fatal), table, timeout=120)
    assert table.read().count() == 0
    ingest.ingest(records_of(spark, topic), table, timeout=120)
    assert ids(table) == list(range(40))
    assert require(ingest.verify_counts(table)).first()["left_value"] == 40


def test_batch_that_was_written_but_not_noted_is_not_doubled(spark, topic, table):
    """The sink had committed when the driver died, the checkpoint hadn't, and the progress was never reported."""
    send(spark, topic, [event(i) for i in range(6)])
    wait(table.start(ingest.parse_events(records_of(spark, topic), audit=True)), 120)  # nobody follows this run
    local = Path(urlparse(table.checkpoint).path) / "commits"
    for name in ("0", ".0.crc"):
        (local / name).unlink()
    ingest.ingest(records_of(spark, topic), table, timeout=120)
    assert ids(table) == list(range(6))
    send(spark, topic, [event(9)], first=6)
    ingest.ingest(records_of(spark, topic), table, timeout=120)
    assert ids(table) == [0, 1, 2, 3, 4, 5, 9]
    assert table.read_log.messages() is None  # it knows that it doesn't know
    with pytest.raises(ValueError, match="gaps"):
        ingest.verify_counts(table)
    assert require(ingest.verify_counts(table, source=read_topic(spark, topic))).first()["left_value"] == 7


def test_files_that_no_batch_committed_are_not_read(spark, topic, table):
    send(spark, topic, [event(i) for i in range(5)])
    ingest.ingest(records_of(spark, topic), table, timeout=120)
    spark.createDataFrame([], ingest.AUDITED_EVENTS).unionByName(spark.read.parquet(table.folder)).write.mode("append").parquet(table.folder + "/stray")
    assert ids(table) == list(range(5))


def test_lagging_and_overfull_tables_are_noticed(spark, topic, table):
    send(spark, topic, [event(i) for i in range(5)])
    ingest.ingest(records_of(spark, topic), table, timeout=120)
    with pytest.raises(AssertionError, match="delivered_equals_read: 8.00 vs 5.00"):
        require(ingest.verify_counts(table, delivered=8))
    spark.createDataFrame([(1, 4, None)], read_log.SCHEMA).write.mode("append").parquet(table.read_log.folder)
    with pytest.raises(AssertionError, match="topic_equals_table: 9.00 vs 5.00"):
        require(ingest.verify_counts(table))


@pytest.mark.parametrize("offset, want", [
    ('{"sales":{"0":12,"1":30}}', 42), ('{"a":{"0":1},"b":{"0":2}}', 3), ('{"logOffset":3}', None), (None, None), ("null", None), ("{}", None),
])
def test_end_offsets(offset, want):
    assert read_log.end_offsets(offset) == want


def test_end_offsets_are_the_topics_own_count(spark, folder):
    log = read_log.ReadLog(spark, folder())
    assert log.messages() == 0
    rows = [(0, 5, 5), (1, 0, 5), (2, 4, 9), (2, 4, 9)]  # a batch that was reported as empty when it was skipped
    spark.createDataFrame(rows, read_log.SCHEMA).write.parquet(log.folder)
    assert log.messages() == 9


def test_many_batches_are_all_counted(spark, topic, table):
    for part in range(5):
        send(spark, topic, [event(part)], first=part)
    files = len([f for f in Path(topic.name).iterdir() if f.suffix == ".parquet"])
    ingest.ingest(records_of(spark, topic, maxFilesPerTrigger="1"), table, timeout=240)
    assert table.read_log.messages() == 5 and table.read().count() == 5
    assert spark.read.parquet(table.read_log.folder).count() == files >= 5


def test_readers_run_side_by_side_and_one_may_fail(spark, topic, folder):
    send(spark, topic, [event(i) for i in range(20)])
    tables = {n: ingest.EventTable(spark, fresh_name(n), "t", folder(n)) for n in ("steady", "shaky")}
    tried = []

    def start(name):
        records = records_of(spark, topic)
        if name == "shaky":
            tried.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
            if len(tried) == 1:
                records = records.withColumn("offset", F.raise_error(F.lit("flicker")).cast("bigint"))
        return tables[name].start(ingest.parse_events(records, audit=True))

    runs = together(spark, {n: partial(start, n) for n in tables}, timeout=120)
    assert {n: len(r) for n, r in runs.items()} == {"steady": 1, "shaky": 2} and tried == ["shaky", "shaky"]
    assert [tables[n].read().count() for n in tables] == [20, 20]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    with pytest.raises(Exception, match="for ever"):
        together(spark, {"bad": lambda: wait(ingest.EventTable(spark, fresh_name("bad"), "t", folder()).start(
            ingest.parse_events(records_of(spark, topic).withColumn("offset", F.raise_error(F.lit("for ever")).cast("bigint")), audit=True)))})


def test_malformed_messages_are_kept_and_counted(spark, topic, table):
    send(spark, topic, [event(1), "not json", '{"id":"x","amount":2}', None, '{"id":3000000000}', "[1]", ""])
    ingest.ingest(records_of(spark, topic), table, timeout=120)
    assert {(r["kafka_offset"], r["message"]) for r in table.quarantine().collect()} == {(1, "not json"), (2, '{"id":"x","amount":2}'), (5, "[1]")}
    counts = table.message_counts().collect()
    assert [(r["messages"], r["good"], r["malformed"]) for r in counts] == [(7, 4, 3)]
    rows = {r["kafka_offset"]: r for r in table.read().collect()}
    assert rows[2]["amount"] == 2.0 and rows[2]["id"] is None and rows[4]["id"] == 3_000_000_000
    assert table.read().columns == ingest.SALES_EVENTS.names


def test_pump_truncates_to_seconds_and_sorts(spark, topic, folder):
    value = '{"id":%d,"ts":"2025-01-01T00:00:0%d.987654","region":"%s"}'
    send(spark, topic, [value % (i, 9 - i, r) for i, r in enumerate("baba")])
    table = ingest.sorted_events(spark, fresh_name("pumped"), "t", folder())
    ingest.pump(records_of(spark, topic), table, timeout=120)
    got = [(r["region"], r["ts"].second, r["ts"].microsecond) for r in table.read().collect()]
    assert sorted(got) == [("a", 6, 0), ("a", 8, 0), ("b", 7, 0), ("b", 9, 0)]
    files = table.read().withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.collect_list(F.struct("region", "ts")).alias("rows")).collect()
    assert all([tuple(x) for x in f["rows"]] == sorted(tuple(x) for x in f["rows"]) for f in files)
    assert table.read_log.messages() == 4


def test_replayed_batches_overwrite_their_own_partition(spark, folder):
    table = ingest.sorted_events(spark, fresh_name("pumped"), "t", folder()).create()
    first = spark.range(50).selectExpr("id", "timestamp_seconds(id) ts", "'r' region", "'p' product", "1.5D amount")
    for number, rows in ((0, first), (1, first.limit(7)), (0, first), (1, first.limit(7))):
        table.write(rows, number)
        seen = table.read().count()
    assert seen == 57
    table.write(first.limit(0), 2)
    assert table.read().count() == 57 and table.create().read().count() == 57


def test_pump_that_dies_after_writing_is_not_doubled(spark, topic, folder):
    send(spark, topic, [event(i) for i in range(6)])
    table = ingest.sorted_events(spark, fresh_name("pumped"), "t", folder())
    whole = table.write

    def crash(batch, number):
        whole(batch, number)
        raise RuntimeError("power cut")

    table.write = crash
    with pytest.raises(Exception, match="power cut"):
        ingest.pump(records_of(spark, topic), table, timeout=120)
    table.write = whole
    ingest.pump(records_of(spark, topic), table, timeout=120)
    assert table.read().count() == 6
    assert require(ingest.verify_counts(table)).first()["ok"]


@pytest.mark.parametrize("lines, want", [(2500, [833, 833, 834]), (1000, [1000]), (1001, [500, 501]), (40, [40])])
def test_raw_objects_keep_to_their_limits(spark, topic, folder, lines, want):
    send(spark, topic, [event(i) for i in range(lines)], key=None)
    raw, checkpoint = folder("raw"), folder("checkpoint")
    for _ in range(2):  # the second run finds nothing
        raw_landing.land_raw(records_of(spark, topic), raw, checkpoint, timeout=120)
    found = spark.read.text(raw)
    sizes = [r["count"] for r in found.groupBy(F.input_file_name()).count().collect()]
    assert sorted(sizes) == want
    assert sorted(json.loads(r["value"])["id"] for r in raw_landing.read_raw(spark, raw).collect()) == list(range(lines))


def test_raw_batch_that_dies_after_writing_is_not_doubled(spark, topic, folder, monkeypatch):
    send(spark, topic, [event(i) for i in range(30)])
    raw, checkpoint = folder("raw"), folder("checkpoint")
    cut = raw_landing.into_objects
    monkeypatch.setattr(raw_landing, "into_objects", lambda *a: cut(*a).withColumn("value", F.raise_error(F.lit("disk full")).cast("string")))
    with pytest.raises(Exception, match="disk full"):
        raw_landing.land_raw(records_of(spark, topic), raw, checkpoint, timeout=120)
    monkeypatch.setattr(raw_landing, "into_objects", cut)
    raw_landing.land_raw(records_of(spark, topic), raw, checkpoint, timeout=120)
    assert raw_landing.read_raw(spark, raw).count() == 30


def test_raw_landing_goes_on_by_its_trigger(spark, topic, folder):
    send(spark, topic, [event(i) for i in range(3)])
    raw = folder("raw")
    query = raw_landing.land_raw(records_of(spark, topic), raw, folder("checkpoint"), trigger={"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        send(spark, topic, [event(3)], first=3)
        query.processAllAvailable()
    finally:
        query.stop()
    assert raw_landing.read_raw(spark, raw).count() == 4


def test_admission_is_the_sources_own(spark):
    assert raw_landing.admission(objects_at_once=5) == {"minOffsetsPerTrigger": "100", "maxTriggerDelay": "30s", "maxOffsetsPerTrigger": "5000"}
    with pytest.raises(ValueError, match="twice"):
        raw_landing.into_objects(spark.createDataFrame([("a", 1)], "value string, offset int"), ["offset"], 600, 1000)


def test_every_reader_of_versions_is_its_own(spark, topic, folder):
    table = VersionedTable(spark, folder())
    send(spark, topic, [event(1)])
    for _ in range(2):
        ingest_versions(spark, topic, table, folder("checkpoint"), timeout=120)
    assert table.read().count() == 2


def test_version_replayed_after_a_crash_is_not_doubled(spark, topic, folder):
    """The table committed, then the job died before the checkpoint did."""
    table, checkpoint = VersionedTable(spark, folder()), folder("checkpoint")
    send(spark, topic, [event(i) for i in range(6)])
    sink = table_sink(table)
    table.create(ingest.SALES_EVENTS)

    def crash(batch, batch_id):
        sink(batch, batch_id)
        raise RuntimeError("power cut")

    events = ingest.parse_events(stream_topic(spark, topic))
    with pytest.raises(Exception, match="power cut"):
        drain(events.writeStream.foreachBatch(crash), checkpoint, 120)
    for _ in range(2):
        ingest_versions(spark, topic, table, checkpoint, timeout=120)
        assert table.read().count() == 6


def test_files_are_read_as_a_batch_and_as_a_stream(spark, sf_dir, folder):
    files = event_stream.arrived(spark, sf_dir)
    box = event_stream.inbox(spark, sf_dir)
    assert event_stream.deliver(spark, sf_dir, box, F.col("event_id") < 10) == 10
    assert files.batch(spark).columns == ["key", "value", "partition", "offset", "timestamp"]
    assert box.batch(spark).count() == 10 and files.stream(spark).isStreaming


@pytest.mark.parametrize("query", ["parse_events", "stream_ingest", "stream_incremental", "landing_events"])
def test_streamed_events_take_places_in_a_topic(spark, sf_dir, query):
    rows = all_queries()[query](spark, sf_dir).groupBy("kafka_partition").agg(
        F.min("kafka_offset"), F.max("kafka_offset") + 1, F.count_distinct("kafka_offset"), F.count("*"),
    ).collect()
    assert len(rows) == 3
    assert all(tuple(row)[1:] == (0, row[4], row[4], row[4]) for row in rows)


def test_deliveries_lose_no_event_and_keep_the_order(spark, folder):
    data = folder("odd")
    times = ["2024-01-02", None, "2024-02-01", "2024-01-03", None, "2024-01-04"]
    rows = [(i, t, 0, "view", 1.0, "{}") for i, t in enumerate(times)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(f"{data}/events.parquet")
    got = all_queries()["stream_incremental"](spark, data).orderBy("kafka_offset").collect()
    assert [row["kafka_offset"] for row in got] == [0, 1, 2, 3, 4, 5]
    assert [row["ts"] and row["ts"].strftime("%Y-%m-%d") for row in got] == times


def test_ids_beyond_32_bits_keep_every_row(spark, sf_dir):
    """Events far past 2^31 have ids of their own, so that core keeps as many rows as it does of small ones."""
    rows = inputs.table(spark, sf_dir, "events")
    near, far = (conform.build_core(conform.unify(inputs.landing_sales(spark, sf_dir).limit(0), conform.with_lineage(
        inputs.as_sales_events(r), "kafka", inputs.loaded_at()))) for r in (rows, rows.withColumn("event_id", F.col("event_id") + 303 * 10**9)))
    assert far.where("id is null").count() == near.where("id is null").count() == 1
    assert far.count() == near.count()
    assert far.agg(F.min("id")).first()[0] > 2**31


# ---- the whole chain ----------------------------------------------------------------


def test_medallion_without_a_stream(spark, sf_dir, folder):
    from tarnworks.plans import inputs

    lake = medallion.Lake(spark, folder("lake"), fresh_name("lake") + "_")
    checks = medallion.run(lake, inputs.sales(spark, sf_dir), VersionedTable(spark, folder()), inputs.loaded_at())
    assert checks.count() == 5 and checks.where("NOT ok").count() == 0
    assert lake.table("landing", "sales_events").read().count() == 0
    sources = lake.table("serving", medallion.MONTHLY).read().select("_source").distinct().collect()
    assert [r[0] for r in sources] == ["greenplum"]


def test_tampered_serving_copy_is_noticed(spark, sf_dir, folder):
    from tarnworks.plans import inputs

    lake = medallion.Lake(spark, folder("lake"), fresh_name("lake") + "_")
    medallion.run(lake, inputs.sales(spark, sf_dir), VersionedTable(spark, folder()), inputs.loaded_at())
    serving = lake.table("serving", medallion.MONTHLY)
    serving.overwrite(serving.read().withColumn("total_amount", (F.col("total_amount") + 1).cast("decimal(18,2)")))
    failed = medallion.verify_publish(lake, inputs.sales(spark, sf_dir)).where("NOT ok")
    assert {r["check_name"] for r in failed.collect()} == {"serving_monthly", "mart_equals_core"}


def test_serving_rows_are_sorted_and_not_null(spark, folder):
    from datetime import date
    from decimal import Decimal

    mart = spark.createDataFrame(
        [(date(2024, 2, 1), "s", None, "p", 1, Decimal("1.00"), Decimal("1.00")),
         (date(2024, 1, 1), "s", "r", "p", 1, Decimal("1.00"), Decimal("1.00"))],
        medallion.SERVING_BY_REGION_PRODUCT,
    )
    rows = medallion.serving_rows(mart, medallion.BY_REGION_PRODUCT).coalesce(1).collect()
    assert [r["sale_month"].month for r in rows] == [1, 2] and rows[1]["region"] == ""
