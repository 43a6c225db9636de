"""The submittable steps, one after the other, as an operator would call them."""

import pytest
from pyspark.sql import functions as F

from tarnworks import jobs
from tarnworks.plans import batch_queries, event_topic, inputs, medallion
from tarnworks.workspace import fresh_name


@pytest.fixture
def run(spark, folder):
    root, prefix = folder("lake"), fresh_name("lake") + "_"

    def step(*argv):
        return jobs.main(["--root", root, "--prefix", prefix, *map(str, argv)], spark)

    step.lake = medallion.Lake(spark, root, prefix)
    return step


def test_the_whole_chain(spark, sf_dir, folder, run):
    files = folder("sales")
    inputs.sales(spark, sf_dir).write.parquet(files)
    topic = event_topic.filled_topic(spark, sf_dir)
    events = inputs.table(spark, sf_dir, "events").count()
    for _ in range(2):  # every step can be run again
        assert f"{events} messages" in run("stream-events", "--topic", topic.name)
        run("land-sales", "--files", files)
        run("land-events")
        assert "rows_cnt" in run("build-core")
        run("build-marts")
        run("build-quality")
        assert medallion.MONTHLY in run("publish")
        assert len(run("verify").splitlines()) == len(run("verify", "--files", files).splitlines()) == 5
    want = batch_queries.core(spark, sf_dir).agg(F.count("*"), F.sum("amount")).first()
    assert run.lake.table("core", "sales").read().agg(F.count("*"), F.sum("amount")).first() == want
    assert "rows" in run("totals", "--files", files)
    run("vacuum", "core", "sales")
    assert run.lake.table("core", "sales").read().count() == want[0]


def test_landing_without_a_stream_is_empty(spark, sf_dir, folder, run):
    run("land-events")
    assert run.lake.table("landing", "sales_events").read().count() == 0


def test_a_failed_check_ends_the_job(spark, sf_dir, folder, run):
    files = folder("sales")
    inputs.sales(spark, sf_dir).limit(50).write.parquet(files)
    for step in (["land-sales", "--files", files], ["land-events"], ["build-core"], ["build-marts"], ["build-quality"], ["publish"]):
        run(*step)
    serving = run.lake.table("serving", medallion.MONTHLY)
    serving.overwrite(serving.read().withColumn("total_amount", (F.col("total_amount") + 1).cast("decimal(18,2)")))
    with pytest.raises(AssertionError, match="serving_monthly"):
        run("verify")


@pytest.mark.parametrize("argv", [["land-sales"], ["stream-events"], ["nothing"], ["land-sales", "--url", "a", "--files", "b"]])
def test_bad_arguments_are_refused(spark, run, argv):
    with pytest.raises(SystemExit):
        run(*argv)
