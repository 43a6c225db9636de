"""Steps of the lake as jobs to submit, one command each.

    spark-submit --master ... tarnworks/jobs.py --root s3a://lake stream-events --topic sales_events --bootstrap kafka:9092
    spark-submit --master ... tarnworks/jobs.py --root s3a://lake land-sales --url jdbc:postgresql://host/db --table sales
    ... land-events | build-core | build-marts | build-quality | publish | verify | totals | vacuum

Steps find each other's tables by name in the session's catalog, so jobs that run apart need a catalog that outlives them (a metastore).
Every step replaces its tables, or goes on from its checkpoint, and can be run again. ``verify`` ends with an error when a
check fails.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnworks.operators.marts import totals_by_region_product
from tarnworks.operators.reconcile import require
from tarnworks.plans import medallion
from tarnworks.sources import jdbc
from tarnworks.sources.topic import Topic, stream_topic
from tarnworks.session import get_spark, pin_session
from tarnworks.streaming import ingest
from tarnworks.tables.named import NamedTable

PASSWORD_VARIABLE = "SALES_DB_PASSWORD"  # not an argument: those show in process lists


def _events(lake: medallion.Lake) -> ingest.EventTable:
    return ingest.EventTable(lake.spark, f"{lake.prefix}analytics", "sales_events", f"{lake.root}/analytics")


def _sales(lake: medallion.Lake, args: argparse.Namespace) -> DataFrame:
    """The operational sales: a table behind JDBC, or files of rows."""
    if args.files:
        return lake.spark.read.parquet(args.files)
    source = jdbc.JdbcSource(args.url, driver=args.driver, user=args.user, password=os.environ.get(PASSWORD_VARIABLE, ""))
    return jdbc.read_table(lake.spark, source, args.table, partition_column=args.split_by, partitions=args.splits)


def stream_events(lake: medallion.Lake, args: argparse.Namespace) -> str:
    options = {"kafka.bootstrap.servers": args.bootstrap} if args.bootstrap else {}
    table = _events(lake)
    ingest.ingest(stream_topic(lake.spark, Topic(args.topic, options)), table, args.timeout)
    require(ingest.verify_counts(table))
    return f"{table.name}: {table.read_log.messages()} messages so far"


def land_sales(lake: medallion.Lake, args: argparse.Namespace) -> str:
    medallion.land_sales(lake, _sales(lake, args))
    return "landing.sales is new"


def land_events(lake: medallion.Lake, args: argparse.Namespace) -> str:
    medallion.land_events(lake, _events(lake))
    return "landing.sales_events is new"


def build_core(lake: medallion.Lake, args: argparse.Namespace) -> str:
    return f"core.sales: {medallion.build_core(lake)}"


def build_marts(lake: medallion.Lake, args: argparse.Namespace) -> str:
    medallion.build_marts(lake)
    return "both marts are new"


def build_quality(lake: medallion.Lake, args: argparse.Namespace) -> str:
    medallion.build_quality(lake)
    return "the quality profile is new"


def publish(lake: medallion.Lake, args: argparse.Namespace) -> str:
    return f"published rows: {medallion.publish(lake)}"


def verify(lake: medallion.Lake, args: argparse.Namespace) -> str:
    """Layer against layer; with --url or --files also against the source as it is now, else against what landed of it."""
    source = _sales(lake, args) if args.url or args.files else lake.table("landing", "sales").read()
    checks = require(medallion.verify_publish(lake, source))
    return "\n".join(f"{r['check_name']}: {r['left_value']} {r['right_value']}" for r in checks.collect())


def totals(lake: medallion.Lake, args: argparse.Namespace) -> str:
    """The aggregate of the operational sales, straight from the source."""
    target = NamedTable(lake.spark, f"{lake.prefix}analytics", "sales_by_region_product", f"{lake.root}/analytics")
    return f"{target.name}: {target.overwrite(totals_by_region_product(_sales(lake, args)))} rows"


def vacuum(lake: medallion.Lake, args: argparse.Namespace) -> str:
    """Remove the folders of earlier versions of a layer's table."""
    lake.table(args.layer, args.name).vacuum()
    return f"{args.layer}.{args.name} has its current files only"


STEPS: dict[str, Callable[[medallion.Lake, argparse.Namespace], str]] = {
    "stream-events": stream_events, "land-sales": land_sales, "land-events": land_events, "build-core": build_core,
    "build-marts": build_marts, "build-quality": build_quality, "publish": publish, "verify": verify, "totals": totals,
    "vacuum": vacuum,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tarnworks.jobs", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    top.add_argument("--root", required=True, help="folder of the lake, reachable by all executors")
    top.add_argument("--prefix", default="", help="begins the names of the lake's databases")
    steps = top.add_subparsers(dest="step", required=True)
    for name, step in STEPS.items():
        command = steps.add_parser(name, help=step.__doc__)
        if name == "stream-events":
            command.add_argument("--topic", required=True, help="a topic's name, or a folder of its records")
            command.add_argument("--bootstrap", default="", help="host:port of the brokers; without, --topic is a folder")
            command.add_argument("--timeout", type=float)
        if name in ("land-sales", "totals", "verify"):
            place = command.add_mutually_exclusive_group(required=name != "verify")
            place.add_argument("--url", help=f"JDBC address; the password comes from {PASSWORD_VARIABLE}")
            place.add_argument("--files", help="Parquet files of the sales, in place of a database")
            command.add_argument("--table", default="sales")
            command.add_argument("--driver", default="org.postgresql.Driver")
            command.add_argument("--user", default="")
            command.add_argument("--split-by", default="id")
            command.add_argument("--splits", type=int, default=32)
        if name == "vacuum":
            command.add_argument("layer")
            command.add_argument("name")
    return top


def main(argv: list[str], spark: SparkSession | None = None) -> str:
    """Run one step; the session is that of the submit command unless one is handed in."""
    args = parser().parse_args(argv)
    session = pin_session(spark) if spark else get_spark(f"tarnworks-{args.step}")
    said = STEPS[args.step](medallion.Lake(session, args.root, args.prefix), args)
    print(said)
    return said


if __name__ == "__main__":
    main(sys.argv[1:])
