"""The relational source the JDBC queries read.

On a cluster it is whatever database ``spark.tarnworks.jdbc.url`` names. A local session may use
the embedded Derby that ships with Spark: it lives inside the one local process, opens no port,
and cannot be seen by executors elsewhere, so a cluster session without a URL is refused.
"""

from __future__ import annotations

import tempfile
from itertools import chain, combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnworks.plans import inputs
from tarnworks.sources.jdbc import JdbcSource, write_table
from tarnworks.workspace import one_process, stage

SETTING = "spark.tarnworks.jdbc."
SALES_TABLE = "sales"
SALES_TYPES = "REGION VARCHAR(64), PRODUCT VARCHAR(64), AMOUNT DECIMAL(12,2)"
SALES_TEXTS = ("REGION", "PRODUCT")

_LOADED: dict[tuple[str, str], JdbcSource] = {}


def configured_source(spark: SparkSession) -> JdbcSource | None:
    url = spark.conf.get(SETTING + "url", None)
    if not url:
        return None
    return JdbcSource(
        url=url,
        driver=spark.conf.get(SETTING + "driver"),
        user=spark.conf.get(SETTING + "user", None),
        password=spark.conf.get(SETTING + "password", None),
    )


def embedded_source(spark: SparkSession) -> JdbcSource:
    if not one_process(spark):
        raise RuntimeError(f"set {SETTING}url: the embedded database is visible to one process only")
    folder = tempfile.mkdtemp(prefix="run-")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", f"{folder}/derby.log")
    return JdbcSource(
        url=f"jdbc:derby:{folder}/db;create=true",
        driver="org.apache.derby.iapi.jdbc.AutoloadedDriver",
    )


def load_embedded(rows: DataFrame, source: JdbcSource) -> None:
    """Fill the ``sales`` table of an embedded database.

    One writer at a time: Derby locks each inserted row until its writer commits, and only a lone
    writer's locks become one on the table; those of several would fill the heap. Spark sends a
    NULL text as a CLOB, which Derby takes for no VARCHAR, so NULL texts are left out of the insert.
    """
    staged = stage(rows, "sales")
    mode = "overwrite"
    for absent in chain.from_iterable(combinations(SALES_TEXTS, k) for k in range(len(SALES_TEXTS) + 1)):
        part = staged
        for text in SALES_TEXTS:
            part = part.where(F.col(text).isNull() if text in absent else F.col(text).isNotNull())
        write_table(part.drop(*absent).coalesce(1), source, SALES_TABLE, SALES_TYPES, mode)
        mode = "append"


def sales_source(spark: SparkSession, sf_dir: str) -> JdbcSource:
    """The database with its ``sales`` table: the configured one as it is, else a local one that
    Spark loads once per session from the dataset folder."""
    source = configured_source(spark)
    if source:
        return source
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LOADED:
        source = embedded_source(spark)
        rows = inputs.sales(spark, sf_dir)
        # Spark quotes names when it creates a table; upper case is what unquoted SQL resolves to
        load_embedded(rows.toDF(*[name.upper() for name in rows.columns]), source)
        _LOADED[key] = source
    return _LOADED[key]
