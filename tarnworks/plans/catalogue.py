"""All registered queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tarnworks.plans import batch_queries, stream_queries, table_queries
from tarnworks.session import pin_session

Query = Callable[[SparkSession, str], DataFrame]


def _pinned(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(pin_session(spark), sf_dir)

    return run


def all_queries() -> dict[str, Query]:
    registered = {**batch_queries.QUERIES, **table_queries.QUERIES, **stream_queries.QUERIES}
    return {name: _pinned(query) for name, query in registered.items()}
