"""Named queries over the test tables, each next to its SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from shardweave.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with equivalent SQL if there is any.

    The session that it is given gets the settings that the jobs rely on.
    """
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = wraps(run)(lambda spark, sf_dir: run(configure(spark), sf_dir))
        if sql is not None:
            SQL[run.__name__] = sql
        return run
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
