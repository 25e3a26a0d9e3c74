"""Registry of the named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """Lazy access to the tables of a folder: ``t.orders`` reads ``orders.parquet``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables`` as a query, with the SQL that gives the same result."""

    def wrap(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key!r} is registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            SQL[key] = sql
        return fn

    return wrap
