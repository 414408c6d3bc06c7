"""Query registration."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskmart.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The supplied tables as attributes: ``t.orders`` reads ``<dir>/orders.parquet``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self._path = path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._path}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name, with its SQL twin if it has one."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, path: fn(Tables(tune(spark), path))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
