"""Registration of queries with the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(sql: str | None = None):
    """Registers a function of Tables as the query of its name."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add
