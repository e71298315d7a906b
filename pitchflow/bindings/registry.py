"""Registration of queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pitchflow.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The Parquet tables of one directory, as attributes."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self._path = path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self._path}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of Tables as a query, with the SQL that gives the same rows."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, path: str) -> DataFrame:
            return fn(Tables(configure(spark), path))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
