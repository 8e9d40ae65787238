"""Named queries over the test tables, each with an independent SQL form where one can be written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        """Registers a function of (spark, folder) under a name, with the SQL to hold it against."""

        def register(function: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"two queries are named {name}")
            self.queries[name] = function
            if sql is not None:
                self.oracles[name] = sql
            return function

        return register

    def update(self, other: Registry) -> None:
        for name, function in other.queries.items():
            self.add(name, other.oracles.get(name))(function)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
