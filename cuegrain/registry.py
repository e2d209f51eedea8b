"""Named queries with their optional SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name; each may carry the equal SQL text for a second engine."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(fn: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return keep


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder, read as it lies."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
