"""Base-table access.

``Warehouse`` opens the star-schema parquet tables of one data folder
(or catalog tables) lazily.  Reads carry no projection of their own:
Catalyst prunes columns and pushes filters into each parquet scan from
whatever the downstream plan uses.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events")


class Warehouse:
    """Lazily opened base tables of one scale-factor folder or catalog."""

    def __init__(self, spark: SparkSession, location: str, fmt: str = "parquet"):
        self.spark = spark
        self.location = location.rstrip("/")
        self.fmt = fmt
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            if self.fmt == "catalog":
                df = self.spark.table(f"{self.location}.{name}")
            else:
                df = self.spark.read.format(self.fmt).load(f"{self.location}/{name}.{self.fmt}")
            self._cache[name] = df
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.table(name)
        raise AttributeError(name)

    @cached_property
    def logical(self):
        from hazrank.sources.mapping import LogicalTables
        return LogicalTables(self)


def open_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse(spark, sf_dir)
