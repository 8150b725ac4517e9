"""Registry of queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from larder.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The given tables, read lazily by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, *keys: str) -> DataFrame:
        """A table for work that costs much more than its scan.

        A scan with fewer splits than cores is dealt out over the cores; what that
        moves is bounded by cores x split size. A larger table is left where it lies.
        With keys the rows are dealt out by them, which a later grouping can use.
        """
        table = getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        return table.repartition(cores, *keys) if table.rdd.getNumPartitions() < cores else table


def query(name: str, sql: str | None = None):
    """Register a query ``Tables -> DataFrame`` under a name, with its SQL twin if it has one."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return build(Tables(spark, folder))

        run.__name__, run.__doc__ = name, build.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return build

    return register
