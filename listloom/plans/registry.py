"""Registered queries: name, Spark plan, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

Plan = Callable[["Tables"], DataFrame]


class Tables:
    """The test tables of one directory, read on demand."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def spread(self, name: str) -> DataFrame:
        """A table for CPU-bound work, dealt out when it has fewer splits than there are cores.

        It changes no result. A table with more splits than cores is returned as it is.
        """
        table = getattr(self, name)
        cores = self.spark.sparkContext.defaultParallelism
        return table if table.rdd.getNumPartitions() >= cores else table.repartition(cores)


@dataclass(frozen=True)
class Query:
    plan: Plan
    sql: str | None

    def __call__(self, spark: SparkSession, path: str) -> DataFrame:
        return self.plan(Tables(tune(spark), path))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(plan, sql)
        return plan

    return register
