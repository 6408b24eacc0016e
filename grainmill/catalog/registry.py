"""Query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register `func(spark, folder)` under an operator id."""

    def add(func):
        if key in REGISTRY:
            raise ValueError(f"{key} is registered twice")
        REGISTRY[key] = Query(func, sql)
        return func

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
