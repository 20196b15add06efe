"""Queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lexiloom.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")

        @wraps(run)
        def start(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return run(spark, sf_dir)

        QUERIES[name] = start
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
