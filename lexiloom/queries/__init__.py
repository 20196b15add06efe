"""Registered queries: one per operator, each over the driver tables, most with an SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexiloom.queries.base import REGISTRY


def _load() -> None:
    from lexiloom.queries import jobs, metrics, relational, scalars, sinks, streams  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: entry.run for name, entry in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: entry.sql for name, entry in REGISTRY.items() if entry.sql is not None}
