"""The named queries: each key maps to a Spark job and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

Y = "yield_kg_per_hectare"


def query(key: str, sql: str | None = None):
    def register(job):
        if key in JOBS:
            raise ValueError(f"duplicate query {key}")
        JOBS[key] = job
        if sql is not None:
            ORACLES[key] = sql
        return job

    return register
