"""Named queries: a Spark function over the inputs, and the same question as DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlet.functions import outward
from martlet.session import shared_folder
from workload.inputs import Inputs
from workload.oracle_views import with_views

SPARK: dict[str, Callable[[Inputs], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, run: Callable[[Inputs], DataFrame], sql: str | None = None) -> None:
    if name in SPARK:
        raise ValueError(f"query {name} is registered twice")
    SPARK[name] = run
    if sql is not None:
        SQL[name] = sql


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the shared one, for queries that write before they read."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _callable(run: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: outward(run(Inputs(spark, sf_dir)))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _callable(run) for name, run in SPARK.items()}


def all_oracles() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in SQL.items()}
