"""Registry of named queries: a Spark builder plus (optionally) its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marquee.plans.context import QueryContext


@dataclass(frozen=True)
class RegisteredQuery:
    name: str
    build: Callable[[QueryContext], DataFrame]
    oracle: str | None
    inventory: str


REGISTRY: dict[str, RegisteredQuery] = {}


def query(name: str, inventory: str, oracle: str | None = None):
    """Register ``fn(ctx) -> DataFrame`` under ``name`` (``inventory``: SURVEY ids)."""
    def deco(fn: Callable[[QueryContext], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = RegisteredQuery(name, fn, oracle, inventory)
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from marquee.plans import (q_etl, q_ml, q_profile, q_serve, q_sources)  # noqa: F401


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()

    def bind(rq: RegisteredQuery):
        def run(spark: SparkSession, data_dir: str) -> DataFrame:
            return rq.build(QueryContext(spark, data_dir))
        run.__name__ = rq.name
        return run

    return {name: bind(rq) for name, rq in REGISTRY.items()}


def oracle_queries() -> dict[str, str]:
    _load_all()
    return {name: rq.oracle for name, rq in REGISTRY.items() if rq.oracle}
