"""Registry of named queries: each is ``(spark, sf_dir) -> DataFrame`` plus an optional SQL oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class QuerySpec:
    name: str
    fn: QueryFn
    oracle: str | None
    ids: tuple[str, ...]


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, oracle: str | None = None, ids: tuple[str, ...] = ()):
    """Register ``fn`` under ``name``; ``oracle`` is DuckDB SQL over the raw tables."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = QuerySpec(name, fn, oracle, ids)
        return fn

    return deco


def load_all() -> dict[str, QuerySpec]:
    """Import every query module so its registrations run."""
    from sluice.plans import (  # noqa: F401
        q_diffs,
        q_evals,
        q_forecast,
        q_registry,
        q_responses,
        q_retail,
        q_rules,
        q_sinks,
        q_streams,
        q_usage,
    )

    return REGISTRY
