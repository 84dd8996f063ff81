"""Registered queries: a Spark function, the operators it covers, and SQL with the same result."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from costloom.checks.ctes import with_tables
from costloom.checks.domain import Domain

QueryFn = Callable[[Domain], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: QueryFn
    sql: str | None
    shared: bool = True

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.run(Domain(spark, sf_dir, self.shared))


REGISTRY: dict[str, Query] = {}


def query(
    name: str, covers: str, sql: str | None = None, shared: bool = True
) -> Callable[[QueryFn], QueryFn]:
    """Register a query.

    `covers` lists operator ids; `sql` may name the tables of `ctes`; `shared` says that the
    query reads the line item cells more than once, so they are stored between.
    """

    def add(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        text = with_tables(sql) if sql is not None else None
        REGISTRY[name] = Query(name, tuple(covers.split()), fn, text, shared)
        return fn

    return add


def load() -> dict[str, Query]:
    """All queries; importing the modules registers them."""
    from costloom.checks import (  # noqa: F401
        q_alerts,
        q_basics,
        q_cost,
        q_forecast,
        q_joins,
        q_performance,
        q_sources,
        q_staging,
    )

    return REGISTRY
