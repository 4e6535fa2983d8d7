"""The query registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cairn_queries.fixtures import Tables


@dataclass(frozen=True)
class Query:
    """A query over one scale folder, the inventory rows it covers, and its check SQL."""

    name: str
    covers: str
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.run(Tables(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def register(name: str, covers: str, run: Callable[[Tables], DataFrame], sql: str | None) -> None:
    if name in REGISTRY:
        raise ValueError(f"duplicate query {name}")
    REGISTRY[name] = Query(name, covers, run, sql)


def query(name: str, covers: str, sql: str | None):
    """Decorator form of :func:`register`."""
    def add(run: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        register(name, covers, run, sql)
        return run
    return add
