"""Named queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from .fixtures import Data, with_clause


class Query(NamedTuple):
    build: Callable[[Data], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, views: str = ""):
    """Register a query over the given tables with its equivalent SQL."""

    def add(build: Callable[[Data], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(build, None if sql is None else with_clause(*views.split()) + sql)
        return build

    return add


def load_all() -> dict[str, Query]:
    from . import (  # noqa: F401
        catalog_documents,
        catalog_functions,
        catalog_relational,
        catalog_reports,
        catalog_sources,
        catalog_state,
        catalog_streams,
    )

    return QUERIES


def runnable(name: str) -> Callable[[SparkSession, str], DataFrame]:
    build = QUERIES[name].build
    return lambda spark, sf_dir: build(Data(spark, sf_dir))
