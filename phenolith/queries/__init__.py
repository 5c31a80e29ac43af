"""The registry: every operator as a query over the given tables, with SQL where SQL can say it."""

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from phenolith.queries.sql import with_ctes


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under its name."""

    def add(fn):
        key = name or fn.__name__
        if key in REGISTRY:
            raise ValueError(f"query {key} is registered twice")
        REGISTRY[key] = Query(fn, with_ctes(sql) if sql else None)
        return fn

    return add


def load() -> dict[str, Query]:
    from phenolith.queries import counting, feature, model, output, scan, weather  # noqa: F401

    return REGISTRY
