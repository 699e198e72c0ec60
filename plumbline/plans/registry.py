"""Named queries over the driver's tables, each with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plumbline.session import configure

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Runner
    sql: str | None
    headline: bool


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, *, headline: bool = False):
    """Register a function under its own name."""

    def add(fn: Runner) -> Runner:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(configure(spark), sf)

        QUERIES[fn.__name__] = Query(run, sql, headline)
        return fn

    return add
