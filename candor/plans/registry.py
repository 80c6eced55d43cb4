"""Name -> (Spark query, checking SQL)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from candor.session import prefer_compiled

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Registers a function (spark, folder) -> DataFrame."""

    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        @wraps(run)
        def compiled(spark: SparkSession, folder: str) -> DataFrame:
            prefer_compiled(spark)
            return run(spark, folder)

        QUERIES[name] = Query(compiled, sql)
        return run

    return add
