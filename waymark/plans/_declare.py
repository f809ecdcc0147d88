"""How a query is declared: a function of its tables, and SQL."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Declared:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


def declare(into: dict[str, Declared], sql: str | None = None):
    """Registers a function whose parameters name the tables that it takes."""

    def register(f):
        tables = list(inspect.signature(f).parameters)

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(*[spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables])

        into[f.__name__] = Declared(run, sql)
        return f

    return register
