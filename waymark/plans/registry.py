"""All queries over the library's operators, by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import book_queries, geo_queries, table_queries, text_queries
from ._declare import Declared


def _all() -> dict[str, Declared]:
    return {**text_queries.QUERIES, **table_queries.QUERIES, **geo_queries.QUERIES, **book_queries.QUERIES}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: d.run for name, d in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {name: d.sql for name, d in _all().items() if d.sql}
