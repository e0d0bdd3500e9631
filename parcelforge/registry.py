"""Where the catalog's queries and their SQL are kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(sql: str | None) -> Callable[[Query], Query]:
    """Decorator: the function becomes a query of its name; without SQL only its rows are checked."""

    def keep(query: Query) -> Query:
        _QUERIES[query.__name__] = query
        if sql:
            _SQL[query.__name__] = sql
        return query

    return keep


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def sql_of() -> dict[str, str]:
    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
