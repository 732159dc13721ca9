"""Registration of named queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> tuple[dict[str, Query], dict[str, str], Callable]:
    """(queries, their SQL, decorator): ``@query(sql)`` registers a function under its name."""
    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}

    def query(sql: str | None = None):
        def keep(function: Query) -> Query:
            name = function.__name__
            if name in queries:
                raise ValueError(f"two queries are named {name}")
            queries[name] = function
            if sql is not None:
                oracles[name] = sql
            return function

        return keep

    return queries, oracles, query


def joined(*parts: Mapping) -> dict:
    """One dictionary of several that share no name."""
    result: dict = {}
    for part in parts:
        if twice := result.keys() & part.keys():
            raise ValueError(f"registered more than once: {sorted(twice)}")
        result.update(part)
    return result
