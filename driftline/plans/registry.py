"""Registry of queries over the test tables and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle is not None:
            ORACLES[function.__name__] = oracle
        return function

    return register


def half_up_sql(expression: str, places: int) -> str:
    scale = f"1e{places}"
    return f"floor(({expression}) * {scale} + 0.5) / {scale}"
