"""Every query of the raster and catalogue operators, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name; sql gives the same rows in DuckDB."""

    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def _loaded() -> None:
    from terrazzo.plans import catalogue, geometry, pixels, scenewide  # noqa: F401  (they register their queries)


def queries() -> dict[str, Query]:
    _loaded()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _loaded()
    return dict(ORACLES)
