"""Every registered query of the fleet analytics part, and its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under a name."""

    def put(function):
        _QUERIES[name] = function
        if oracle:
            _ORACLES[name] = oracle
        return function

    return put


def _load() -> None:
    from fleetspark.plans import catalog, fleet, loads, reports, source_loads, star  # noqa: F401  they register what they define


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _ORACLES
