"""Registry of the queries over the test tables and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import apply_sql_defaults
from ..sources.driver_views import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a query body that takes ``Views`` and returns a DataFrame."""

    def wrap(body: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return body(Views(apply_sql_defaults(spark), sf_dir))

        run.__name__, run.__doc__ = name, body.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return body

    return wrap
