"""Queries of the array engine by name, and the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone import calibration_queries as _calibration  # noqa: F401 (registers its queries)
from lodestone import crosshand_queries as _crosshands  # noqa: F401
from lodestone import observation_queries as _observation  # noqa: F401
from lodestone import pointing_queries as _pointing  # noqa: F401
from lodestone import queries as _sql_queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_sql_queries.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_sql_queries.SQL)
