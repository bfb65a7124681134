"""All registered queries (SQL-checked and model-based)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from relevo.plans.model_queries import MODEL_QUERIES
from relevo.plans.queries import SQL_CHECKED


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**SQL_CHECKED, **MODEL_QUERIES}
