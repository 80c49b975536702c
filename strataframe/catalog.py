"""All queries of the image operators by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import frames_plans, stage_plans, table_plans

PLANS = frames_plans.PLANS | table_plans.PLANS | stage_plans.PLANS
Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {name: query for name, (query, _) in PLANS.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in PLANS.items() if sql}
