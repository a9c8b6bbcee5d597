"""Every query of the library by its name, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import fields, runs, skeletons, sweeps, tidy

PLANS = (sweeps, skeletons, tidy, runs, fields)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for plan in PLANS for name, query in plan.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for plan in PLANS for name, sql in plan.SQL.items()}
