"""Where registered queries and their SQL counterparts are collected."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from ..plans.binding import BoundTables
from .base_sql import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Analysed (not executed) frames per session and folder; nothing is cached but the plans.
_BOUND: WeakKeyDictionary[SparkSession, dict[str, BoundTables]] = WeakKeyDictionary()


def bound_tables(spark: SparkSession, folder: str) -> BoundTables:
    per_folder = _BOUND.setdefault(spark, {})
    if folder not in per_folder:
        per_folder[folder] = BoundTables(spark, folder)
    return per_folder[folder]


def register(key: str, query: Callable[[BoundTables], DataFrame], sql: str | None = None) -> None:
    """``query`` gets the bound tables; ``sql`` may use the view names of ``base_sql``."""
    if key in QUERIES:
        raise ValueError(f"{key} is registered twice")

    def run(spark: SparkSession, folder: str) -> DataFrame:
        # a new frame each time, so that every call is planned and run on its own
        return query(bound_tables(spark, folder)).select("*")

    QUERIES[key] = run
    if sql is not None:
        ORACLES[key] = with_views(sql)
