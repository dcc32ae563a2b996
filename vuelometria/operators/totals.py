"""Totals beside groups, running totals, control limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import round_n


def grand_total(df: DataFrame, value: Column) -> Column:
    """One value over all of ``df``, usable in the select list of any other frame."""
    return df.agg(value.alias("__total")).scalar()


def sum_of_groups(groups: DataFrame, column: str) -> Column:
    """Sum of ``column`` over already aggregated rows.

    ``groups`` should hold its keys and ``column`` only: then the subquery has the plan of the
    rows it stands beside, and Spark runs their shuffle once for both.
    """
    return grand_total(groups, F.sum(column))


def running_total(daily: DataFrame, order: str, columns: Sequence[str], suffix: str = "_acum") -> DataFrame:
    """Cumulative sums in the order of ``order``.

    The frame must hold one row per date: its size is bounded by the calendar, which is what
    makes the single ordered window acceptable.
    """
    window = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("*", *[F.sum(c).over(window).alias(c + suffix) for c in columns])


def control_limits(daily: DataFrame, measure: str, sigmas: float = 2.0) -> DataFrame:
    """Adds ``media``, ``lsc`` and ``lic``: mean and mean +- sigmas * population sigma, floor 0."""
    stats = grand_total(daily, F.struct(F.avg(measure).alias("mean"), F.stddev_pop(measure).alias("sigma")))
    mean, sigma = F.col("__stats.mean"), F.col("__stats.sigma")
    return (
        daily.withColumn("__stats", stats)
        .withColumns(
            {
                "media": round_n(mean, 6),
                "lsc": round_n(mean + F.lit(sigmas) * sigma, 6),
                "lic": round_n(F.greatest(F.lit(0.0), mean - F.lit(sigmas) * sigma), 6),
            }
        )
        .drop("__stats")
    )
