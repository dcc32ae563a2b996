"""Top-n that keeps ties, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _comparable(df: DataFrame, measure: str) -> Column:
    """Doubles are compared at six decimals: a tie must not hang on the order of a distributed sum."""
    if isinstance(df.schema[measure].dataType, (DoubleType, FloatType)):
        return F.round(measure, 6)
    return F.col(measure)


def top_with_ties(
    df: DataFrame, measure: str, n: int, ascending: bool = False, keep_null: bool = False
) -> DataFrame:
    """The rows whose ``measure`` is not worse than the n-th best one; doubles that agree to six decimals tie.

    NULL measures drop out, or with ``keep_null`` come after all others and tie with each other.

    The n-th value is a scalar subquery over ``orderBy().limit(n)``; the rows stay where they
    are and only get filtered, so any number of ties is fine. The subquery carries all columns
    in a struct: both uses of ``df`` then have the same plan and Spark runs its shuffle once.
    """
    value = _comparable(df, measure)
    best = value.asc() if ascending else value.desc()
    pick = F.max if ascending else F.min
    rest = [F.col(c) for c in df.columns]
    bound = (
        df.where(value.isNotNull())
        .orderBy(best)
        .limit(n)
        .agg(pick(F.struct(value.alias("__bound"), *rest)).alias("__edge"), F.count(F.lit(1)).alias("__n"))
        .select(F.struct(F.col("__edge").getField("__bound").alias("bound"), F.col("__n").alias("n")))
        .scalar()
    )
    good = value <= bound.getField("bound") if ascending else value >= bound.getField("bound")
    if keep_null:
        good = good | (value.isNull() & (bound.getField("n") < n))
    return df.where(good)


def latest_with_ties(df: DataFrame, measure: str, n: int) -> DataFrame:
    """:func:`top_with_ties` for unaggregated fact rows.

    Here the bound reads ``measure`` alone: one narrow scan, then a scan whose filter is
    pushed to the files (a partition filter when ``measure`` is the partition column).
    """
    value = _comparable(df, measure)
    bound = (
        df.where(value.isNotNull()).select(value.alias("__v")).orderBy(F.desc("__v")).limit(n).agg(F.min("__v")).scalar()
    )
    return df.where(value >= bound)
