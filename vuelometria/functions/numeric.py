"""Null-safe arithmetic and rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_column(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def coalesce0(col: ColumnOrName) -> Column:
    return F.coalesce(as_column(col), F.lit(0))


def round_n(col: ColumnOrName, digits: int) -> Column:
    """Half-up rounding that does not depend on the order in which doubles were added.

    The detour over six decimals removes the last-bit noise of a distributed sum, so a value
    that is a tie on paper (62.35) always goes the same way.
    """
    value = as_column(col)
    exact = F.round(value.try_cast("decimal(38,6)"), digits).cast("double")
    # 10^32 and more leaves no room for six decimals, and needs none
    return F.coalesce(exact, F.round(value.cast("double"), digits))


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` as double; NULL when the denominator is 0 or NULL."""
    return F.try_divide(as_column(num).cast("double"), as_column(den).cast("double"))


def pct(num: ColumnOrName, den: ColumnOrName, digits: int | None = 2) -> Column:
    """``100 * num / den``; NULL on an empty denominator; unrounded with ``digits=None``."""
    value = F.try_divide(as_column(num).cast("double") * F.lit(100.0), as_column(den).cast("double"))
    return value if digits is None else round_n(value, digits)


def count_where(predicate: Column) -> Column:
    return F.count_if(predicate)


_COMPARE = {
    "le": Column.__le__,
    "lt": Column.__lt__,
    "ge": Column.__ge__,
}


def bucketize(col: ColumnOrName, bounds: Sequence[float], labels: Sequence[str], compare: str = "le") -> Column:
    """Label of the first bound the value meets; the last label takes everything else, NULL included."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("bucketize needs one label more than bounds")
    value, meets = as_column(col), _COMPARE[compare]
    chain = F
    for bound, label in zip(bounds, labels):
        chain = chain.when(meets(value, F.lit(bound)), F.lit(label))
    return chain.otherwise(F.lit(labels[-1]))
