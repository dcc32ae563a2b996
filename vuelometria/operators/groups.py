"""Group-wise helpers: mode, correlation matrix, rows from a single aggregate row."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_n


def mode_per_group(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Most frequent non-NULL ``value`` per key, the alphabetically first one on a tie.

    Counting by (keys, value) first spreads a hot key over its values; the second step sees
    one row per distinct value.
    """
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    candidate = F.when(
        F.col(value).isNotNull(),
        F.struct((-F.col("__n")).alias("rank"), F.col(value).alias("value"), F.col("__n").alias("n")),
    )
    return (
        counted.groupBy(*keys)
        .agg(F.min(candidate).alias("__best"))
        .select(*keys, F.col("__best.value").alias(value), F.col("__best.n").alias("frecuencia"))
    )


def correlation_pairs(df: DataFrame, variables: dict[str, str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair of variables (name -> column), one row per pair, one pass."""
    pairs = list(combinations(variables, 2))
    row = df.agg(*[F.corr(variables[x], variables[y]).alias(f"r{i}") for i, (x, y) in enumerate(pairs)])
    cells = [
        F.struct(
            F.lit(i + 1).alias("orden"), F.lit(x).alias("var_x"), F.lit(y).alias("var_y"),
            round_n(f"r{i}", digits).alias("r"),
        )
        for i, (x, y) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*cells)))


def rows_of(row: DataFrame, entries: Sequence[dict[str, Column]]) -> DataFrame:
    """Turns a one-row frame into one row per entry; every entry has the same column names."""
    return row.select(F.inline(F.array(*[F.struct(*[c.alias(k) for k, c in e.items()]) for e in entries])))
