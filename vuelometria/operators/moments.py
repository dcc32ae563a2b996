"""Means, deviations and correlations that can be merged.

A state holds, per key and pair of variables, the rows where both are known, their means, and the sums of squared and of
mixed deviations from these means. Two states merge by the pairwise rule: deviations add up, plus what the means are
apart. Sums of raw squares, which lose all digits where values are large beside their spread, are never formed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_n


def pairs_of(variables: Sequence[str]) -> list[tuple[str, str]]:
    return list(combinations(variables, 2))


def moment_state(df: DataFrame, keys: Sequence[str], variables: Mapping[str, str], pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """One row per key. ``variables`` maps names to columns; ``pairs`` of names, a pair of one name for a single variable."""
    chosen = pairs_of(list(variables)) if pairs is None else pairs
    out = []
    for x, y in chosen:
        a, b = (F.col(variables[v]).cast("double") for v in (x, y))
        both = a.isNotNull() & b.isNotNull()
        n = F.count_if(both)
        p, q = F.when(both, a), F.when(both, b)
        out.append(
            F.struct(
                n.alias("n"), F.avg(p).alias("mx"), F.avg(q).alias("my"), (F.var_pop(p) * n).alias("xx"),
                (F.var_pop(q) * n).alias("yy"), (F.covar_pop(p, q) * n).alias("xy"),
            ).alias(f"{x}__{y}")
        )
    return df.groupBy(*keys).agg(*out)


def merged_moments(state: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The state per ``by`` from finer states. Two aggregations: the means first, then deviations from them.

    They share one shuffle: both start from the same rows by the same keys.
    """
    means = []
    for c in columns:
        n = F.sum(f"{c}.n")
        means += [
            n.alias(f"n_{c}"),
            F.try_divide(F.sum(F.col(f"{c}.mx") * F.col(f"{c}.n")), n).alias(f"mx_{c}"),
            F.try_divide(F.sum(F.col(f"{c}.my") * F.col(f"{c}.n")), n).alias(f"my_{c}"),
        ]
    names = [f"{m}_{c}" for c in columns for m in ("n", "mx", "my")]
    total = state.groupBy(*by).agg(*means)
    if by:
        total = total.select(*[F.col(k).alias(f"__{k}") for k in by], *names)
        joined = state.join(total, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by])
    else:
        joined = state.withColumn("__total", total.select(F.struct(*names)).scalar()).select("*", "__total.*")
    out = []
    for c in columns:
        s, n = (lambda f, c=c: F.col(f"{c}.{f}")), F.col(f"{c}.n")
        dx, dy = s("mx") - F.col(f"mx_{c}"), s("my") - F.col(f"my_{c}")
        out.append(
            F.struct(
                F.max(f"n_{c}").alias("n"), F.max(f"mx_{c}").alias("mx"), F.max(f"my_{c}").alias("my"),
                F.sum(s("xx") + n * dx * dx).alias("xx"), F.sum(s("yy") + n * dy * dy).alias("yy"), F.sum(s("xy") + n * dx * dy).alias("xy"),
            ).alias(c)
        )
    return joined.groupBy(*by).agg(*out)


def sigma(column: str) -> Column:
    """Population deviation of the first variable of a state."""
    return F.sqrt(F.try_divide(F.col(f"{column}.xx"), F.col(f"{column}.n")))


def correlation(column: str) -> Column:
    """Pearson's r; NULL where a variable does not vary."""
    return F.try_divide(F.col(f"{column}.xy"), F.sqrt(F.col(f"{column}.xx")) * F.sqrt(F.col(f"{column}.yy")))


def correlations(state: DataFrame, by: Sequence[str], variables: Sequence[str], digits: int = 6) -> DataFrame:
    """One row per ``by`` and pair of variables, from a state."""
    cells = [
        F.struct(F.lit(x).alias("var_x"), F.lit(y).alias("var_y"), round_n(correlation(f"{x}__{y}"), digits).alias("r"))
        for x, y in pairs_of(variables)
    ]
    merged = merged_moments(state, by, [f"{x}__{y}" for x, y in pairs_of(variables)])
    return merged.select(*by, F.inline(F.array(*cells)))
