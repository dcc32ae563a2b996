"""Modes over any slice from frequent-items sketches per date, made exact by counting the candidates only.

A date keeps a sketch of its values. Sketches of a slice are merged, and the values that they name are counted over the
records. The most frequent of them is the mode if it has more rows than any other value can have: those in no candidate's
count, or those that the sketch can miss. Where neither holds, all values of that key are counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.tables import materialize
from .groups import mode_per_group

SKETCH, FILLED = "__frequent", "__filled"

#: A sketch of m entries estimates counts to 3.5 n / m of n rows, and names every value that has more than twice that.
MISSED = 7


def frequent_state(df: DataFrame, keys: Sequence[str], value: str, tracked: int = 256) -> DataFrame:
    """Per key a sketch of the values that are not NULL, and their number of rows."""
    filled = F.col(value).isNotNull()
    return df.where(filled).groupBy(*keys).agg(
        F.expr(f"approx_top_k_accumulate(`{value}`, {tracked})").alias(SKETCH), F.count(F.lit(1)).alias(FILLED)
    )


def mode_over(
    state: DataFrame, records: DataFrame, keys: Sequence[str], value: str, tracked: int = 256, broadcast_rows: int = 200_000
) -> DataFrame:
    """Most frequent ``value`` per key, the alphabetically first one on a tie: keys, value and ``frecuencia``.

    ``state`` is that of ``records``, by ``keys`` and more (dates, say). Both may be filtered alike. Keys without a value
    that is not NULL have no row. Candidates are broadcast up to ``broadcast_rows``, so that records meet them where they
    are read and only counts are shuffled.
    """
    spark, keys = state.sparkSession, list(keys)
    merged = state.groupBy(*keys).agg(F.expr(f"approx_top_k_combine({SKETCH}, {tracked})").alias(SKETCH), F.sum(FILLED).alias(FILLED))
    named = merged.select(*keys, FILLED, F.explode(F.expr(f"transform(approx_top_k_estimate({SKETCH}, {tracked}), c -> c.item)")).alias(value))
    candidates = materialize(named, scratch_dir(spark, "candidates"))
    few = candidates.count() <= broadcast_rows
    side = F.broadcast(candidates) if few else candidates
    # NULL keys are keys, as in a grouping
    same = [records[c].eqNullSafe(side[c]) for c in keys] + [records[value] == side[value]]
    on = same[0]
    for condition in same[1:]:
        on = on & condition
    counted = records.join(side, on).groupBy(*[side[c].alias(c) for c in (*keys, FILLED, value)]).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("rank"), F.col(value).alias("value"), F.col("__n").alias("n")))
    found = counted.groupBy(*keys, FILLED).agg(best.alias("__best"), F.sum("__n").alias("__seen"))
    n = F.col("__best.n")
    found = found.select(
        *keys, F.col("__best.value").alias(value), n.alias("frecuencia"),
        ((n > F.col(FILLED) - F.col("__seen")) | (n * tracked > MISSED * F.col(FILLED))).alias("__sure"),
    )
    found = materialize(found, scratch_dir(spark, "modes"))
    sure = found.where("__sure").drop("__sure")
    # keys whose values are all rare: without a candidate, or with one that others may surpass
    all_keys = state.select(*keys).distinct()
    open_keys = materialize(_without(all_keys, sure.select(*keys), keys), scratch_dir(spark, "open"))
    if open_keys.isEmpty():
        return sure
    rest = _matching(records.select(*keys, value), open_keys, keys, "left_semi").where(F.col(value).isNotNull())
    return sure.unionByName(mode_per_group(rest, keys, value))


def _matching(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    right = right.select(*[F.col(c).alias(f"__{c}") for c in keys])
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return left.join(right, on, how)


def _without(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return _matching(left, right, keys, "left_anti")
