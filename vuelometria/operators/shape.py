"""Projection, join and preview helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_as(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Projection ``new name -> column``, in the order of the mapping."""
    return df.select(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in mapping.items()])


def left_attach(left: DataFrame, right: DataFrame, on: str | Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Left equi join that keeps the left key columns.

    ``on`` may map left names to right names. No broadcast is forced: Catalyst broadcasts
    ``right`` when its known size is below ``spark.sql.autoBroadcastJoinThreshold`` and
    otherwise joins by shuffle, where adaptive execution splits hot keys of the left side.
    """
    if isinstance(on, Mapping):
        renamed = right.withColumnsRenamed({r: f"__{r}" for r in on.values()})
        condition = [F.col(l) == F.col(f"__{r}") for l, r in on.items()]
        return left.join(renamed, condition, "left").drop(*[f"__{r}" for r in on.values()])
    return left.join(right, on, "left")


def drill_across(axis: DataFrame, key: str, *facts: DataFrame) -> DataFrame:
    """Facts that were aggregated by ``key`` side by side on the rows of ``axis``."""
    out = axis
    for fact in facts:
        out = out.join(fact, key, "left")
    return out


def preview(df: DataFrame, n: int = 10, order: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a total order (all columns unless ``order`` is given)."""
    return df.orderBy(*(order or df.columns)).limit(n)
