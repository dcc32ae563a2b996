"""Distinct counts that can be merged: exact bitmaps over dictionary codes.

A dictionary gives each value a code. A state holds, per key, kind of value and bucket of 32,768 codes, a bitmap of the
codes seen. States of any keys merge by OR, so distinct counts over any set of dates come from daily states, and the
records are read once, when a date is written. A dictionary grows: append what ``new_codes`` gives for it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: codes in a bitmap, fixed by the functions that build it
BUCKET = 32_768


@dataclass(frozen=True)
class Codes:
    """A dictionary (value, code) and a bound of its codes; below ``BUCKET`` of them one bitmap holds all."""

    frame: DataFrame
    bound: int

    @property
    def single(self) -> bool:
        return self.bound <= BUCKET


def new_codes(values: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(value, code) for the values of the first column that ``known`` lacks, with codes behind those of ``known``.

    Values are numbered in ranges of their hash, each from the count of the ranges before, so no task sorts them all.
    """
    found = values.select(F.col(values.columns[0]).alias("value")).where(F.col("value").isNotNull()).distinct()
    start = F.lit(0).cast("long")
    if known is not None:
        found = found.join(known.select("value"), "value", "left_anti")
        start = F.coalesce(known.agg((F.max("code") + 1).alias("n")).scalar(), start)
    part = found.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(256)))
    sizes = part.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # 256 rows at most
    offsets = sizes.select("part", F.coalesce(before, F.lit(0).cast("long")).alias("before"))
    local = F.row_number().over(Window.partitionBy("part").orderBy("value")) - 1
    return part.withColumn("local", local).join(offsets, "part").select("value", (start + F.col("before") + F.col("local")).alias("code"))


def codes_of(frame: DataFrame) -> Codes:
    """A dictionary with its bound, read from the frame, which should be a stored table."""
    return Codes(frame, (frame.agg(F.max("code")).first()[0] or 0) + 1)


def coded(df: DataFrame, columns: Mapping[str, Codes]) -> DataFrame:
    """Adds ``code_<column>`` for each column; a value that the dictionary lacks, NULL too, has none."""
    for column, codes in columns.items():
        side = codes.frame.select(F.col("value").alias(column), F.col("code").alias(f"code_{column}"))
        df = df.join(side, column, "left")
    return df


def _bucket(column: str, codes: Codes) -> Column:
    return F.lit(0).cast("long") if codes.single else F.floor(F.col(f"code_{column}") / BUCKET)


def daily_state(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Codes], additive: Mapping[str, Column]) -> DataFrame:
    """One aggregation over the records: ``additive`` aggregates and a bitmap per column, by ``keys``.

    Dictionaries of more than one bucket add ``bucket_<column>`` to the keys, and ``additive`` is spread over these rows.
    """
    rows = coded(df, columns)
    wide = [c for c, codes in columns.items() if not codes.single]
    rows = rows.withColumns({f"bucket_{c}": _bucket(c, columns[c]) for c in wide})
    bitmaps = [F.bitmap_construct_agg(F.col(f"code_{c}") % BUCKET).alias(f"bitmap_{c}") for c in columns]
    return rows.groupBy(*keys, *[f"bucket_{c}" for c in wide]).agg(*[a.alias(n) for n, a in additive.items()], *bitmaps)


def _single(state: DataFrame, column: str) -> bool:
    return f"bucket_{column}" not in state.columns


def distinct_over(state: DataFrame, by: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """Distinct values per ``by`` over all rows of a state; ``columns`` maps coded columns to names of the result.

    ``by`` may be any columns or the alias of an expression made of the keys of the state: dates, months, or nothing.
    """
    if all(_single(state, c) for c in columns):
        return state.groupBy(*by).agg(*[F.bitmap_count(F.bitmap_or_agg(f"bitmap_{c}")).alias(name) for c, name in columns.items()])
    entries = [
        F.struct(
            F.lit(name).alias("kind"),
            (F.lit(0).cast("long") if _single(state, c) else F.col(f"bucket_{c}")).alias("bucket"),
            F.col(f"bitmap_{c}").alias("bitmap"),
        )
        for c, name in columns.items()
    ]
    merged = (
        state.select(*by, F.inline(F.array(*entries))).groupBy(*by, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n"))
    )
    return merged.groupBy(*by).agg(*[F.coalesce(F.sum(F.when(F.col("kind") == n, F.col("n"))), F.lit(0)).alias(n) for n in columns.values()])
