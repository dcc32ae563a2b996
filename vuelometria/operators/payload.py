"""Text payload of a dashboard visual: rows joined into one string, wrapped as JSON text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import join_text


def joined_rows(
    df: DataFrame,
    pieces: Sequence[Column | str],
    order: Sequence[str],
    extra: Mapping[str, Column] | None = None,
    row_sep: str = "|",
) -> DataFrame:
    """One row, column ``data``: ``pieces`` of each row concatenated, rows in ``order``.

    Plain strings in ``pieces`` are column names; ``order`` holds SQL sort keys such as
    ``"vuelos desc"``; ``extra`` adds aggregates over the same rows. Only for frames that
    were already reduced to what a chart shows.
    """
    lines = df.withColumn("__line", join_text(*pieces))
    text = F.expr(f"listagg(__line, '{row_sep}') within group (order by {', '.join(order)})")
    return lines.agg(text.alias("data"), *[value.alias(name) for name, value in (extra or {}).items()])


def as_json(df: DataFrame, header: Mapping[str, str | None], numbers: Iterable[str] = ()) -> DataFrame:
    """Column ``payload``: quoted header entries, unquoted number columns, then ``data``.

    A number stands where the header names it with None, else after the header.
    """
    parts: list[Column] = [F.lit("{")]
    for name, value in {**header, **{n: None for n in numbers if n not in header}}.items():
        parts += [F.lit(f'"{name}":'), F.col(name) if value is None else F.lit(f'"{value}"'), F.lit(",")]
    return df.select(join_text(*parts, F.lit('"data":"'), "data", F.lit('"}')).alias("payload"))


def payload(
    df: DataFrame,
    cols: Sequence[Column | str],
    order: Sequence[str],
    sep: str = ":",
    header: Mapping[str, str] | None = None,
) -> DataFrame:
    """``cols`` of every row joined by ``sep``, the rows by ``|``; as JSON text with a ``header``."""
    pieces: list[Column | str] = []
    for i, col in enumerate(cols):
        pieces += [F.lit(sep), col] if i else [col]
    data = joined_rows(df, pieces, order)
    return as_json(data, header) if header is not None else data
