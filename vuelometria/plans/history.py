"""Rollups over a long history as a tree in time: days, months, years.

Dimensions add up all history. From the daily rollups that is as many rows per key as there are days, read anew by every
run. Here the rows of a month are folded into one per key, those months into years, and the dimensions read the years. A
changed date replaces its month (from the days of that month) and its year (from the months of that year), so a run reads
at most 31 + 12 + years rows per key, and other partitions are not opened.

Each level is made from the one below, never from itself, so a run that died half-way is put right by the next one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import only, replace_dates
from .rollups import WEATHER_MEANS


@dataclass(frozen=True)
class Additive:
    """Keys and measures of a rollup whose rows can be added up to rows of the same columns."""

    keys: Sequence[str]
    sums: Sequence[str]
    mins: Sequence[str] = ()
    maxs: Sequence[str] = ()

    def folded(self, rows: DataFrame, *also: str) -> DataFrame:
        """One row per keys (and ``also``)."""
        return rows.groupBy(*also, *self.keys).agg(
            *[F.sum(c).alias(c) for c in self.sums],
            *[F.min(c).alias(c) for c in self.mins],
            *[F.max(c).alias(c) for c in self.maxs],
        )


AIRLINES = Additive(
    ("airline_iata", "airline_name"), ("vuelos", "retrasos", "cancelados", "minutos"), mins=("primera",), maxs=("ultima",)
)
ROUTES = Additive(("departure_iata", "departure_airport", "arrival_iata", "arrival_airport"), ("vuelos", "retrasos"))
CONDITIONS = Additive(
    ("condition",), ("mediciones", *[f"{part}_{c}" for c in WEATHER_MEANS for part in ("sum", "num")]), maxs=("adversas",)
)


def by_year(days: DataFrame, column: str, state: Additive, root: str, changed: Sequence[date] | None) -> DataFrame:
    """Rows per year and key of the daily rollup ``days``, kept at ``{root}_mes`` and ``{root}_anio``.

    ``changed`` names the dates that were replaced in ``days``; None, or a tree that is not there yet, means all of them.
    NULL dates are in no month.
    """
    if changed is not None and not _exists(days, f"{root}_anio"):
        changed = None
    months = None if changed is None else sorted({d.replace(day=1) for d in changed})
    years = None if changed is None else sorted({d.year for d in changed})
    dated = days.where(F.col(column).isNotNull()).withColumn("mes", F.trunc(column, "MM"))
    per_month = replace_dates(state.folded(only(dated, "mes", months), "mes"), f"{root}_mes", "mes", months)
    with_year = per_month.withColumn("anio", F.year("mes"))
    return replace_dates(state.folded(only(with_year, "anio", years), "anio"), f"{root}_anio", "anio", years)


def _exists(df: DataFrame, path: str) -> bool:
    try:
        df.sparkSession.read.schema("anio int").parquet(path)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc):
            raise
        return False
    return True
