"""Base measures of the dashboard: aggregate expressions for any grouping."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio


class FilterContext:
    """Aggregates restricted to the rows that meet ``where`` (all rows without it)."""

    def __init__(self, where: Column | None = None):
        self._where = where

    def rows(self, predicate: Column | None = None) -> Column:
        terms = [t for t in (self._where, predicate) if t is not None]
        if not terms:
            return F.count(F.lit(1))
        return F.count_if(reduce(Column.__and__, terms))

    def values(self, column: str) -> Column:
        return F.col(column) if self._where is None else F.when(self._where, F.col(column))


def _false(column: str) -> Column:
    """A missing flag counts as false."""
    return ~F.coalesce(F.col(column), F.lit(False))


def _cancelled() -> Column:
    return F.col("flight_status") == "cancelled"


# name -> (fact table, builder)
_MEASURES: dict[str, tuple[str, Callable[[FilterContext], Column]]] = {
    "total_vuelos": ("fct_vuelos", lambda c: c.rows()),
    "vuelos_a_tiempo": ("fct_vuelos", lambda c: c.rows(_false("tiene_retraso"))),
    "pct_a_tiempo": ("fct_vuelos", lambda c: ratio(c.rows(_false("tiene_retraso")), c.rows())),
    "total_cancelados": ("fct_vuelos", lambda c: c.rows(_cancelled())),
    "pct_cancelados": ("fct_vuelos", lambda c: ratio(c.rows(_cancelled()), c.rows())),
    "avg_retraso_min": ("fct_vuelos", lambda c: F.avg(c.values("retraso_salida_min"))),
    "total_min_retraso": ("fct_vuelos", lambda c: F.sum(c.values("retraso_salida_min"))),
    "indice_eficiencia": (
        "fct_vuelos",
        lambda c: ratio(c.rows(_false("tiene_retraso")), c.rows() - c.rows(_cancelled())),
    ),
    "vuelos_afectados_clima": ("fct_vuelos", lambda c: c.rows(F.col("condiciones_adversas"))),
    "total_incidentes": ("fct_incidentes", lambda c: c.rows()),
    "casos_cerrados": ("fct_incidentes", lambda c: c.rows(F.col("is_resolved"))),
    "casos_abiertos": ("fct_incidentes", lambda c: c.rows(_false("is_resolved"))),
    "pct_resolucion": ("fct_incidentes", lambda c: ratio(c.rows(F.col("is_resolved")), c.rows())),
    "avg_satisfaccion": ("fct_incidentes", lambda c: F.avg(c.values("satisfaccion_cliente"))),
    "avg_tiempo_resolucion": ("fct_incidentes", lambda c: F.avg(c.values("tiempo_resolucion_horas"))),
    "avg_temperatura": ("fct_clima_diario", lambda c: F.avg(c.values("avg_temp_c"))),
    "dias_con_clima_adverso": ("fct_clima_diario", lambda c: c.rows(F.col("hubo_condiciones_adversas"))),
}


def measure_names(table: str | None = None) -> list[str]:
    return [name for name, (home, _) in _MEASURES.items() if table in (None, home)]


def measure(name: str, where: Column | None = None) -> Column:
    """Aggregate expression of a measure, optionally under an extra filter."""
    return _MEASURES[name][1](FilterContext(where)).alias(name)


def evaluate(
    df: DataFrame, measures: Iterable[str | Column], by: Sequence[str] = (), where: Column | None = None
) -> DataFrame:
    """Measures per group in one aggregation; one row in total without ``by``."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*by).agg(*[measure(m) if isinstance(m, str) else m for m in measures])
