"""Calendar attributes of a date. Weekdays count from Sunday = 1, weeks are ISO weeks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnOrName, as_column
from .text import fmt_date

# Display names, without accents.
WEEKDAY_NAMES = ("Domingo", "Lunes", "Martes", "Miercoles", "Jueves", "Viernes", "Sabado")
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)


def _name_of(number: Column, names: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), number)


def weekday_name(date: ColumnOrName) -> Column:
    return _name_of(F.dayofweek(as_column(date)), WEEKDAY_NAMES)


def month_name(date: ColumnOrName) -> Column:
    return _name_of(F.month(as_column(date)), MONTH_NAMES)


def quarter_label(date: ColumnOrName) -> Column:
    return F.concat(F.lit("Q"), F.quarter(as_column(date)).cast("string"))


def is_weekend(date: ColumnOrName) -> Column:
    return F.dayofweek(as_column(date)).isin(1, 7)


def calendar_columns(date: str) -> list[Column]:
    """The attribute columns of the calendar dimension for the date column ``date``."""
    d = F.col(date)
    return [
        F.year(d).alias("anio"),
        F.month(d).alias("mes"),
        F.dayofmonth(d).alias("dia"),
        F.dayofweek(d).alias("dia_semana_num"),
        weekday_name(d).alias("nombre_dia"),
        month_name(d).alias("nombre_mes"),
        quarter_label(d).alias("trimestre"),
        is_weekend(d).alias("es_fin_de_semana"),
        F.weekofyear(d).alias("semana_anio"),
        fmt_date(d).alias("fecha_display"),
    ]
