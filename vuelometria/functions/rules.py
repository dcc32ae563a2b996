"""Business rules of the flight, weather and incident domains as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnOrName, as_column, bucketize, coalesce0, round_n

# Status words of the flight feed and their labels.
STATUS_LABELS = {
    "landed": "completado",
    "scheduled": "programado",
    "active": "en_vuelo",
    "cancelled": "cancelado",
}
STATUS_DEFAULT = "desconocido"

# Limits and labels of the classes.
LATE_MINUTES = 15
SEVERITY = ((15, 60, 180), ("menor", "moderado", "severo", "critico"))
VISIBILITY = ((10, 5, 2), ("excelente", "buena", "reducida", "muy_baja"))
WIND = ((20, 40, 60), ("calma", "moderado", "fuerte", "muy_fuerte"))
TEMPERATURE = ((10, 20, 28), ("frio", "fresco", "templado", "calido"))
RELIABILITY = ((10, 25), ("alta", "media", "baja"))


def decode_status(col: ColumnOrName) -> Column:
    word = F.lower(as_column(col))
    chain = F
    for raw, label in STATUS_LABELS.items():
        chain = chain.when(word == raw, F.lit(label))
    return chain.otherwise(F.lit(STATUS_DEFAULT))


def is_late(delay: ColumnOrName, threshold: int = LATE_MINUTES) -> Column:
    """Never NULL: a missing delay counts as 0 minutes."""
    return coalesce0(delay) > threshold


def delay_severity(delay: ColumnOrName) -> Column:
    minutes = coalesce0(delay)
    return F.when(minutes == 0, F.lit("sin_retraso")).otherwise(bucketize(minutes, *SEVERITY))


def visibility_class(km: ColumnOrName) -> Column:
    return bucketize(km, *VISIBILITY, compare="ge")


def wind_class(kph: ColumnOrName) -> Column:
    return bucketize(kph, *WIND, compare="lt")


def temperature_class(celsius: ColumnOrName) -> Column:
    return bucketize(celsius, *TEMPERATURE, compare="lt")


def is_adverse(visibility_km="visibility_km", wind_kph="wind_kph", precip_mm="precip_mm", cloud="cloud_coverage") -> Column:
    """One bad reading is enough; missing readings are never adverse on their own."""
    terms = (
        as_column(visibility_km) < 2,
        as_column(wind_kph) > 60,
        as_column(precip_mm) > 10,
        as_column(cloud) > 90,
    )
    anything_bad = terms[0] | terms[1] | terms[2] | terms[3]
    return F.coalesce(anything_bad, F.lit(False))


def incident_state(resolved: ColumnOrName) -> Column:
    return F.when(as_column(resolved), F.lit("resuelto")).otherwise(F.lit("pendiente"))


def impact_level(adverse: ColumnOrName, avg_rain: ColumnOrName, avg_visibility: ColumnOrName) -> Column:
    medium = (as_column(avg_rain) > 60) | (as_column(avg_visibility) < 5)
    return F.when(as_column(adverse) == 1, F.lit("alto")).when(medium, F.lit("medio")).otherwise(F.lit("bajo"))


def reliability(pct_late: ColumnOrName) -> Column:
    return bucketize(pct_late, *RELIABILITY)


def critical_day(
    pct_late: ColumnOrName = "pct_vuelos_con_retraso",
    cancelled: ColumnOrName = "vuelos_cancelados",
    adverse: ColumnOrName = "hubo_condiciones_adversas",
    high_priority: ColumnOrName = "incidentes_alta_prioridad",
    form: str = "full",
) -> Column:
    """Lean form: late share, cancellations, weather. Full form: also high-priority incidents."""
    hit = (as_column(pct_late) > 30) | (as_column(cancelled) > 5) | (as_column(adverse) == 1)
    if form == "full":
        hit = hit | (coalesce0(high_priority) > 3)
    elif form != "lean":
        raise ValueError(f"unknown form {form!r}")
    return F.coalesce(hit, F.lit(False))


def performance_score(pct_completed: ColumnOrName, pct_late: ColumnOrName, pct_resolved: ColumnOrName) -> Column:
    """0..100, higher is better. A day without incidents counts as fully resolved."""
    score = (
        as_column(pct_completed) * 0.5
        + (F.lit(100) - as_column(pct_late)) * 0.3
        + F.coalesce(as_column(pct_resolved), F.lit(100.0)) * 0.2
    )
    return round_n(score, 1)


def weather_impact(adverse: ColumnOrName, pct_late: ColumnOrName) -> Column:
    return F.coalesce((as_column(adverse) == 1) & (as_column(pct_late) > 20), F.lit(False))
