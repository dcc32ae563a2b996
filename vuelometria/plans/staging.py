"""Staging: cleaned and classified records, one per source row. Narrow plans, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import coalesce0
from ..functions.text import PRIORITY_DEFAULT, PRIORITY_KEYWORDS, classify_text

FLIGHT_COLUMNS = (
    "flight_date", "flight_number", "airline_name", "airline_iata",
    "departure_airport", "departure_iata", "departure_scheduled", "departure_delay_min",
    "arrival_airport", "arrival_iata", "arrival_scheduled", "arrival_delay_min",
)
WEATHER_COLUMNS = (
    "weather_date", "city", "region", "country", "latitude", "longitude", "local_time", "temp_c", "temp_f",
    "humidity", "wind_kph", "wind_direction", "pressure_mb", "precip_mm", "cloud_coverage", "visibility_km",
    "condition", "chance_of_rain",
)
INCIDENT_COLUMNS = ("report_date", "incident_id", "user_id", "incident_title", "is_resolved")


def _audit(df: DataFrame) -> list[str]:
    return [c for c in ("ingested_at",) if c in df.columns]


def stg_flights(flights: DataFrame) -> DataFrame:
    delay = F.col("departure_delay_min")
    replaced = {
        "flight_date": F.col("flight_date").cast("date"),
        "departure_delay_min": coalesce0(delay),
        "arrival_delay_min": coalesce0("arrival_delay_min"),
    }
    return flights.where(F.col("flight_date").isNotNull() & F.col("flight_number").isNotNull()).select(
        *[replaced.get(c, F.col(c)).alias(c) for c in FLIGHT_COLUMNS],
        rules.decode_status("flight_status").alias("flight_status"),
        rules.is_late(delay).alias("tiene_retraso"),
        rules.delay_severity(delay).alias("severidad_retraso"),
        *_audit(flights),
    )


def stg_weather(weather: DataFrame) -> DataFrame:
    return weather.where(F.col("weather_date").isNotNull()).select(
        F.col("weather_date").cast("date").alias("weather_date"),
        *WEATHER_COLUMNS[1:],
        rules.visibility_class("visibility_km").alias("visibilidad_categoria"),
        rules.wind_class("wind_kph").alias("viento_categoria"),
        rules.temperature_class("temp_c").alias("temperatura_categoria"),
        rules.is_adverse().alias("condiciones_adversas"),
        *_audit(weather),
    )


def stg_delays(delays: DataFrame) -> DataFrame:
    return delays.where(F.col("report_date").isNotNull()).select(
        F.col("report_date").cast("date").alias("report_date"),
        *INCIDENT_COLUMNS[1:],
        classify_text("incident_title", PRIORITY_KEYWORDS, PRIORITY_DEFAULT).alias("prioridad"),
        rules.incident_state("is_resolved").alias("estado_incidente"),
        *_audit(delays),
    )
