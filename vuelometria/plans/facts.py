"""Fact tables of the dashboard layer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import round_n
from ..operators.shape import left_attach
from .rollups import daily_weather_rollup, mean_of


def clima_diario_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy(F.col("weather_date").alias("fecha"), F.col("city").alias("ciudad")).agg(
        F.max("condition").alias("condicion_predominante"),
        (F.max("adversas") == 1).alias("hubo_condiciones_adversas"),
        round_n(mean_of("temp_c"), 1).alias("avg_temp_c"),
        round_n(mean_of("humidity"), 0).alias("avg_humidity"),
        round_n(mean_of("wind_kph"), 1).alias("avg_wind_kph"),
        round_n(mean_of("chance_of_rain"), 0).alias("avg_chance_of_rain"),
        round_n(mean_of("cloud_coverage"), 1).alias("avg_cloud"),
        F.max("max_precip_mm").alias("max_precip_mm"),
        F.sum("mediciones").alias("num_mediciones"),
    )


def fct_clima_diario(stg_weather: DataFrame) -> DataFrame:
    """Weather per date and city."""
    return clima_diario_from_rollup(daily_weather_rollup(stg_weather))


def fct_vuelos(flights: DataFrame, clima: DataFrame, origin_city: str = "origin_city") -> DataFrame:
    """One row per flight with the weather of its origin city on its date.

    ``origin_city`` names the column with the city of the departure airport. The weather side
    is a daily table; flights without a match keep NULL condition and a false flag.
    """
    day = clima.select("fecha", "ciudad", "condicion_predominante", "hubo_condiciones_adversas")
    bare = flights.select(
        F.col("flight_date").alias("fecha"),
        F.col("departure_iata").alias("origen_iata"),
        F.col("arrival_iata").alias("destino_iata"),
        "airline_name",
        F.lower("flight_status").alias("flight_status"),
        F.col("departure_delay_min").alias("retraso_salida_min"),
        rules.is_late("departure_delay_min").alias("tiene_retraso"),
        F.col(origin_city).alias("ciudad"),
    )
    return left_attach(bare, day, ["fecha", "ciudad"]).select(
        *[c for c in bare.columns if c != "ciudad"],
        F.col("condicion_predominante").alias("condicion_clima"),
        F.coalesce("hubo_condiciones_adversas", F.lit(False)).alias("condiciones_adversas"),
    )


def airport_city(dim_aeropuerto: DataFrame, cities: DataFrame) -> DataFrame:
    """Airport dimension with ``ciudad`` from a (airport_iata, ciudad) list."""
    return left_attach(dim_aeropuerto, cities, "airport_iata")


INCIDENT_COLUMNS = (
    "incidente_id", "fecha", "airline_name", "motivo", "agente_id", "is_resolved", "estado",
    "minutos_retraso_asociado", "satisfaccion_cliente", "tiempo_resolucion_horas",
)


def fct_incidentes(incidents: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Incident fact from any frame; ``names`` maps fact columns to source columns, ``estado`` is derived."""
    out = [
        rules.incident_state(names.get("is_resolved", "is_resolved")).alias("estado")
        if column == "estado"
        else F.col(names.get(column, column)).alias(column)
        for column in INCIDENT_COLUMNS
    ]
    return incidents.select(*out)
