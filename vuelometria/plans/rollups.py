"""Small additive tables between the records and the dimensions.

Counts, sums, minima and maxima can be added up again, so a dimension over the whole history
comes from these rows instead of the records. Kept per date they make the daily run read only
the dates that changed; without the date they are the first aggregation step of a direct query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.numeric import count_where

WEATHER_MEANS = {
    "temp_c": 1, "temp_f": 1, "humidity": 0, "wind_kph": 1, "visibility_km": 1, "chance_of_rain": 0,
    "pressure_mb": 1, "cloud_coverage": 1,
}
WEATHER_CLASSES = {
    "visibilidad_categoria": rules.VISIBILITY[1],
    "viento_categoria": rules.WIND[1],
    "temperatura_categoria": rules.TEMPERATURE[1],
}


def _keys(date: str, by_date: bool, *keys: str) -> list[str]:
    return [date, *keys] if by_date else list(keys)


def airline_rollup(stg_flights: DataFrame, by_date: bool = True) -> DataFrame:
    """Per (date,) airline code and spelling."""
    keys = _keys("flight_date", by_date, "airline_iata", "airline_name")
    return (
        stg_flights.where(F.col("airline_iata").isNotNull())
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("vuelos"),
            count_where(F.col("tiene_retraso")).alias("retrasos"),
            count_where(F.col("flight_status") == "cancelado").alias("cancelados"),
            F.sum("departure_delay_min").alias("minutos"),
            F.min("flight_date").alias("primera"),
            F.max("flight_date").alias("ultima"),
        )
    )


def route_rollup(stg_flights: DataFrame, by_date: bool = True) -> DataFrame:
    """Per (date,) origin and destination with their spellings."""
    keys = _keys(
        "flight_date", by_date, "departure_iata", "departure_airport", "arrival_iata", "arrival_airport"
    )
    return stg_flights.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("vuelos"), count_where(F.col("tiene_retraso")).alias("retrasos")
    )


def class_rank(column: str) -> Column:
    """Alphabetical position of a class label; numbers can be aggregated by hash, text cannot."""
    chain = F
    for position, label in enumerate(sorted(WEATHER_CLASSES[column])):
        chain = chain.when(F.col(column) == label, F.lit(position))
    return chain


def class_label(column: str, rank: Column) -> Column:
    labels = F.array(*[F.lit(label) for label in sorted(WEATHER_CLASSES[column])])
    return F.element_at(labels, rank + 1)


def weather_rollup(stg_weather: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sums, counts and extremes per ``keys``; feeds the daily table, the mode and the condition dimension."""
    means = []
    for column in WEATHER_MEANS:
        means += [F.sum(column).alias(f"sum_{column}"), F.count(column).alias(f"num_{column}")]
    return stg_weather.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("mediciones"),
        *means,
        F.max("temp_c").alias("max_temp_c"),
        F.min("temp_c").alias("min_temp_c"),
        F.max("wind_kph").alias("max_wind_kph"),
        F.max("precip_mm").alias("max_precip_mm"),
        F.max("cloud_coverage").alias("max_cloud_coverage"),
        F.max(F.col("condiciones_adversas").cast("int")).alias("adversas"),
        *[F.max(class_rank(c)).alias(f"rank_{c}") for c in WEATHER_CLASSES],
    )


def daily_weather_rollup(stg_weather: DataFrame) -> DataFrame:
    return weather_rollup(stg_weather, ["weather_date", "city", "country", "condition"])


def mean_of(column: str) -> Column:
    """Mean from added-up rollup rows."""
    return F.try_divide(F.sum(f"sum_{column}").cast("double"), F.sum(f"num_{column}").cast("double"))
