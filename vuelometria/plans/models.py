"""All models over the three processed tables, by name."""

from __future__ import annotations

from pyspark.sql import DataFrame

from . import daily, marts, staging


def build_models(
    flights: DataFrame, weather: DataFrame, delays: DataFrame, city: str | None = None
) -> dict[str, DataFrame]:
    """Lazy frames in dependency order; nothing runs until one of them is used.

    Meant for interactive use and for views (``register_views``). The daily job writes the
    tables instead and does not go back to the records for each of them.
    """
    out: dict[str, DataFrame] = {
        "stg_flights": staging.stg_flights(flights),
        "stg_weather": staging.stg_weather(weather),
        "stg_delays": staging.stg_delays(delays),
    }
    out["int_flights_daily"] = daily.int_flights_daily(out["stg_flights"])
    out["int_weather_daily"] = daily.int_weather_daily(out["stg_weather"])
    out["int_delays_daily"] = daily.int_delays_daily(out["stg_delays"])
    days = (out["int_flights_daily"], out["int_weather_daily"], out["int_delays_daily"])
    # the daily tables hold every date there is, in far fewer rows than the records
    out["dim_fecha"] = marts.dim_fecha(*days)
    out["dim_aerolinea"] = marts.dim_aerolinea(out["stg_flights"])
    out["dim_aeropuerto"] = marts.dim_aeropuerto(out["stg_flights"])
    out["dim_condicion_clima"] = marts.dim_condicion_clima(out["stg_weather"])
    out["fct_flights_lean"] = marts.with_updated_at(
        marts.fct_flights_lean(days[0], days[1], daily.incidents_from_daily(days[2]), city)
    )
    out["fct_flights_analytics"] = marts.with_updated_at(marts.fct_flights_full(*days, city))
    return out
