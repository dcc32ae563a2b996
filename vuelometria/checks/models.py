"""Staging, daily and mart models."""

from __future__ import annotations

from ..plans import marts
from .registry import register

register("h1_stg_flights", lambda t: t.stg_flights, "select * from stg_flights")
register("h2_stg_weather", lambda t: t.stg_weather, "select * exclude (oid) from stg_weather")
register(
    "h3_stg_delays",
    lambda t: t.stg_delays,
    "select report_date, incident_id, user_id, incident_title, is_resolved, prioridad, estado_incidente from stg_delays",
)
register("h4_int_flights_daily", lambda t: t.int_flights_daily, "select * from int_flights_daily")
register("h5_int_weather_daily", lambda t: t.int_weather_daily, "select * from int_weather_daily")
register("h6_int_delays_daily", lambda t: t.int_delays_daily, "select * from int_delays_daily")
register(
    "h7_dim_fecha",
    lambda t: marts.dim_fecha(t.stg_flights, t.stg_weather, t.stg_delays),
    "select * from dim_fecha order by fecha",
)
register("h8_dim_aerolinea", lambda t: t.dim_aerolinea, "select * from dim_aerolinea")
register("h9_dim_aeropuerto", lambda t: t.dim_aeropuerto, "select * from dim_aeropuerto")
register("h10_dim_condicion_clima", lambda t: t.dim_condicion_clima, "select * from dim_condicion_clima")
register(
    "h11_fct_lean",
    lambda t: marts.fct_flights_lean(t.int_flights_daily, t.int_weather_daily, t.incidents_per_day),
    "select * from fct_lean",
)
register(
    "h12_fct_full",
    lambda t: marts.fct_flights_full(t.int_flights_daily, t.int_weather_daily, t.int_delays_daily),
    "select * from fct_full",
)
