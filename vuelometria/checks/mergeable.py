"""Mergeable states: distinct counts, moments and running totals over any slice."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import round_n
from ..operators.bitmaps import codes_of, daily_state, distinct_over, new_codes
from ..operators.frequent import frequent_state, mode_over
from ..operators.moments import correlations, merged_moments, moment_state, sigma
from ..operators.prefix import prefix_sums
from ..plans import history, marts, rollups
from ..plans.daily import FLIGHT_CODES
from ..session import scratch_dir
from ..sources.tables import materialize
from .registry import register


def _months(t):
    month = F.date_format("flight_date", "yyyy-MM").alias("mes")
    state = t.flight_state.select("*", month)
    return distinct_over(state, ["mes"], FLIGHT_CODES)


register(
    "d3_distinct_by_month",
    _months,
    """select strftime(flight_date, '%Y-%m') as mes, count(distinct airline_iata) as num_aerolineas,
         count(distinct departure_iata) as num_aeropuertos_origen, count(distinct arrival_iata) as num_aeropuertos_destino
       from stg_flights group by 1""",
)


def _agents(t):
    """Agents per week, by a dictionary that Spark makes and daily bitmaps."""
    codes = materialize(new_codes(t.stg_delays.select("user_id")), scratch_dir(t.spark, "agents"))
    state = daily_state(t.stg_delays, ["report_date"], {"user_id": codes_of(codes)}, {"incidentes": F.count(F.lit(1))})
    weekly = state.select("*", F.weekofyear("report_date").cast("long").alias("semana"))
    sums = weekly.groupBy("semana").agg(F.sum("incidentes").alias("total_incidentes"))
    return sums.join(distinct_over(weekly, ["semana"], {"user_id": "num_agentes"}), "semana")


register(
    "h6_agents_by_week",
    _agents,
    """select week(report_date) as semana, count(*) as total_incidentes, count(distinct user_id) as num_agentes
       from stg_delays group by 1""",
)

_VARIABLES = {
    "temp": "temp_c", "humedad": "humidity", "viento": "wind_kph", "lluvia": "chance_of_rain", "nubes": "cloud_coverage",
    "precip": "precip_mm",
}


def _weather_moments(t):
    return moment_state(t.stg_weather, ["weather_date", "city"], _VARIABLES)


def _sigmas(t):
    state = moment_state(t.stg_weather, ["weather_date", "city"], _VARIABLES, [(v, v) for v in _VARIABLES])
    columns = [f"{v}__{v}" for v in _VARIABLES]
    merged = merged_moments(state, ["city"], columns)
    return merged.select("city", *[round_n(sigma(c), 6).alias(f"sigma_{v}") for v, c in zip(_VARIABLES, columns)])


register(
    "d16_merged_sigma",
    _sigmas,
    "select city, "
    + ", ".join(f"round(stddev_pop({c})::decimal(18,6), 6)::double as sigma_{v}" for v, c in _VARIABLES.items())
    + " from stg_weather group by 1",
)

_NAMES = list(_VARIABLES)
_PAIRS = [(x, y) for i, x in enumerate(_NAMES) for y in _NAMES[i + 1 :]]


register(
    "d17_merged_correlation",
    lambda t: correlations(_weather_moments(t), ["city"], _NAMES),
    " union all ".join(
        f"select city, '{x}' as var_x, '{y}' as var_y, "
        f"round(corr({_VARIABLES[x]}, {_VARIABLES[y]})::decimal(18,6), 6)::double as r from stg_weather group by 1"
        for x, y in _PAIRS
    ),
)
register(
    "e2_running_total_flights",
    lambda t: prefix_sums(
        t.stg_flights.select("flight_date", "flight_number", F.col("departure_delay_min").cast("long").alias("minutos")),
        ["flight_date", "flight_number", "minutos"],  # numbers may repeat
        ["minutos"],
    ),
    """select flight_date, flight_number, departure_delay_min::bigint as minutos,
         sum(departure_delay_min) over (order by flight_date, flight_number, departure_delay_min rows unbounded preceding)::bigint as minutos_acum
       from stg_flights""",
)


def _modes(t, keys, value, records):
    state = materialize(frequent_state(records, [*keys, "weather_date"], value), scratch_dir(t.spark, "frequent"))
    return mode_over(state, records.select(*keys, value), keys, value)


register(
    "d13_mode_by_city",
    lambda t: _modes(t, ["city"], "condition", t.stg_weather),
    """select city, first(condition order by n desc, condition) as condition, max(n) as frecuencia
       from (select city, condition, count(*) as n from stg_weather where condition is not null group by 1, 2) group by 1""",
)


def _in_two_runs(t, days, column, state):
    """The years of a rollup, built without its last 100 dates and then refreshed by them."""
    days, root = materialize(days, scratch_dir(t.spark, "days")), scratch_dir(t.spark, "history")
    last = [r[0] for r in days.select(column).distinct().orderBy(F.desc(column)).limit(100).collect()]
    history.by_year(days.where(~F.col(column).isin(last)), column, state, root, None)
    return history.by_year(days, column, state, root, last)


register(
    "h8_history",
    lambda t: marts.dim_aerolinea_from_rollup(
        _in_two_runs(t, rollups.airline_rollup(t.stg_flights), "flight_date", history.AIRLINES)
    ),
    "select * from dim_aerolinea",
)
register(
    "h9_history",
    lambda t: marts.dim_aeropuerto_from_rollup(
        _in_two_runs(t, rollups.route_rollup(t.stg_flights), "flight_date", history.ROUTES)
    ),
    "select * from dim_aeropuerto",
)
register(
    "h10_history",
    lambda t: marts.dim_condicion_clima_from_rollup(
        _in_two_runs(t, rollups.daily_weather_rollup(t.stg_weather), "weather_date", history.CONDITIONS)
    ),
    "select * from dim_condicion_clima",
)
