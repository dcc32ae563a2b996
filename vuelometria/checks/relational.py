"""Joins, aggregates, rankings and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import pct, ratio, round_n
from ..operators.groups import correlation_pairs
from ..operators.payload import joined_rows
from ..operators.shape import drill_across, left_attach, preview
from ..operators.topn import top_with_ties
from ..operators.totals import running_total, sum_of_groups
from ..plans import daily, marts
from ..plans.rollups import airline_rollup, route_rollup, weather_rollup
from .registry import register

# --- joins ------------------------------------------------------------------------------


def _c1(t):
    rollup = airline_rollup(t.stg_flights, by_date=False)
    return left_attach(
        rollup.select("airline_iata", "airline_name").distinct(), marts.airline_metrics(rollup), "airline_iata"
    )


register(
    "c1_airline_metrics",
    _c1,
    """select n.airline_iata, n.airline_name, m.* exclude (airline_iata)
       from (select distinct airline_iata, airline_name from stg_flights) n
       left join airline_metrics m on m.airline_iata = n.airline_iata""",
)


def _c2(t):
    routes = route_rollup(t.stg_flights, by_date=False)
    names = marts.airport_ends(routes).select("airport_iata", "airport_name").distinct()
    departures = routes.groupBy(F.col("departure_iata").alias("airport_iata")).agg(F.sum("vuelos").alias("salidas"))
    arrivals = routes.groupBy(F.col("arrival_iata").alias("airport_iata")).agg(F.sum("vuelos").alias("llegadas"))
    return left_attach(left_attach(names, departures, "airport_iata"), arrivals, "airport_iata")


register(
    "c2_airport_metrics",
    _c2,
    """select airport_iata, airport_name, vuelos_como_origen as salidas, vuelos_como_destino as llegadas
       from airport_names left join origin_metrics using (airport_iata)
       left join destination_metrics using (airport_iata)""",
)


def _c3(t):
    metrics = marts.condition_metrics(weather_rollup(t.stg_weather, ["condition"]))
    names = t.stg_weather.where(F.col("condition").isNotNull()).select(
        F.col("condition").alias("condicion_texto")
    ).distinct()
    return left_attach(names, metrics, {"condicion_texto": "condition"})


register(
    "c3_condition_metrics",
    _c3,
    """select condicion_texto, m.* exclude (condition)
       from (select distinct condition as condicion_texto from stg_weather where condition is not null) c
       left join condition_metrics m on m.condition = condicion_texto""",
)


def _with_weather(t, city=None):
    weather = t.int_weather_daily.select("weather_date", "city", "avg_temp_c", "num_mediciones")
    if city:
        weather = weather.where(F.col("city") == city)
    flights = t.int_flights_daily.select("flight_date", "total_vuelos")
    return left_attach(flights, weather, {"flight_date": "weather_date"})


register(
    "c4_fanout",
    _with_weather,
    """select f.flight_date, total_vuelos, city, avg_temp_c, num_mediciones from int_flights_daily f
       left join int_weather_daily w on w.weather_date = f.flight_date""",
)
register(
    "c4_city",
    lambda t: _with_weather(t, "ASIA"),
    """select f.flight_date, total_vuelos, city, avg_temp_c, num_mediciones from int_flights_daily f
       left join int_weather_daily w on w.weather_date = f.flight_date and city = 'ASIA'""",
)
register(
    "c5_incidents",
    lambda t: left_attach(
        t.int_flights_daily.select("flight_date", "total_vuelos"),
        t.int_delays_daily.select("report_date", "total_incidentes", "pct_resolucion"),
        {"flight_date": "report_date"},
    ),
    """select flight_date, total_vuelos, total_incidentes, pct_resolucion
       from int_flights_daily left join int_delays_daily on report_date = flight_date""",
)
register(
    "c6_calendar",
    lambda t: left_attach(
        t.stg_flights.groupBy(F.col("flight_date").alias("fecha"), "flight_status").agg(F.count(F.lit(1)).alias("n")),
        t.dim_fecha.select("fecha", "nombre_dia", "trimestre", "es_fin_de_semana"),
        "fecha",
    )
    .groupBy("flight_status", "trimestre", "nombre_dia", "es_fin_de_semana")
    .agg(F.sum("n").alias("n")),
    """select flight_status, trimestre, nombre_dia, es_fin_de_semana, count(*) as n
       from stg_flights left join dim_fecha on fecha = flight_date group by 1, 2, 3, 4""",
)
register(
    "c7_drill_across",
    lambda t: drill_across(
        t.dim_fecha.select("fecha"),
        "fecha",
        t.fct_vuelos.groupBy("fecha").agg(F.count(F.lit(1)).alias("vuelos")),
        t.fct_incidentes.groupBy("fecha").agg(F.count(F.lit(1)).alias("incidentes")),
        t.fct_clima_diario.groupBy("fecha").agg(F.count(F.lit(1)).alias("climas")),
    ),
    """select fecha, vuelos, incidentes, climas from dim_fecha
       left join (select fecha, count(*) as vuelos from fct_vuelos group by 1) using (fecha)
       left join (select fecha, count(*) as incidentes from fct_incidentes group by 1) using (fecha)
       left join (select fecha, count(*) as climas from fct_clima_diario group by 1) using (fecha)""",
)
register("c8_flight_weather", lambda t: t.fct_vuelos, "select * from fct_vuelos")


def _c9(t):
    alerts = t.fct_clima_diario.groupBy("ciudad").agg(F.count_if("hubo_condiciones_adversas").alias("dias_adv"))
    airports = left_attach(t.dim_aeropuerto.select("airport_iata"), t.airport_cities, "airport_iata")
    return left_attach(airports, alerts, "ciudad")


register(
    "c9_airport_climate",
    _c9,
    """select airport_iata, ciudad, dias_adv from dim_aeropuerto left join airport_cities using (airport_iata)
       left join (select ciudad, count(*) filter (hubo_condiciones_adversas) as dias_adv from fct_clima_diario group by 1)
         using (ciudad)
       group by all""",
)

# --- aggregates -------------------------------------------------------------------------

register(
    "d1_count",
    lambda t: daily.flight_volumes(t.stg_flights).select("flight_date", F.col("total_vuelos").alias("n")),
    "select flight_date, count(*) as n from stg_flights group by 1",
)
register(
    "d2_count_if",
    lambda t: daily.flight_volumes(t.stg_flights).select(
        "flight_date",
        F.col("vuelos_completados").alias("completados"),
        F.col("vuelos_con_retraso").alias("tarde"),
        (F.col("retrasos_severos") + F.col("retrasos_criticos")).alias("graves"),
    ),
    """select flight_date, sum((flight_status = 'completado')::int)::bigint as completados,
         sum(tiene_retraso::int)::bigint as tarde,
         sum((departure_delay_min > 60)::int)::bigint as graves from stg_flights group by 1""",
)
register(
    "d3_count_distinct",
    lambda t: daily.flight_diversity(t.stg_flights).select(
        "flight_date",
        F.col("num_aerolineas").alias("aerolineas"),
        F.col("num_aeropuertos_origen").alias("origenes"),
        F.col("num_aeropuertos_destino").alias("destinos"),
    ),
    """select flight_date, count(distinct airline_iata) as aerolineas, count(distinct departure_iata) as origenes,
         count(distinct arrival_iata) as destinos from stg_flights group by 1""",
)
register(
    "d4_pct",
    lambda t: t.stg_delays.groupBy("user_id").agg(
        pct(F.count_if("is_resolved"), F.count(F.lit(1))).alias("pct"),
        pct(
            F.count_if((F.col("prioridad") == "alta") & ~F.col("is_resolved")), F.count_if(F.col("prioridad") == "alta")
        ).alias("pct_alta_abierta"),
    ),
    """select user_id, round((100.0 * count(*) filter (is_resolved) / count(*))::decimal(18,6), 2)::double as pct,
         round((100.0 * count(*) filter (prioridad = 'alta' and is_resolved = false)
           / nullif(count(*) filter (prioridad = 'alta'), 0))::decimal(18,6), 2)::double as pct_alta_abierta
       from stg_delays group by 1""",
)
register(
    "d5_pct_unrounded",
    lambda t: t.incidents_per_day.select("report_date", "pct_resolucion"),
    "select report_date, pct_resolucion from incidents_per_day",
)
register(
    "d6_avg_rounded",
    lambda t: t.stg_weather.groupBy("city").agg(
        round_n(F.avg("temp_c"), 1).alias("temp"),
        round_n(F.avg("humidity"), 0).alias("humedad"),
        round_n(F.avg("visibility_km"), 1).alias("visibilidad"),
    ),
    """select city, round(avg(temp_c)::decimal(18,6), 1)::double as temp,
         round(avg(humidity)::decimal(18,6), 0)::double as humedad,
         round(avg(visibility_km)::decimal(18,6), 1)::double as visibilidad from stg_weather group by 1""",
)
register(
    "d7_extremes",
    lambda t: weather_rollup(t.stg_weather, ["city", "condition"]).select(
        "city", "condition", F.col("max_temp_c").alias("max_t"), F.col("min_temp_c").alias("min_t"),
        F.col("max_wind_kph").alias("max_w"), F.col("max_cloud_coverage").alias("max_c"),
    ),
    """select city, condition, max(temp_c) as max_t, min(temp_c) as min_t, max(wind_kph) as max_w,
         max(cloud_coverage) as max_c from stg_weather group by 1, 2""",
)
register(
    "d8_max_text",
    lambda t: t.int_weather_daily.select(
        "weather_date", "city", "condicion_predominante", "visibilidad_categoria", "viento_categoria"
    ),
    """select weather_date, city, max(condition) as condicion_predominante,
         max(visibilidad_categoria) as visibilidad_categoria, max(viento_categoria) as viento_categoria
       from stg_weather group by 1, 2""",
)
register(
    "d9_any_flag",
    lambda t: weather_rollup(t.stg_weather, ["weather_date"]).select(
        "weather_date", F.col("adversas").alias("adversa")
    ),
    "select weather_date, bool_or(condiciones_adversas)::int as adversa from stg_weather group by 1",
)
register(
    "d10_first_last",
    lambda t: marts.airline_metrics(airline_rollup(t.stg_flights, by_date=False)).select(
        "airline_iata", F.col("primera_operacion").alias("primera"), F.col("ultima_operacion").alias("ultima")
    ),
    """select airline_iata, min(flight_date) as primera, max(flight_date) as ultima from stg_flights
       where airline_iata is not null group by 1""",
)
register(
    "d11_distinct",
    lambda t: marts.dim_aerolinea(t.stg_flights).select("airline_iata", "airline_name"),
    "select distinct airline_iata, airline_name from stg_flights where airline_iata is not null",
)
register(
    "d12_three_keys",
    lambda t: daily.int_weather_daily(t.stg_weather).select(
        "weather_date", "city", "country", F.col("num_mediciones").alias("n")
    ),
    "select weather_date, city, country, count(*) as n from stg_weather group by 1, 2, 3",
)
register(
    "d13_mode",
    lambda t: daily.weather_daily_mode(t.stg_weather),
    """select weather_date, city, country,
         first(condition order by n desc, condition) filter (condition is not null) as condition,
         max(n) filter (condition is not null) as frecuencia
       from (select weather_date, city, country, condition, count(*) as n from stg_weather group by 1, 2, 3, 4)
       group by 1, 2, 3""",
)
register(
    "d14_sum",
    lambda t: t.fct_incidentes.groupBy("motivo").agg(F.sum("minutos_retraso_asociado").alias("minutos")),
    "select motivo, sum(minutos_retraso_asociado)::bigint as minutos from fct_incidentes group by 1",
)
register(
    "d15_average_of_averages",
    lambda t: t.fct_vuelos.groupBy("airline_name", "fecha")
    .agg(F.avg("retraso_salida_min").alias("media"))
    .groupBy("airline_name")
    .agg(round_n(F.avg("media"), 6).alias("media_de_medias")),
    """select airline_name, round(avg(media)::decimal(18,6), 6)::double as media_de_medias
       from (select airline_name, fecha, avg(retraso_salida_min) as media from fct_vuelos group by 1, 2) group by 1""",
)
register(
    "d16_stddev_pop",
    lambda t: t.fct_clima_diario.groupBy("ciudad").agg(round_n(F.stddev_pop("avg_temp_c"), 6).alias("sigma")),
    "select ciudad, round(stddev_pop(avg_temp_c)::decimal(18,6), 6)::double as sigma from fct_clima_diario group by 1",
)
_WEATHER_VARIABLES = {
    "temp": "temp_c", "humedad": "humidity", "viento": "wind_kph", "lluvia": "chance_of_rain", "nubes": "cloud_coverage",
    "precip": "precip_mm",
}


def _pairs_sql(variables: dict[str, str], table: str) -> str:
    names = list(variables)
    rows = [
        f"select '{x}' as var_x, '{y}' as var_y, round(corr({variables[x]}, {variables[y]})::decimal(18,6), 6)::double as r "
        f"from {table}"
        for i, x in enumerate(names)
        for y in names[i + 1 :]
    ]
    return "\nunion all ".join(rows)


register(
    "d17_correlation",
    lambda t: correlation_pairs(t.stg_weather, _WEATHER_VARIABLES).drop("orden"),
    _pairs_sql(_WEATHER_VARIABLES, "stg_weather"),
)


def _d18(t):
    groups = t.fct_vuelos.groupBy("destino_iata").agg(F.count(F.lit(1)).alias("n"))
    total = sum_of_groups(groups, "n")
    return groups.select("destino_iata", "n", total.alias("total"), round_n(ratio("n", total) * 100, 6).alias("pct"))


register(
    "d18_grand_total",
    _d18,
    """select destino_iata, n, sum(n) over ()::bigint as total,
         round((n::double / sum(n) over () * 100)::decimal(18,6), 6)::double as pct
       from (select destino_iata, count(*) as n from fct_vuelos group by 1)""",
)
register(
    "d19_listagg",
    lambda t: joined_rows(
        t.fct_incidentes.groupBy("motivo").agg(F.count(F.lit(1)).alias("n")),
        ["motivo", F.lit(":"), "n"],
        ["n desc", "motivo"],
    ),
    """select string_agg(motivo || ':' || n, '|' order by n desc, motivo) as data
       from (select motivo, count(*) as n from fct_incidentes group by 1)""",
)

# --- rankings, order, sets --------------------------------------------------------------

register(
    "e1_topn_ties",
    lambda t: top_with_ties(
        t.stg_flights.groupBy("flight_date").agg(F.count(F.lit(1)).alias("n")), "n", 25
    ),
    """select flight_date, n from (select flight_date, count(*) as n from stg_flights group by 1)
       qualify rank() over (order by n desc) <= 25""",
)
register(
    "e1_topn_ties_asc",
    lambda t: top_with_ties(t.int_weather_daily.select("weather_date", "city", "avg_temp_c"), "avg_temp_c", 40, True),
    """select weather_date, city, avg_temp_c from int_weather_daily where avg_temp_c is not null
       qualify rank() over (order by avg_temp_c) <= 40""",
)
register(
    "e2_running_total",
    lambda t: running_total(t.int_flights_daily.select("flight_date", "total_vuelos"), "flight_date", ["total_vuelos"]),
    """select flight_date, total_vuelos, sum(total_vuelos) over (order by flight_date)::bigint as total_vuelos_acum
       from int_flights_daily""",
)
register(
    "f1_order",
    lambda t: t.dim_fecha.select("fecha", "fecha_display").orderBy("fecha"),
    "select fecha, fecha_display from dim_fecha order by fecha",
)
register(
    "f2_limit",
    lambda t: preview(t.int_flights_daily, 10, ["flight_date"]),
    "select * from int_flights_daily order by flight_date limit 10",
)
register(
    "f3_order_desc",
    lambda t: t.int_flights_daily.select("flight_date", "total_vuelos").orderBy(F.desc("total_vuelos"), "flight_date"),
    "select flight_date, total_vuelos from int_flights_daily order by total_vuelos desc, flight_date",
)
register(
    "f4_union3",
    lambda t: marts.distinct_dates(
        (t.stg_flights, "flight_date"), (t.stg_weather, "weather_date"), (t.stg_delays, "report_date")
    ),
    """select flight_date as fecha from stg_flights union select weather_date from stg_weather
       union select report_date from stg_delays""",
)


def _f5(t):
    def end(iata, name):
        return t.stg_flights.select(F.col(iata).alias("airport_iata"), F.col(name).alias("airport_name")).distinct()

    return end("departure_iata", "departure_airport").union(end("arrival_iata", "arrival_airport")).distinct()


register("f5_union2", _f5, "select airport_iata, airport_name from airport_names")
